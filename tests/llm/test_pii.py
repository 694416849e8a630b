"""Personal data (3): base spans against Python's re, found spans on planted contexts, masking."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from surveyspark.llm import pii
from surveyspark.llm.catalog import op3_pii
from tests.llm.conftest import DOCS, docs_of

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [name for _, _, name in sorted(out)]


def check(row, text):
    names = brute(text)
    counts = [sum(n.startswith(k + ":") for n in names) for k in PLAIN]
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts, text
    assert row.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest(), (text, names, row.spans)
    assert set(names) <= set(row.spans.split(",")) | {""} and len(row.spans.split(",")) == len(names) + row.n_added or not row.spans


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = op3_pii(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20
    for r in rows:
        check(r, texts[r.doc_id])


def test_random_texts(spark):
    rng = random.Random(4)
    bits = ["a", "b@", "@", ".", "c.d", "-", "_", "%", " ", "  ", "1", "23", "256", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "+1 (2", "+", "(", ")", "é", "\U0001f600", "\n", "x@y.z", "5500005555555559", "000"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for i in range(1500)]
    rows += [(5000, None), (5001, ""), (None, "q@w.e"), (5002, "a@b.c" * 3000), (5003, "1." * 5000), (5004, "1" * 20_000), (5005, "a" * 50_000), (5006, "+1" * 5000), (5007, "1 " * 5000)]
    docs = docs_of(spark, [*rows, rows[0], rows[0]]).withColumn("hash", F.lit("clash")).withColumn("kind", F.lit(0)).withColumn("start", F.lit(0))
    got = pii.find_pii(docs).collect()
    assert len(got) == len(rows) + 2
    texts = dict(rows)
    for r in got:
        check(r, texts[r.doc_id])
    assert pii.find_pii(spark.createDataFrame([], DOCS)).collect() == []


@pytest.fixture(scope="module")
def bootstrapped():
    rng = random.Random(7)
    seeds = [(i, f"some words Contact: user{i}@mail{i % 5}.example.com more words {rng.randint(0, 9)}") for i in range(12)]
    unseen = [(100, "ask Contact: boss@localhost today"), (101, "the Contact: none here"), (102, "Contact: 5 apples"), (103, "other boss@localhost text")]
    return seeds + unseen


def test_contexts_find_unseen(spark, bootstrapped):
    got = {r.doc_id: r for r in pii.find_pii(docs_of(spark, bootstrapped)).collect()}
    assert got[100].spans == "email:13:27" and got[100].n_added == 1 and got[100].n_email == 0
    for i in (101, 102, 103):
        assert got[i].spans == "" and got[i].n_added == 0
    for i, t in bootstrapped[:12]:
        check(got[i], t)


def test_rare_contexts_find_nothing(spark, bootstrapped):
    got = pii.find_pii(docs_of(spark, [*bootstrapped[:3], bootstrapped[12]])).collect()
    assert all(r.n_added == 0 for r in got)


def test_mask(spark, bootstrapped):
    docs = docs_of(spark, [*bootstrapped, (200, "a q@w.e, +1 (234) 555-6789 x 4111111111111111 z"), (201, None), (None, "q@w.e"), (200, "a q@w.e, +1 (234) 555-6789 x 4111111111111111 z")])
    got = pii.mask_pii(docs.withColumn("cuts", F.lit(1)))
    assert got.columns == [*docs.columns, "cuts"] and got.count() == docs.count()
    texts = {}
    for r in got.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[100] == ["ask Contact: [EMAIL] today"] and texts[201] == [None] and texts[None] == ["[EMAIL]"]
    assert len(texts[200]) == 2 and texts[200][0].startswith("a [EMAIL], [PHONE]") and texts[200][0].endswith(" z") and "4111" not in texts[200][0]
    assert texts[103] == ["other boss@localhost text"]


def test_the_more_there_is_to_find_the_more_is_found(spark):
    """12 seeds and 8 unseen behind one word: all 8 are found, and what is found induces a pattern that no seed has."""
    rows = [(i, f"write Contact: user{i}@mail{i}.example now") for i in range(12)] + [(50 + i, f"Contact: boss{i}@localhost") for i in range(8)]
    rows += [(100 + i, f"please Reach: boss{i}@localhost") for i in range(8)] + [(200, "please Reach: chief@localhost"), (300, "other chief2@localhost")]
    rows += [(400 + i, f"Code: a{i}@localhost") for i in range(4)] + [(410 + i, f"Code: c{i}@mail.example") for i in range(3)] + [(420 + i, f"Code: {i}7") for i in range(9)]
    got = {r.doc_id: r.n_added for r in pii.find_pii(docs_of(spark, rows)).collect()}
    assert all(got[50 + i] == 1 and got[100 + i] == 1 for i in range(8)) and got[200] == 1
    assert got[300] == 0 and all(n == 0 for i, n in got.items() if i >= 400 or i < 12)
    once = {r.doc_id: r.n_added for r in pii.find_pii(docs_of(spark, rows), rounds=1).collect()}
    assert once[50] == 1 and once[200] == 0
