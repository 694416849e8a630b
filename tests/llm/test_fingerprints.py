"""Fingerprints (13): likeness from peeled sketches against sets of paragraphs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from surveyspark.llm import fingerprints as fp
from tests.llm.conftest import DOCS, docs_of


def paragraphs(text):
    return set(re.findall(fp.PARAGRAPH, text))


def jaccard(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """Rows with distinct (id, text) only need an order of ids here."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, t) in enumerate(rows):
        nxt, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(t, edited), jaccard(t, nxt))
    return out


def prose(rng, n):
    return "".join("".join(rng.choice("abc dé🙂f ") for _ in range(rng.randint(0, 300))) + rng.choice([". ", "!", "\n", "\n\n\n", "?? "]) for _ in range(n))


@pytest.mark.parametrize("bucket_rows", [1, 3, 7, 1000])
def test_against_sets_of_paragraphs(spark, bucket_rows):
    rng = random.Random(bucket_rows)
    rows = [(i * 7 - 50, prose(rng, rng.choice([0, 1, 2, 9, 60, 400]))) for i in range(40)]
    base = rows[20][1]
    rows += [(1001, base), (1000, base + "One more."), (999, base), (500, None), (501, ""), (502, "x"), (None, "a\nb\nc"), (2**62, "..!?\n" * 90), (-(2**63) + 1, "y" * 5000)]
    docs = docs_of(spark, rows).withColumns({c: F.lit("clash") for c in ("id", "hash", "bucket", "b", "copy", "next", "edited", "n")}).repartition(4)
    got = fp.fingerprints(docs, bucket_rows=bucket_rows).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_chars, r.edited_sha256) == want[r.doc_id][:2]
        assert (r.near_edited, r.near_next) == pytest.approx(want[r.doc_id][2:], abs=1e-12)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[1001] == prints[999] != prints[1000] and prints[500] == prints[501]
    assert len(set(prints.values())) == len({tuple(sorted(paragraphs(t or ""))) for _, t in rows})


def test_repeated_rows_one_row_and_none(spark):
    rows = [(5, "A. B. C."), (5, "A. B. C."), (5, "Another text."), (4, "A. B. C."), (3, "Z")]
    got = fp.fingerprints(docs_of(spark, rows), bucket_rows=1).collect()
    assert len(got) == 5 and all(0 <= r.near_next <= 1 for r in got)
    copies = sorted((r.near_next for r in got if r.doc_id == 5 and r.n_chars == 8), reverse=True)
    assert copies[0] == 1.0  # a copy's next is the other copy
    one = fp.fingerprints(docs_of(spark, [(1, "Only. One.")])).collect()[0]
    assert (one.near_next, one.near_edited) == (1.0, jaccard("Only. One.", "Only." + "Only."))
    assert fp.fingerprints(spark.createDataFrame([], DOCS)).collect() == []


def test_small_sketch_peels_and_larger_ones_when_it_cannot(spark):
    """The fingerprints' own cells give small differences; beyond their cells they do not peel, and larger sketches do."""
    rng = random.Random(4)
    rows = []
    for apart in (0, 1, 3, 30, 3000):
        both = [f"p{rng.randrange(10**12)}." for _ in range(500)]
        rows.append((apart, "".join(both + [f"a{rng.randrange(10**12)}." for _ in range(apart)]), "".join([f"b{rng.randrange(10**12)}." for _ in range(2 * apart)] + both)))
    df = spark.createDataFrame(rows, "apart int, a string, b string").select("apart", fp.digests(F.col("a")).alias("a"), fp.digests(F.col("b")).alias("b"))
    small = fp.peeled(fp.minus(fp.sketch("a"), fp.sketch("b")), f"{fp.CELLS}L", "1")
    got = {r.apart: r for r in df.select("apart", F.expr(small).alias("s"), F.expr(fp.differing("a", "b")).alias("d")).collect()}
    for apart, r in got.items():
        assert (r.d.ok, r.d.a, r.d.b) == (True, apart, 2 * apart)
        assert r.s.ok == (apart <= 3) and (not r.s.ok or (r.s.a, r.s.b) == (apart, 2 * apart))


def test_no_python_on_the_way(spark):
    plan = fp.fingerprints(docs_of(spark, [(1, "a"), (2, "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
