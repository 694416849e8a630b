"""N-gram Jaccard join (4) against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyspark.llm import jaccard_join as jj
from surveyspark.llm.jaccard_keep import keep_one
from tests.llm.conftest import DOCS, docs_of


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def brute(rows, pct=75):
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= pct * len(s | t):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {(i, len(s), None if i is None else root(i) if s else i) for i, s in sets}


def near_copies(rng, n_base, n_copies, size):
    """Texts and copies with a few words changed, cut or added; every second group shares a passage."""
    words = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    out = []
    for b in range(n_base):
        base = [rng.choice(words) for _ in range(rng.randint(*size))]
        if b % 2:
            base = base + passage.split()
        for _ in range(rng.randint(1, n_copies)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                k = rng.randrange(len(copy))
                copy[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(words)], [rng.choice(words)] * 2])
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize(("seed", "size"), [(1, (1, 14)), (2, (20, 60)), (3, (100, 300))])
def test_against_brute_force(spark, seed, size):
    texts = near_copies(random.Random(seed), 25, 6, size)
    rows = list(enumerate(texts))
    got = jj.near_duplicates(docs_of(spark, rows).repartition(3)).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(rows)


def test_every_linked_pair_shares_a_signature():
    """The pigeonhole: of random sets that link, none is left without a common signature, with any costs."""
    rng = np.random.default_rng(5)
    sketch, linked = rng.integers(0, 3, 1 << jj.SKETCH_BITS), 0
    for _ in range(4000):
        n = int(rng.integers(1, 120))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate((a[rng.random(n) > rng.random() * 0.3], rng.integers(0, 1 << 63, int(rng.integers(0, 2 + n // 8)), dtype=np.uint64)))
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 75 * (len(a) + len(b) - common) and common < max(len(a), len(b)):
            linked += 1
            sig = [{(int(s), bool(f)) for band in jj.bands(len(x), 75) for s, f in zip(*jj.signatures(x, band, 75, sketch)[:2], strict=True)} for x in (a, b)]
            shared = {s for s, _ in sig[0]} & {s for s, _ in sig[1]}
            assert any((s, True) in sig[0] or (s, True) in sig[1] for s in shared), (len(a), len(b), common)
    assert linked > 500


def test_linked_sets_share_as_many_signatures_as_asked_for(spark):
    """The bound behind the last round's filter, with any costs."""
    rng = np.random.default_rng(6)
    sketch, rows = rng.integers(0, 3, 1 << jj.SKETCH_BITS), []
    for _ in range(3000):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(6, 400)), dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > rng.random() * 0.25], rng.integers(0, 1 << 63, int(rng.integers(0, 2 + len(a) // 6)), dtype=np.uint64))))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 75 * (len(a) + len(b) - common):
            sig = [{int(s) for band in jj.bands(len(x), 75) for s in jj.signatures(x, band, 75, sketch)[0]} for x in (a, b)]
            rows.append((len(a), len(b), len(sig[0] & sig[1])))
    df = spark.createDataFrame(rows, "a long, b long, shared long").withColumn("least", jj.common_least(F.col("a"), F.col("a"), F.col("b"), F.col("b"), 75))
    assert len(rows) > 500 and df.where("shared < least").count() == 0 and df.where("least > 3").count() > 100


def test_edge_cases(spark):
    long = " ".join(f"x{k}" for k in range(20_000))
    rows = [(9, None), (8, ""), (7, " \t\n "), (6, "one two"), (5, "One  TWO"), (4, "a b c d e"), (3, "a b c d e f"), (2, long), (12, long + " y"), (None, "a b c d e"), (4, "a b c d e"), (1, "É b"), (0, "é b"), (20, "a a a a a a"), (21, "a a a a a")]
    docs = docs_of(spark, rows).withColumns({"sig": F.lit("clash"), "node": F.lit(1), "component": F.lit(1)})
    got = jj.near_duplicates(docs).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(rows)
    assert jj.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    up = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if up[a] is not up[b]:
            up[a] |= up[b]
            for x in up[a]:
                up[x] = up[a]
    got = {r.id: r.component for r in jj.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: min(up[x]) for a, b in edges if a != b for x in (a, b)}


def test_keep_one(spark):
    rows = [(1, "a b c d e f g h i j k l"), (2, "a b c d e f g h i j k l"), (2, "a b c d e f g h i j k l"), (3, "z y x"), (3, "z y x"), (4, None), (5, ""), (None, "z y x"), (6, "q w")]
    got = sorted((r.doc_id or 0, r.text or "") for r in keep_one(docs_of(spark, rows)).collect())
    assert got == [(0, "z y x"), (1, rows[0][1]), (3, "z y x"), (4, ""), (5, ""), (6, "q w")]


def test_doc_ids_with_different_texts(spark):
    """A doc_id's texts are one node, also where another document with a lesser doc_id holds one of them."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(3, c), (5, b), (5, c), (8, b + " more"), (9, d), (2, d), (9, a), (9, b), (7, a + " more"), (11, "none of them at all, by any means")]
    got = jj.near_duplicates(docs_of(spark, rows)).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == len(rows)
    assert {r.component_id for r in got} == {2, 11}


def test_pairs_of_a_large_group_are_not_rows(spark, monkeypatch):
    """Sets that share a passage but do not link, and near copies, in clusters cut into blocks: one row for each set and block, no row for a pair."""
    monkeypatch.setattr(jj, "BLOCK_SETS", 16)
    rng, passage = random.Random(8), [f"p{k}" for k in range(60)]
    texts = [" ".join(passage + [f"{b}x{k}" for k in range(21)]) for b in range(60)]  # 56 of 77 shingles in common: a share of 0.57
    texts += [t + " and" for t in texts[:40]] + near_copies(rng, 5, 30, (40, 60))
    docs = docs_of(spark, list(enumerate(texts))).repartition(4)
    assert {tuple(r) for r in jj.near_duplicates(docs).collect()} == brute(list(enumerate(texts)))
    profile = jj.profiles(jj.id_and_text(docs, "doc_id", "text"), 5, 75).where("shingles is not null")
    sets = profile.dropDuplicates(["d1", "d2"]).select(F.col("doc_id").alias("node"), "n", "shingles", "ranks").cache()
    assert jj.linked(sets, 75).count() <= sets.count() * 12


def test_links_are_a_forest():
    """Of 200 sets that all link, 199 rows; of two sides, only links across."""
    sets = [np.arange(100, dtype=np.uint64)] * 200
    assert len(jj.links(list(range(200)), [100] * 200, sets, [0] * 200, 75)) == 199
    across = jj.links([1, 2, 3, 4], [100] * 4, sets[:4], [0, 0, 1, 1], 75)
    assert len(across) == 3 and all(a < 3 <= b for a, b in across)


def test_shingles_that_do_not_recur(spark):
    """They are differences, so a set of which too few recur is left out, and the others keep their own number of shingles."""
    rows = [(k, " ".join([f"a{i}" for i in range(44)] + [f"{k}y{i}" for i in range(extra)])) for k, extra in enumerate((0, 1, 5, 6, 12, 13, 14, 30))]
    got = jj.near_duplicates(docs_of(spark, rows)).collect()
    assert {tuple(r) for r in got} == brute(rows)
    kept = {r.doc_id for r in jj.profiles(jj.id_and_text(docs_of(spark, rows), "doc_id", "text"), 5, 75).where("shingles is not null").collect()}
    assert kept == {0, 1, 2, 3, 4, 5}
