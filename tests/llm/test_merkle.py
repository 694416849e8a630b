"""Merkle manifest (11) against a plain recomputation."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from surveyspark.llm import merkle
from tests.llm.conftest import DOCS, docs_of


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)])


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def fold(levels, i, digest):
    beside = []
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        beside += run[: i % 8] + run[i % 8 + 1 :]
        digest = h(*run[: i % 8], digest, *run[i % 8 + 1 :])
        i //= 8
    return digest, beside


def brute(rows):
    trees = {}
    for r in rows:
        text = r.text
        if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        trees.setdefault((r.lang is not None, (r.lang or "").encode()), []).append(((r.doc_id is not None, r.doc_id or 0), leaf(r, r.text), leaf(r, text), r.doc_id))
    names = sorted(trees)
    built = {}
    for name in names:
        trees[name].sort(key=lambda x: x[:2])
        built[name] = levels_of([x[1] for x in trees[name]])
    top = levels_of([built[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for i, (_, d, changed, doc_id) in enumerate(trees[name]):
            digest, beside = fold(built[name], i, changed)
            folded, above = fold(top, k, digest)
            out.append((doc_id, d, built[name][-1][0], top[-1][0], h(*beside, *above), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def rows_of(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert df.columns == names
    return sorted(map(tuple, df.collect()), key=str)


def check(docs):
    assert rows_of(merkle.manifest_proofs(docs)) == brute(docs.collect())


def test_trees_of_many_heights(spark):
    """65 leaves need three levels (the last run has one), 8 and 9 stand at the edge, one leaf is its own subroot."""
    rng, rows = random.Random(1), []
    for lang, n in (("en", 65), ("de", 8), ("fr", 9), ("es", 1), (None, 3), ("é/", 2), ("z", 64), ("1/5/", 2), ("", 1)):
        rows += [(rng.randrange(10**6), f"Some Text {rng.random()} É", lang) for _ in range(n)]
    rng.shuffle(rows)
    check(docs_of(spark, rows).repartition(5))


@pytest.mark.parametrize("n", [1, 2, 8, 9])
def test_one_tree_is_the_root(spark, n):
    check(docs_of(spark, [(i, f"Text {i}", "en") for i in range(n)]))


def test_nulls_ties_and_extra_columns(spark):
    rows = [(None, None), (None, "A"), (3, None, "en"), (3, "X Y", "en"), (3, "X Y", "en"), (5, "", "en"), (6, "Long " * 60000, "en"), (-7, "Neg", "en")]
    docs = docs_of(spark, rows).withColumns({c: F.lit("clash") for c in ("tree", "index", "n", "digest", "kids", "up", "pos", "rank", "size", "_at", "root")})
    check(docs)
    assert merkle.manifest_proofs(spark.createDataFrame([], DOCS)).collect() == []


def test_the_groups_rows_lie_in_many_ranges(spark):
    """One group with all rows is numbered right, whatever the ranges."""
    from surveyspark.llm.ranks import ranked

    out = ranked(spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 5003).alias("x")), "g", [F.col("x").desc()]).orderBy("rank").collect()
    assert [r["rank"] for r in out] == list(range(5000)) and [r["x"] for r in out] == sorted((r["x"] for r in out), reverse=True) and {r["size"] for r in out} == {5000}


def test_tampering_is_found(spark):
    """Exactly the leaves whose text changes by lower-casing fail."""
    docs = docs_of(spark, [(i, "Upper" if i % 2 else "lower", "en" if i % 5 else "de") for i in range(200)])
    bad = {r.doc_id for r in merkle.manifest_proofs(docs).filter(~F.col("verified")).collect()}
    assert bad == {i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 3 == 0}
