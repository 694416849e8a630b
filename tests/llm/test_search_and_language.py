"""Top-k search (6) against brute force; language ID (7) by held-out accuracy; decontamination (8) on planted passages."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyspark.llm import decontaminate, language_id, topk_search
from surveyspark.llm.catalog import op6_topk_search, op7_language_id, op8_decontaminate
from tests.llm.conftest import DOCS, docs_of

SF = "/root/testdata/sf0.01"


def brute_top(rows, k, query):
    fine = {(i, tuple(np.floor(1024 * np.array(v, dtype=np.float64)).astype(int))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, a in fine:
        if query(q):
            found = sorted((-int(np.dot(a, b)), j) for j, b in fine if j != q and len(a) == len(b))[:k]
            out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def test_topk_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert sorted(map(tuple, op6_topk_search(spark, "/root/testdata/sf0.001").collect())) == brute_top(rows, 10, lambda i: i % 100 == 0)


def test_topk_edge_cases(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(300)]
    rows += [(400 + i, [0.5] * 6) for i in range(200)] + [(5, rows[5][1]), (700, None), (800, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (900, [float("nan")] * 6), (1000, [float("inf")] * 6), (1100, []), (1200, [1.0, 2.0]), (1300, [0.0] * 6), (None, [0.5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit("clash"), "block": F.lit(1), "query_id": F.lit(2)})
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = topk_search.top_k(df, pivots=4, annuli=3, sample=50, block_rows=40, block_queries=2, rounds=(1, 3, None))
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10, lambda i: i % 100 == 0)
    assert topk_search.top_k(df.limit(0)).collect() == []
    two = df.where("vec_id in (100, 1)")
    assert sorted(map(tuple, topk_search.top_k(two).collect())) == brute_top([r for r in rows if r[0] in (100, 1)], 10, lambda i: i % 100 == 0)


def test_language_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op7_language_id(spark, SF).collect()
    assert len(got) == len(docs)
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    letters = [r for r in out if language_id.has_letter(docs[r.doc_id].text)]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in letters]) > 0.97
    assert all((r.lang_pred == "und") == (not language_id.has_letter(docs[r.doc_id].text)) for r in got)


def test_language_edge_cases(spark):
    rows = [(i, f"the thing and that {i} was here " * 3, "en") for i in range(20)] + [(50 + i, f"les choses et que {i} était là " * 3, "fr") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "fr"), (202, "123 !?", "en"), (203, "the", None), (None, "les choses", "fr"), (204, "the thing " * 40_000, None), (203, "the", None)]
    docs = docs_of(spark, rows).withColumn("held_out", F.lit("clash"))
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert [got[i].lang_pred for i in (200, 201, 202, 203, None, 204)] == ["und", "und", "und", "en", "fr", "en"]
    assert got[None].held_out is False
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert language_id.identify(spark.createDataFrame([], DOCS)).collect() == []
    none = language_id.identify(docs_of(spark, [(1, "word")])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    one = language_id.identify(docs_of(spark, [(1, "word", "xx"), (3, "word", "xx"), (4, "other", None)])).collect()
    assert {r.lang_pred for r in one} == {"xx"}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20])
def test_codewords(n):
    code = language_id.codewords(n)
    least = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
    assert (np.abs(code.sum(0)) < n).all() and least >= (1 if n == 2 else 2)


def brute_align(a, b):
    h, best = np.zeros((len(a) + 1, len(b) + 1), dtype=int), 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
            best = max(best, h[i, j])
    return best


def test_alignment():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = (rng.integers(0, 5, int(rng.integers(0, 25))).astype(np.uint64) for _ in range(2))
        assert decontaminate.align(a, b) == brute_align(a, b)


def test_decontaminate_query(spark):
    """All documents that hold an item's words are found; what is found aligns by brute force."""
    import re

    words = lambda t: re.findall(r"\w+", t.lower())
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in op8_decontaminate(spark, SF).collect()}
    exact = {(d, i) for d, t in docs.items() for i, w in items.items() if len(w) >= 3 and f" {' '.join(w)} " in f" {' '.join(t)} "}
    assert exact and exact <= set(got) and all(got[k].score == 1 for k in exact)
    for (d, i), r in got.items():
        a, t = items[i], docs[d]
        low = max(r.first_word - len(a) - 8, 0)
        assert brute_align(a, t[low : r.first_word + 2 * len(a) + 8]) / (2 * len(a)) >= r.score - 1e-9 >= 0.5 - 1e-9


def test_decontaminate_edited_and_edge_cases(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [[word() for _ in range(40)] for _ in range(6)]
    noise = lambda n: [word() for _ in range(n)]
    edited = list(items[1])
    for k in range(5, 40, 6):
        edited[k] = "other"
    shorter = items[2][:15] + items[2][20:]
    rows = [(1, noise(50) + items[0] + noise(50)), (2, noise(9) + edited), (3, shorter + noise(30)), (4, noise(100)), (5, items[3][:6] + noise(50)), (6, noise(30_000) + items[4] + noise(10))]
    rows = [(i, " ".join(w)) for i, w in rows] + [(7, None), (8, ""), (9, ", ".join(items[5]).upper()), (1, rows and " ".join(items[0])), (None, " ".join(items[0]))]
    bench = spark.createDataFrame([*((i, " ".join(w)) for i, w in enumerate(items)), (10, None), (11, ""), (12, "two words"), (None, " ".join(items[5]))], "item_id long, text string").withColumn("score", F.lit(1))
    docs = docs_of(spark, rows).withColumn("item_id", F.lit("clash"))
    for block in (8 << 20, 300):
        got = decontaminate.contaminated(docs, bench, block_bytes=block).collect()
        assert sorted((r.doc_id or 0, -1 if r.item_id is None else r.item_id) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 1), (3, 2), (6, 4), (9, -1), (9, 5)]
        kept = decontaminate.drop_contaminated(docs, bench, block_bytes=block)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 7, 8]
    assert decontaminate.contaminated(spark.createDataFrame([], DOCS), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []


def test_decontaminate_edited_copies_in_many_documents(spark):
    """The only seeds that an edited item keeps count as well where hundreds of documents hold the same copy."""
    items = [[f"i{k}w{j}" for j in range(40)] for k in range(2)]
    edited = [w if k % 4 else "other" for k, w in enumerate(items[0], 1)]
    copies, once = [(i, " ".join([f"d{i}x{j}" for j in range(30)] + edited)) for i in range(300)], (300, " ".join(items[1]))
    docs = docs_of(spark, [*copies, once, (301, " ".join(f"n{j}" for j in range(60)))])
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, bench).collect()}
    few = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs.where("doc_id in (0, 300)"), bench).collect()}
    assert set(got) == {(i, 0) for i in range(300)} | {(300, 1)} and few == {k: got[k] for k in ((0, 0), (300, 1))}
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()] == [301]


def test_decontaminate_best_passage_whatever_is_rare():
    """The bound rules out no alignment, and which seeds are rare changes no row."""
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (rng.integers(0, 9, int(rng.integers(0, 25))).astype(np.uint64) for _ in range(2))
        assert decontaminate.bound(a, b) >= decontaminate.align(a, b)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 4, 25)) for _ in range(5)]
    seeds = decontaminate.Seeds(list(enumerate(texts)), 3)
    for _ in range(40):
        words = seeds.read(" ".join(f"w{k}" for k in rng.integers(0, 9, 300)))
        words[50:65], words[200:220] = seeds.words[0][:15], seeds.words[0][5:]
        want = None
        for _ in range(3):
            got = decontaminate.matches(seeds, words, 0.3)
            assert got and (want is None or got == want)
            want, seeds.rare = got, rng.random(len(seeds.hash)) < 0.5


def test_texts_far_from_every_codeword_go(spark):
    """The filter decides by the least loss: noise, other scripts and texts without a letter go, held-out clean ones stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = ["zzkq xxvw qqpt jjkz wwxq", "#### a ==== %%%% 1234 ;;;; ####", "これは日本語の文章です。今日は天気がいいですね。", "qwrtp sdfgh zxcvb mnbvc lkjhg poiuy trewq", "12 34", "", None]
    rows = [(10**6 + i, t, None, "s", 0) for i, t in enumerate(odd)]
    more = docs.unionByName(spark.createDataFrame(rows, DOCS).select(*[F.col(f.name).cast(f.dataType) for f in docs.schema.fields]))
    kept = {r.doc_id for r in language_id.keep_identified(more).collect()}
    clean = {r.doc_id for r in docs.collect() if language_id.has_letter(r.text)}
    assert kept == clean
    one = language_id.keep_identified(docs_of(spark, [(1, "abc def", "en"), (3, "zzkq 1", "en"), (4, "12", "en")])).collect()
    assert {r.doc_id for r in one} == {1, 3}
    assert language_id.keep_identified(docs_of(spark, [(1, "abc", None)])).collect() == []


def test_language_model_and_bound_come_from_all_rows(spark):
    """Every labelled row is learned from or bounds the filter, however many a language has."""
    rows = [(i, f"the word {i * 7919 % 10007} of {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}", "en") for i in range(9000)]
    rows += [(9000 + i, f"das wort {i} von {chr(97 + i % 26)}", "de") for i in range(40)]
    docs = docs_of(spark, rows)
    held = {r.doc_id for r in docs.where(language_id.held_out(F.col("doc_id"))).collect()}
    counts = np.zeros((2, 1 << language_id.BITS))
    for i, text, lang in rows:
        if i not in held:
            for codes in language_id.ngram_codes(text.encode().lower()):
                np.add.at(counts[int(lang == "en")], codes, 1)
    want, got = language_id.fit(["de", "en"], counts), language_id.train(docs)
    assert got.langs == want.langs and np.allclose(got.weights, want.weights) and np.allclose(got.bias, want.bias)
    far = max(want.distance(t) for i, t, _ in rows if i in held)
    assert abs(language_id.farthest(want, docs) - far) < 1e-12


def test_kept_rows_are_identified(spark):
    """The filter identifies each row as ``identify`` does: a row without a lang leaves with the one it was identified as."""
    rows = [(i, f"the thing and that {i} was here " * 3, "en") for i in range(40)] + [(50 + i, f"les choses et que {i} était là " * 3, "fr") for i in range(40)]
    rows += [(200, "the thing and that was here", None), (201, "les choses et que était là", None), (None, "les choses", None), (202, "les choses et que", "en"), (203, "12", None), (200, "the thing and that was here", None)]
    docs = docs_of(spark, rows)
    found = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    given = {i: lang for i, _, lang in rows}
    kept = language_id.keep_identified(docs).collect()
    assert len(kept) == len(rows) - 1 and all(r.lang == (given[r.doc_id] or found[r.doc_id]) for r in kept)
    assert {r.doc_id: r.lang for r in kept if r.doc_id is None or r.doc_id >= 200} == {200: "en", 201: "fr", None: "fr", 202: "en"}
