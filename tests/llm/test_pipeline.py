"""The pipeline: columns, and each stage's decisions on its own input."""

import re

import corpus_pipeline
from surveyspark.llm import language_id
from tests.llm.conftest import docs_of
from tests.llm.test_jaccard_join import brute as brute_groups
from tests.llm.test_pii import brute as brute_pii

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, held = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        held[name] = docs
        docs = stage(spark, docs, SF)
        assert name == "sentencepiece" or docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = {name: {r.doc_id: r for r in d.collect()} for name, d in held.items()}
    after = list(rows.values())[1:]
    assert set(after[0]) == {i for i, r in rows["language_id"].items() if language_id.has_letter(r.text)}
    groups = brute_groups([(i, r.text) for i, r in rows["ngram_jaccard_join"].items()])
    assert set(after[1]) == {c for _, _, c in groups}
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    flat = {i: " ".join(re.findall(r"\w+", r.text.lower())) for i, r in rows["benchmark_decontamination"].items()}
    leaked = {i for i, t in flat.items() if any(f" {w} " in f" {t} " for w in items if len(w.split()) >= 3)}
    assert leaked and not leaked & set(after[2]) and len(after[2]) > 0.8 * len(after[1])
    assert set(after[3]) == set(after[2])
    for i, r in after[3].items():
        assert not brute_pii(r.text) and r.n_chars == len(r.text)
        if not brute_pii(after[2][i].text) and "[" not in r.text:
            assert r.text == after[2][i].text
    assert {r.doc_id for r in docs.collect()} == set(after[3])


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and got.count() > 100


def test_empty(spark):
    docs = docs_of(spark, []).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
