"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. ``language_id`` identifies each document's language, fills a missing ``lang`` with it and drops documents without one.
2. ``ngram_jaccard_join`` keeps one document of each group of near-duplicates.
3. ``benchmark_decontamination`` drops documents that hold a benchmark item.
4. ``pii`` masks personal data and sets n_chars anew.
5. ``sentencepiece`` encodes and decodes what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.llm.common import read_table, stored
from surveyspark.llm.decontaminate import drop_contaminated
from surveyspark.llm.jaccard_keep import keep_one
from surveyspark.llm.language_id import keep_identified
from surveyspark.llm.pii import mask_pii
from surveyspark.llm.piece_codec import encode_decode

PIECE_BPE = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_pii(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, public_tokenizers.path(PIECE_BPE), columns=("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]

#: SQL has no language models, alignments or merges; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
