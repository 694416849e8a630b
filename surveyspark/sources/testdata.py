"""Loaders for the driver's parquet tables and the survey-shaped fixture view.

The driver tables hold no NULLs, so the survey microdata is a deterministic arithmetic view
of ``orders`` (one row per order, ``src`` 0/1/2 assigns the three yearly extracts). It is
plain column arithmetic, so it stays a narrow, pushdown-friendly projection of the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan one table (optionally pruned to ``columns``)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


# Survey columns as SQL expressions over orders (o_orderkey = k, o_custkey = c); parsed once.
_ANSWER_NULL = "(o_orderkey * 13) % 100 < 29"  # the seven answers are NULL on the same rows
SURVEY_COLUMNS = {
    "row_id": "o_orderkey",
    "src": "CAST(o_orderkey % 3 AS INT)",
    "ANIO": "CAST(2019 + o_orderkey % 5 AS INT)",
    "MES": "CAST(1 + o_orderkey % 12 AS INT)",
    "REGION": "CAST(1 + o_custkey % 25 AS INT)",
    "ESTRATO": "CAST(CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE 1 + o_custkey % 5 END AS INT)",
    "OCUP300": ("CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN (o_orderkey * 7919) % 100 < 53 THEN 1 "
                "WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 + o_orderkey % 4 END AS INT)"),
    "INGTOT": "CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice END AS DOUBLE)",
    "C207": "CAST(1 + o_custkey % 2 AS INT)",
    "C208": "CAST(CASE WHEN o_orderkey % 141 = 0 THEN NULL ELSE (o_orderkey * 31 + o_custkey * 17) % 98 END AS INT)",
    "C366": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL ELSE 1 + (o_orderkey * 3 + o_custkey) % 12 END AS INT)",
    "C366_1": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL ELSE (o_orderkey + o_custkey) % 19 END AS INT)",
    "C376": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL WHEN o_custkey % 10 < 7 THEN 10 ELSE 1 + o_custkey % 14 END AS INT)",
    "C377": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL ELSE 1 + (o_custkey + o_orderkey) % 9 END AS INT)",
    "C375_5": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL WHEN o_orderkey % 17 = 0 THEN 1 ELSE 2 END AS INT)",
    "C375_6": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL WHEN o_orderkey % 19 = 0 THEN 1 ELSE 2 END AS INT)",
    "C359": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL WHEN o_custkey % 11 = 0 THEN 2 ELSE 1 END AS INT)",
    "C375_1": f"CAST(CASE WHEN {_ANSWER_NULL} THEN NULL WHEN o_orderkey % 23 = 0 THEN 1 ELSE 2 END AS INT)",
}


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey microdata (raw column names) derived from ``orders`` (narrow projection of the scan)."""
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return o.selectExpr(*[f"{expr} AS {name}" for name, expr in SURVEY_COLUMNS.items()])


def documents_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels: natural NULLs for unlabelled documents (text column pruned)."""
    d = table(spark, sf_dir, "documents", ["doc_id", "lang", "source", "n_chars"])
    lab = table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return d.join(lab, "doc_id", "left")
