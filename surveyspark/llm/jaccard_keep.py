"""One document of each group of near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyspark.llm.common import stored
from surveyspark.llm.jaccard_join import near_duplicates


def keep_one(docs: DataFrame, *, pct: int = 75, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose doc_id is their group's least, with all columns; of rows that share a doc_id the one whose text sorts first. Rows without a doc_id stay."""
    groups = stored(near_duplicates(docs, pct=pct, n=n, id_col=id_col, text_col=text_col).where("doc_id is not null"), "near-duplicate-groups")
    # a node's component is the same for all rows of a doc_id, but for rows without shingles, which stand for themselves
    by_id = groups.groupBy("doc_id").agg(F.min("component_id").alias("c"), F.count("*").alias("n"))
    gone = by_id.where("c <> doc_id").select(F.col("doc_id").alias("_id"))
    kept = docs.join(gone, docs[id_col] == F.col("_id"), "left_anti")
    twice = stored(by_id.where("c = doc_id and n > 1").select(F.col("doc_id").alias("_id")), "repeated-ids")
    if twice.isEmpty():
        return kept
    rows = kept.join(twice, kept[id_col] == F.col("_id"), "left_semi").select(F.struct("*").alias("_row"))
    one = rows.withColumn("_n", F.row_number().over(W.partitionBy(F.col(f"_row.`{id_col}`")).orderBy(F.col(f"_row.`{text_col}`")))).where("_n = 1").select("_row.*")
    return kept.join(twice, kept[id_col] == F.col("_id"), "left_anti").unionByName(one)
