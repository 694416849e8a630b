"""Structured Streaming scoring of arriving answer records (M17 on a stream).

A single-record answer form scores one record at a time. Here records arrive as files in a directory. Coded rows can be
scored by a stateless query into the file sink (``score_stream_to_table``). Answers as the form sends them, with labels
and numbers as text, are decoded in the stream too (C11, C12): each micro-batch gives scored and rejected records, and
each of the two is written to a folder of that batch (``score_answers_stream``). A batch that is run again after a
failure replaces its own folders and touches no other: both tables hold every record once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from surveyspark.functions import codebooks as cb
from surveyspark.operators.ml import score
from surveyspark.plans.jobs import score_answers
from surveyspark.sources.files import path_exists

BATCH_COL = "lote"


def score_stream(model, stream: DataFrame, label_out: str = "prediccion") -> DataFrame:
    """Apply a fitted classifier pipeline to a streaming DataFrame (stateless stages only)."""
    return score(model, stream, label_out)


def score_stream_to_table(spark: SparkSession, model, src_dir: str, schema: T.StructType, out_dir: str,
                          checkpoint_dir: str, fmt: str = "parquet", keep: list[str] | None = None) -> DataFrame:
    """Score every file currently in ``src_dir`` (availableNow trigger) into ``out_dir``.

    Returns the batch view of the output table.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(src_dir)
    scored = score_stream(model, stream)
    cols = (keep or [c for c in schema.fieldNames()]) + ["prediccion", "probabilidades"]
    query = (scored.select(*cols).writeStream.format("parquet").option("path", out_dir)
             .option("checkpointLocation", checkpoint_dir).outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out_dir)


def answer_tables(model, answers: DataFrame, numeric: list[str] = cb.MODEL_NUMERIC) -> dict[str, DataFrame]:
    """"scored": the answers in codes with prediction and ``p_<class>``; "rejected": the others as given, with ``errores``."""
    out = score_answers(model, answers, numeric)
    probabilities = [c for c in out["scored"].columns if c.startswith("p_") and c not in answers.columns]
    return {"scored": out["scored"].select(*answers.columns, "prediccion", *probabilities), "rejected": out["rejected"]}


def answer_sink(model, out_dir: str, numeric: list[str] = cb.MODEL_NUMERIC) -> Callable[[DataFrame, int], None]:
    """The two-table sink of a micro-batch. Writing a batch again replaces what it wrote before."""
    def write(batch: DataFrame, batch_id: int) -> None:
        for name, table in answer_tables(model, batch, numeric).items():
            table.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}/{BATCH_COL}={batch_id}")
    return write


def read_answers(spark: SparkSession, model, schema: T.StructType, out_dir: str,
                 numeric: list[str] = cb.MODEL_NUMERIC) -> dict[str, DataFrame]:
    """Both tables as written so far, with the micro-batch that wrote a record (``lote``); empty ones before the first."""
    empty = answer_tables(model, spark.createDataFrame([], schema), numeric)
    tables = {}
    for name, table in empty.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        columns = T.StructType([*table.schema.fields, T.StructField(BATCH_COL, T.LongType())])
        there = path_exists(spark, path)
        tables[name] = spark.read.schema(columns).parquet(path) if there else spark.createDataFrame([], columns)
    return tables


def score_answers_stream(spark: SparkSession, model, src_dir: str, schema: T.StructType, out_dir: str, checkpoint_dir: str,
                         fmt: str = "parquet", numeric: list[str] = cb.MODEL_NUMERIC, files_per_batch: int | None = None) -> dict[str, DataFrame]:
    """C11 -> C12 -> M17 on every answer file that has arrived since the last call (availableNow; ``files_per_batch`` at a
    time). Returns the two tables "scored" and "rejected" (``read_answers``).

    The checkpoint remembers which files belong to which batch, so a batch that failed midway runs again with the same
    number and the same files. Nulls: a NULL label stays NULL (the model's ``handleInvalid`` decides), a NULL number is
    rejected; records that agree are scored each."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.load(src_dir).writeStream.foreachBatch(answer_sink(model, out_dir, numeric))
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    return read_answers(spark, model, schema, out_dir, numeric)


__all__ = ["answer_sink", "answer_tables", "read_answers", "score_answers_stream", "score_stream", "score_stream_to_table"]
