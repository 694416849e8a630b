"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.session import scratch_path

#: Rows and text bytes that a Python function handles at a time.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that nearby sums become unrelated hashes."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Odd multipliers of the positions in a word n-gram, unrelated to each other (multiples of one number would let
#: ``a a a b b`` and ``b b b b a`` collide).
_ODD = mix(np.arange(1, 65, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the corpus, read by Spark wherever it lies."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again (cuts lineage; survives executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, under fixed names: further columns cannot clash with its own."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to BATCH_ROWS rows and about BATCH_BYTES of text, for bounded worker memory."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + BATCH_BYTES, side="right"))
            stop = min(max(stop, start + 1), start + BATCH_ROWS, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 250, size: int = 1 << 20):
    """What Spark runs inside hands Python batches of so many rows and bytes: the usual 10,000 whole texts would lie in the memory of both."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {name: spark.conf.get(name) for name in limits}
    try:
        for name, limit in limits.items():
            spark.conf.set(name, str(limit))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Memo(dict):
    """A dict that computes missing values by ``make``. ``trim`` bounds it: beyond ``limit`` entries only those
    that are asked for again stay. Strings longer than ``longest`` are computed each time."""

    def __init__(self, make: Callable, limit: int = 600_000, longest: int | None = None):
        super().__init__()
        self.make, self.limit, self.longest, self.before = make, limit, longest, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
            if self.longest is not None and len(key) > self.longest:
                return value
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.before = dict(self)
            self.clear()


def word_memo() -> Memo:
    """word bytes -> 64-bit hash, the same in every worker."""
    return Memo(xxhash.xxh3_64_intdigest)


def word_hashes(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), dtype=_U, count=len(words))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` consecutive words, in order; empty if there are fewer words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, dtype=_U)
    total = hashes[:m] * _ODD[0]
    for i in range(1, n):
        total = total + hashes[i : i + m] * _ODD[i]
    return mix(total + _U(n))


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
