"""Exact order statistics by counted ranges.

The k-th smallest value of a group is found by counting, never by sorting a group:

* A first pass counts each group's values by coarse buckets, about 256 to each doubling of the size of a value. The
  bucket of a number is a monotone function of it, so the buckets are ranges; each also keeps its least and greatest
  value, in the column's own type.
* Prefix sums over a group's buckets (a small table) give the bucket that holds rank k. If its least and greatest value
  agree, that is the answer: columns with few values need no second pass.
* Otherwise the next pass counts only the values between the two: each of them if there are few, else in 65,536 ranges
  between them, so the least and the greatest part ways every time.

Buckets only route; comparisons, least and greatest values are exact in the column's type, so integers beyond 2^53,
decimals and dates lose no digit. Map-side counting bounds what a hot group sends: a row for each bucket, not each value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from surveyspark.operators.reshape import null_safe_join
from surveyspark.session import BROADCAST_MAX_BYTES, reliable_checkpoint, row_bytes

ALL = "_all"                 # stands for the key where there are no groups
OCTAVE = 256                 # coarse buckets for each doubling
FINE = 1 << 16               # ranges of a later pass
SELECT_MIN_ROWS = 100_000    # a bucket with as many rows at most is read off value by value


def number_of(col: Column, kind: T.DataType) -> Column:
    """The column as a number in the same order: days of a date, microseconds of a timestamp."""
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"no order statistic of {kind.simpleString()}")
    return col


def value_of(col: Column, kind: T.DataType) -> Column:
    """The statistic's type: the column's own where a double would lose digits or meaning, else double."""
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(col.cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(col)
    return col if isinstance(kind, (T.LongType, T.DecimalType)) else col.cast("double")


def coarse_bucket(v: Column) -> Column:
    """A monotone bucket (int) of any number; NaN comes last."""
    d = v.cast("double")
    size = F.floor((F.log(F.abs(d)) + 746.0) * (OCTAVE / math.log(2.0))).cast("int")  # the least double has log -744.4
    sign = F.signum(d).cast("int")
    return (F.when(F.isnan(d), F.lit(1 << 21)).when(d == 0, F.lit(0))
            .when(F.abs(d) == float("inf"), sign * (1 << 20)).otherwise(sign * size))


def fine_bucket(v: Column, lo: Column, hi: Column, kind: T.DataType) -> Column:
    """One of FINE + 1 ranges between ``lo`` and ``hi`` (monotone); NULL if they are too near to each other for that."""
    if isinstance(kind, T.IntegralType):
        v, lo, hi = (c.cast("decimal(20,0)") for c in (v, lo, hi))  # a long's range does not fit a long
    width = (hi - lo).cast("double")
    return F.floor(F.try_divide((v - lo).cast("double"), width) * FINE).cast("int")


def ranked_bucket(counts: DataFrame, keys: list[str], order: list[str], rank: Column) -> DataFrame:
    """Per key tuple the bucket that holds rank ``rank`` (a Column over ``_c`` counts and ``_n`` = rows of the key):
    (_k = rank inside it, _lo, _hi, _m = its rows). The window runs over a key's bucket counts, not over rows."""
    of_key = Window.partitionBy(*keys)
    upto = of_key.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = counts.withColumns({"_n": F.sum("_c").over(of_key), "_cum": F.sum("_c").over(upto)}).withColumn("_r", rank)
    x = x.filter((F.col("_cum") >= F.col("_r")) & (F.col("_cum") - F.col("_c") < F.col("_r")))
    return x.select(*keys, (F.col("_r") - F.col("_cum") + F.col("_c")).cast("bigint").alias("_k"), "_lo", "_hi", F.col("_c").alias("_m"))


def quantile_rank(q: float) -> Column:
    return F.greatest(F.ceil(F.lit(float(q)) * F.col("_n")), F.lit(1))


def coarse_counts(src: DataFrame, keys: list[str]) -> DataFrame:
    """First pass over (keys, _v): rows, least and greatest value of each coarse bucket."""
    return src.groupBy(*keys, coarse_bucket(F.col("_v")).alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))


def select_rank(src: DataFrame, keys: list[str], counts: DataFrame, rank: Column, small: int | None = None) -> tuple[DataFrame, int]:
    """(table, bytes): per key tuple the value ``_lo`` of rank ``rank``, from the materialised coarse ``counts`` of ``src``.

    Each further pass reads only open groups' values inside their bucket. The last one is left lazy; ``bytes`` bounds
    the table."""
    small = SELECT_MIN_ROWS if small is None else small
    kind = src.schema["_v"].dataType
    state = ranked_bucket(counts, keys, ["_b"], rank)
    done, size = None, None
    while True:
        facts = state.agg(F.sum(row_bytes(state)).alias("bytes"), F.max(F.when(F.col("_lo") != F.col("_hi"), F.col("_m"))).alias("open")).first()
        size = size or facts["bytes"] or 0
        solved = state.filter(F.col("_lo") == F.col("_hi")).select(*keys, "_lo")
        done = solved if done is None else done.unionByName(solved)
        if facts["open"] is None:
            return done, size
        left = state.filter(F.col("_lo") != F.col("_hi"))
        if keys == [ALL]:  # one row, which enters as a scalar
            names = [c for c in left.columns if c != ALL]
            inside = src.withColumn("_st", left.select(F.struct(*names)).scalar()).select(ALL, "_v", "_st.*")
        else:
            inside = null_safe_join(src, F.broadcast(left) if facts["bytes"] <= BROADCAST_MAX_BYTES else left, keys)
        inside = inside.filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        fine = F.when(F.col("_m") > small, fine_bucket(F.col("_v"), F.col("_lo"), F.col("_hi"), kind))
        cut = inside.withColumns({"_b": fine, "_x": F.when(fine.isNull(), F.col("_v"))})
        again = cut.groupBy(*keys, "_b", "_x").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.first("_k").alias("_k"))
        if facts["open"] <= small:  # every value left is counted by itself: the last pass
            last = ranked_bucket(again, keys, ["_b", "_x"], F.col("_k"))
            return done.unionByName(last.select(*keys, "_lo")), size
        state = ranked_bucket(reliable_checkpoint(again), keys, ["_b", "_x"], F.col("_k"))


def quantile_table(df: DataFrame, groups: list[str], col: str, q: float = 0.5, where: Column | None = None,
                   alias: str = "mediana", small: int | None = None) -> tuple[DataFrame, int]:
    """Exact discrete quantile per group (= ``percentile_disc(q)``) and a bound of the table's bytes.

    NULL values are left out, a NULL group key is a group of its own, NaN is the greatest value; a group without values
    has no row. BIGINT, decimal, date and timestamp columns keep their type, other numbers give a double."""
    keys = list(groups) or [ALL]
    kind = df.schema[col].dataType
    src = df if groups else df.withColumn(ALL, F.lit(0))
    src = src.filter(F.col(col).isNotNull())
    if where is not None:
        src = src.filter(where)
    src = src.select(*keys, number_of(F.col(col), kind).alias("_v"))
    table, size = select_rank(src, keys, reliable_checkpoint(coarse_counts(src, keys)), quantile_rank(q), small)
    return table.select(*groups, value_of(F.col("_lo"), kind).alias(alias)), size


__all__ = ["SELECT_MIN_ROWS", "coarse_bucket", "coarse_counts", "fine_bucket", "number_of", "quantile_rank", "quantile_table",
           "ranked_bucket", "select_rank", "value_of"]
