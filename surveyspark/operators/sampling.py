"""Sampling and splitting by key hash (K1-K5).

``sample`` / ``randomSplit`` depend on partitioning, so every operator here decides with
``key_hash(key, seed)`` -- an 8-hex-digit md5 prefix that is identical in any engine and
under any repartitioning.

Exact ranks inside a class (stratified split, balanced folds) are computed without a
one-task window over the class: rows are spread over 16**5 hash-prefix buckets, the
bucket sizes give each bucket's rank offset (a two-level prefix sum: <= 4,096 rows per
task), and ``row_number`` runs only inside one (class, bucket) -- about n / 16**5 rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from surveyspark.functions.expressions import hex_threshold, key_hash
from surveyspark.operators.reshape import null_safe_join
from surveyspark.session import broadcast_if_small, reliable_checkpoint

# 16**5 = 1,048,576 rank buckets: a class of 10**12 rows puts about 10**6 rows in one
# (class, bucket) window task, and the bucket-offset window per class stays <= 10**6 small rows
_BUCKET_DIGITS = 5
_COARSE_DIGITS = 3  # 4,096 coarse buckets per class for the two-level offset prefix sum


def with_hash(df: DataFrame, key: str, seed: int, out: str = "_h", tie: list[str] | tuple = ()) -> DataFrame:
    return df.withColumn(out, key_hash(key, seed, tie))


def bucket_sizes(df: DataFrame, hashed: Column) -> DataFrame:
    """Rows of each hash bucket (at most 16**5 rows), counted map-side in one pass and checkpointed."""
    return reliable_checkpoint(df.groupBy(F.substring(hashed, 1, _BUCKET_DIGITS).alias("_b")).agg(F.count(F.lit(1)).alias("_n")))


def _step(counts: DataFrame, prefix: str, n: int, before: int) -> tuple[str, int, int]:
    """(value of ``prefix`` at which the cumulative ``_n`` reaches ``n``, rows before it, its rows); 4,096 rows at most."""
    for value, rows in sorted((r[0], r[1]) for r in counts.groupBy(prefix).agg(F.sum("_n")).collect()):
        if before + rows >= n:
            return value, before, rows
        before += rows
    raise ValueError("fewer rows than asked for")


def hash_cut(df: DataFrame, hashed: Column, n: int) -> tuple[str, int, int] | None:
    """(cut, m, c): rows with a hash below ``cut`` and ``m`` of the ``c`` rows at it make exactly ``n``; None if the
    table has no more than ``n`` rows. Found in the bucket counts digit group by digit group, then among the few
    hashes of one bucket: the driver sees 4,096 counts at most at each step."""
    sizes = bucket_sizes(df, hashed)
    if (sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]) <= n:
        return None
    coarse, before, _ = _step(sizes.withColumn("_p", F.substring("_b", 1, _COARSE_DIGITS)), "_p", n, 0)
    bucket, before, _ = _step(sizes.filter(F.col("_b").startswith(coarse)), "_b", n, before)
    inside = df.filter(F.substring(hashed, 1, _BUCKET_DIGITS) == bucket).groupBy(hashed.alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    cut, before, rows = _step(inside, "_h", n, before)
    return cut, n - before, rows


def range_rank(df: DataFrame, order: list[str], rank_col: str = "_rank") -> DataFrame:
    """``row_number`` over the whole table by ``order`` without a window over it: Spark sorts by ranges, a row's number is
    its place in its range plus the rows of earlier ranges (a row for each range meets in a window)."""
    laid = reliable_checkpoint(df.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
                               .withColumn("_at", F.monotonically_increasing_id()))
    laid = laid.withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy("_range").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    starts = starts.select("_range", (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    out = laid.join(broadcast_if_small(reliable_checkpoint(starts)), "_range")
    return out.withColumn(rank_col, F.col("_at") + F.col("_shift")).select(*df.columns, rank_col)


def sample_cap(df: DataFrame, key: str, cap: int, seed: int = 42, tie: list[str] | tuple | None = None) -> DataFrame:
    """K1: Bernoulli-by-hash sample of about ``cap`` rows: the hashes below min(1, cap / n).

    A key's rows stay together, except where they would make the size a gamble: NULL is no key, and a key with more
    than n / cap rows (more than one expected in the sample; fewer than ``cap`` such keys) is split too. Their rows are
    hashed by ``tie``, by default all other columns that have a text; rows that agree in all of these stay together."""
    if tie is None:
        tie = [f.name for f in df.schema.fields if f.name != key and isinstance(f.dataType, T.AtomicType)]
    sizes = bucket_sizes(df, key_hash(key, seed, tie))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if total <= cap:
        return df
    bound, most = hex_threshold(cap / total), total / max(cap, 1)
    crowded = sizes.filter(F.col("_n") > most).select("_b")  # at most 16**5 buckets; a heavy key's is one of them
    rows = df.filter(F.col(key).isNotNull()).withColumn("_b", F.substring(key_hash(key, seed, tie), 1, _BUCKET_DIGITS))
    heavy = rows.join(broadcast_if_small(crowded), "_b", "left_semi").groupBy(F.col(key).alias("_heavy")).agg(F.count(F.lit(1)).alias("_n"))
    heavy = reliable_checkpoint(heavy.filter(F.col("_n") > most).select("_heavy"))
    if heavy.isEmpty():
        return df.filter(key_hash(key, seed, tie) < bound)
    marked = df.join(broadcast_if_small(heavy), F.col(key) == F.col("_heavy"), "left")
    single = F.when(F.col("_heavy").isNull(), F.col(key))
    return marked.filter(key_hash(single, seed, [key, *tie]) < bound).select(*df.columns)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42, tie: list[str] | tuple = ()) -> DataFrame:
    """K2: exactly min(n, rows) rows: the first ``n`` by (hash, key, tie).

    The hash at which the sample ends is found first, from bucket counts; it filters the scan, and no other row is
    shuffled. Only if several rows share that hash (copies of a key) are those ranked by (key, tie)."""
    hashed = key_hash(key, seed, tie)
    cut = hash_cut(df, hashed, n) if n > 0 else ("", 0, 0)
    if cut is None:
        return df
    value, wanted, there = cut
    if wanted == there:
        return df.filter(hashed <= value)
    tied = range_rank(df.filter(hashed == value), [key, *tie])
    return df.filter(hashed < value).unionByName(tied.filter(F.col("_rank") <= wanted).drop("_rank"))


def split(df: DataFrame, key: str, weights: list[float], seed: int = 42, part_col: str | None = None,
          tie: list[str] | tuple = ()):
    """K3: random split by hash thresholds.

    Returns a list of DataFrames (``part_col`` None) or one DataFrame labelled 0..k-1.
    Parts are disjoint and cover the input for any partitioning; a part of weight 0 is empty.
    """
    total = math.fsum(weights)
    last = max(i for i, w in enumerate(weights) if w > 0)  # takes what is above all bounds
    bounds = [hex_threshold(math.fsum(weights[: i + 1]) / total) for i in range(last)]
    h = key_hash(key, seed, tie)
    label = F.lit(last)
    for i in reversed(range(len(bounds))):
        label = F.when(h < bounds[i], F.lit(i)).otherwise(label)
    labelled = df.withColumn(part_col or "_part", label.cast("int"))
    if part_col:
        return labelled
    return [labelled.filter(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def hash_rank(df: DataFrame, key: str, seed: int, partition_cols: list[str], rank_col: str = "_rank",
              size_col: str | None = None, tie: list[str] | tuple = ()) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY partition_cols ORDER BY hash, key, tie)``, skew-safe.

    The key must be unique, or unique together with ``tie``: rows that agree in both may trade
    ranks when the table is repartitioned, and copies of one key share a bucket. NULL keys are
    hashed by ``tie``; a NULL class is a class of its own.

    Rows go to 16**5 fine hash buckets per class. Bucket offsets are a two-level prefix sum:
    over <= 4,096 coarse buckets per class, then over <= 256 fine buckets per coarse bucket,
    so no task sums more than 4,096 small rows whatever the class size. ``row_number`` runs
    inside each (class, fine bucket). Optionally adds ``size_col`` = rows in the class.
    """
    part = list(partition_cols)
    h = with_hash(df, key, seed, tie=tie).withColumn("_b", F.substring("_h", 1, _BUCKET_DIGITS))
    # bucket counts (<= 16**5 rows per class) are checkpointed: both offset levels read them
    # without a second pass over the data
    sizes = reliable_checkpoint(h.groupBy(*part, "_b").agg(F.count(F.lit(1)).alias("_bn")).withColumn(
        "_cb", F.substring("_b", 1, _COARSE_DIGITS)))
    coarse = sizes.groupBy(*part, "_cb").agg(F.sum("_bn").alias("_cn"))
    coarse = coarse.withColumn("_coff", F.sum("_cn").over(Window.partitionBy(*part).orderBy("_cb")) - F.col("_cn"))
    if size_col:
        coarse = coarse.withColumn(size_col, F.sum("_cn").over(Window.partitionBy(*part)))
    fine = sizes.withColumn("_foff", F.sum("_bn").over(Window.partitionBy(*part, "_cb").orderBy("_b")) - F.col("_bn"))
    offsets = null_safe_join(fine, coarse, [*part, "_cb"], "inner").select(
        *part, "_b", (F.col("_coff") + F.col("_foff")).alias("_off"), *([size_col] if size_col else []))
    wr = Window.partitionBy(*part, "_b").orderBy("_h", key, *tie)
    ranked = h.withColumn("_rn", F.row_number().over(wr))
    out = null_safe_join(ranked, offsets, [*part, "_b"], "left")
    return out.withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("bigint")).drop("_h", "_b", "_rn", "_off")


def stratified_split(df: DataFrame, key: str, label: str, frac: float = 0.8, seed: int = 42,
                     part_col: str | None = None, tie: list[str] | tuple = ()):
    """K4: per class (NULL is one), the first round(frac * n_class) rows by (hash, key) go to part 0."""
    ranked = hash_rank(df, key, seed, [label], rank_col="_rank", size_col="_size", tie=tie)
    first = F.col("_rank") <= F.floor(F.lit(frac) * F.col("_size") + F.lit(0.5))
    labelled = ranked.withColumn(part_col or "_part", F.when(first, F.lit(0)).otherwise(F.lit(1))).drop("_rank", "_size")
    if part_col:
        return labelled
    return [labelled.filter(F.col("_part") == i).drop("_part") for i in (0, 1)]


def assign_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, label: str | None = None,
                 fold_col: str = "fold", tie: list[str] | tuple = ()) -> DataFrame:
    """K5: balanced folds ``(rank - 1) % k`` of the hash order (within ``label`` if given; NULL is a class)."""
    ranked = hash_rank(df, key, seed, [label] if label else [], rank_col="_rank", tie=tie)
    return ranked.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")
