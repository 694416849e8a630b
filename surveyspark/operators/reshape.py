"""Reshape, top-k and ordering (R2, O2, O3, O5) and the bag union of aligned extracts."""

from __future__ import annotations

from functools import reduce
import operator

from pyspark.sql import DataFrame, Window, functions as F, types as T

from surveyspark.operators.columns import common_columns


def pivot_matrix(df: DataFrame, row: str, col: str, value: str, col_values: list) -> DataFrame:
    """R2: long -> wide matrix; explicit ``col_values`` avoid a distinct-discovery job."""
    return df.groupBy(row).pivot(col, col_values).agg(F.first(value))


def top_k_per_group(df: DataFrame, group: str, order: list, k: int, rank_col: str = "rank",
                    buckets: int | None = None) -> DataFrame:
    """O2 building block: first k rows per group by the given (total) ordering.

    For k up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000) Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so every partition sends at most k rows
    per group and a hot group is never sorted whole in one task. For larger k, ``buckets``
    does the same by hand: the top k of each hash bucket of a group survive, and the final
    window sees at most k * buckets rows per group. Same result for a total ordering.
    """
    src = df
    if buckets:
        src = df.withColumn("_tb", F.pmod(F.xxhash64(*df.columns), F.lit(buckets)))
        w1 = Window.partitionBy(group, "_tb").orderBy(*order)
        src = src.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_tb", "_r1")
    w = Window.partitionBy(group).orderBy(*order)
    return src.withColumn(rank_col, F.row_number().over(w).cast("bigint")).filter(F.col(rank_col) <= k)


def top_missing(null_table: DataFrame, group: str = "cluster_edad", k: int = 10,
                pct_col: str = "porcentaje_nulos", name_col: str = "columna", nulls_col: str = "nulos") -> DataFrame:
    """O2: per group, the k columns with the highest missing percent; zero-null rows hidden."""
    ranked = top_k_per_group(null_table, group, [F.col(pct_col).desc(), F.col(name_col)], k)
    return ranked.filter(F.col(nulls_col) > 0)


def head(df: DataFrame, n: int, order: list) -> DataFrame:
    """First n rows by an explicit order (TakeOrderedAndProject: per-partition top-n)."""
    return df.orderBy(*order).limit(n)


def union_common(*dfs: DataFrame) -> DataFrame:
    """Bag union of tables on their sorted common columns.

    A column whose type differs between inputs is cast to string in all of them first
    (``int`` UNION ``string`` would fail at run time under ANSI).
    """
    cols = common_columns(*dfs)
    types = {c: {d.schema[c].dataType for d in dfs} for c in cols}
    conflict = {c for c, ts in types.items() if len(ts) > 1}

    def proj(d: DataFrame) -> DataFrame:
        return d.select(*[F.col(c).cast(T.StringType()).alias(c) if c in conflict else F.col(c) for c in cols])

    return reduce(DataFrame.unionByName, [proj(d) for d in dfs])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL (as in GROUP BY); the keys come from ``left``."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(operator.and_, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])
