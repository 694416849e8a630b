"""Aggregations.

Design notes for scale
----------------------
* Modes are computed as value counts (``GROUP BY key, value`` with map-side partial
  aggregation) followed by ``min(struct(-count, value))`` per key. Both stages use
  fixed-size aggregation buffers, so a key holding a third of all rows is spread over
  many (key, value) partial aggregates instead of one hash map in one task. Several
  columns share ONE scan and ONE shuffle through ``GROUPING SETS``.
* Global scalars (a global mode, median or count) are attached to rows through a scalar
  subquery (``DataFrame.scalar()``): Spark checks it returns one row and inlines it, so no
  cross join is planned.
* Report-shaped outputs (one row per column, per cluster) are unpivoted from a single
  aggregate row: the whole table is read once.
"""

from __future__ import annotations

from functools import reduce
import operator

from pyspark.sql import Column, DataFrame, functions as F

from surveyspark.functions.expressions import is_missing_col, round6, safe_div
from surveyspark.operators.moments import pair_correlations
from surveyspark.operators.selection import quantile_table
from surveyspark.session import reliable_checkpoint


# ---------------------------------------------------------------- counts, distinct, shares

def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    """A1: one row with the row count."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """A2: distinct values / tuples (hash aggregate, partial per partition)."""
    return df.select(*cols).distinct()


def value_counts(df: DataFrame, col: str, normalize: bool = False, dropna: bool = True,
                 count_col: str = "n", pct_col: str = "pct") -> DataFrame:
    """A3: value counts, optionally with the share in percent of the counted rows."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    if not normalize:
        return counts
    # one pass over the data: the total is read back from the checkpointed counts
    counts = reliable_checkpoint(counts)
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(pct_col, F.col(count_col) * 100.0 / total)


# ---------------------------------------------------------------- modes

def _gid(all_cols: list[str], in_set: set[str]) -> int:
    n = len(all_cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(all_cols) if c not in in_set)


def value_count_sets(df: DataFrame, keys: list[str], cols: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """Value counts of every column per key tuple in ONE aggregation (GROUPING SETS).

    Returns (counts, gids): counts has the key columns, one column per input column (only the
    column of the row's set is filled), ``_n`` and ``_gid``; gids maps column -> grouping id.
    """
    keys, cols = list(keys), list(cols)
    all_cols = keys + cols
    gids = {c: _gid(all_cols, set(keys) | {c}) for c in cols}
    if len(cols) == 1:
        c = cols[0]
        vc = df.groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_n")).withColumn("_gid", F.lit(gids[c]).cast("bigint"))
        return vc, gids
    vc = (df.groupingSets([keys + [c] for c in cols], *all_cols)
          .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid")))
    return vc, gids


def count_sets(df: DataFrame, sets: dict[str, list[str]], more: list[Column] = ()) -> tuple[DataFrame, dict[str, int]]:
    """Row counts (``_n``) and the aggregates ``more`` for several key sets in ONE pass (GROUPING SETS).

    Returns (counts, gids): all key columns, of which a row fills those of its set; gids maps a set's name to ``_gid``."""
    all_cols = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    counts = df.groupingSets([list(keys) for keys in sets.values()], *all_cols).agg(
        F.count(F.lit(1)).alias("_n"), *more, F.grouping_id().alias("_gid"))
    return counts, {name: _gid(all_cols, set(keys)) for name, keys in sets.items()}


def _tops(vc: DataFrame, keys: list[str], cols: list[str], gids: dict[str, int]) -> DataFrame:
    """Per (_gid, key tuple) the struct (unknown, -count, values) of the most frequent value. NULL loses to
    every value, but a key that has nothing else keeps its row."""
    unknown = F.coalesce(*[F.when(F.col("_gid") == g, F.col(c).isNull()) for c, g in gids.items()])
    return vc.groupBy("_gid", *keys).agg(
        F.min(F.struct(unknown.alias("_null"), (-F.col("_n")).alias("_nn"), *[F.col(c) for c in cols])).alias("_t"))


def tops_from_counts(vc: DataFrame, keys: list[str], cols: list[str], gids: dict[str, int]) -> DataFrame:
    """Per key tuple, the most frequent non-NULL value of each column (ties -> smallest; NULL if there is none)."""
    return _tops(vc, keys, cols, gids).groupBy(*keys).agg(
        *[F.max(F.when(F.col("_gid") == g, F.col("_t")[c])).alias(c) for c, g in gids.items()])


def top_values(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Most frequent non-NULL value of each column per key tuple; ties -> smallest value.

    Returns one row per key tuple, with one column per input column (NULL when the key has no
    value for that column). With ``keys=[]`` the
    result is exactly one row (global modes; all NULL on an empty input).
    """
    vc, gids = value_count_sets(df, keys, cols)
    return tops_from_counts(vc, list(keys), list(cols), gids)


def group_and_global_modes(df: DataFrame, group: str, cols: list[str]) -> tuple[DataFrame, Column]:
    """Group modes (one row per group) and global modes (struct scalar) from ONE aggregation.

    One pass counts the values of each column per group (grouping sets (group, c)); the global
    counts are those counts summed over the groups, not counted again. The resulting lookup has
    one row per group plus one global row; it is checkpointed to shared storage (reliable, tiny)
    so that the lookup join and the global scalar read it instead of re-aggregating the data.
    """
    vc, gids = value_count_sets(df, [group], cols)
    both = vc.withColumn("_all", F.explode(F.array(F.lit(False), F.lit(True))))
    both = both.withColumn(group, F.when(~F.col("_all"), F.col(group)))
    summed = both.groupBy("_gid", "_all", group, *cols).agg(F.sum("_n").alias("_n"))
    lookup = reliable_checkpoint(tops_from_counts(summed, ["_all", group], list(cols), gids))
    gm = lookup.filter(~F.col("_all")).drop("_all")
    glob = lookup.filter(F.col("_all")).select(F.struct(*cols).alias("m")).scalar()
    return gm, glob


def mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """A4: global mode of each column (NULL ignored; NULL when all NULL). One row."""
    return top_values(df, [], cols)


def group_mode(df: DataFrame, group: str | list[str], cols: list[str]) -> DataFrame:
    """A5: mode per group, one row per non-NULL group key."""
    keys = [group] if isinstance(group, str) else list(group)
    out = top_values(df, keys, cols)
    return out.filter(reduce(operator.and_, [F.col(k).isNotNull() for k in keys]))


def mode_scalar(df: DataFrame, cols: list[str]) -> Column:
    """Global modes as a struct-valued scalar subquery column (field per input column)."""
    return mode(df, cols).select(F.struct(*cols).alias("m")).scalar()


# ---------------------------------------------------------------- medians

def quantile_exact(df: DataFrame, groups: list[str], col: str, q: float = 0.5, where: Column | None = None,
                   alias: str = "mediana", small: int | None = None) -> DataFrame:
    """Exact discrete quantile per group (= ``percentile_disc(q)``) with bounded per-task state, by counted ranges
    (``operators.selection``): one pass if a group's values are few, two for most others. One row per group that has
    values; without groups one row (none for a column without values)."""
    return quantile_table(df, groups, col, q, where, alias, small)[0]


def median(df: DataFrame, col: str, alias: str = "mediana") -> DataFrame:
    """Exact global lower median. One row (NULL when the column is all NULL). BIGINT, decimal, date and timestamp
    keep their type."""
    res = quantile_exact(df, [], col, alias=alias)
    return df.sparkSession.range(1).select(res.select(alias).scalar().alias(alias))


def group_median(df: DataFrame, groups: list[str], col: str, where: Column | None = None,
                 alias: str = "mediana") -> DataFrame:
    """Exact lower median per group, over rows passing ``where`` with a known value."""
    return quantile_exact(df, groups, col, 0.5, where, alias)


# ---------------------------------------------------------------- missing-value profiles

def null_rates(df: DataFrame, cols: list[str], name_col: str = "columna",
               pct_col: str = "porcentaje_nulos") -> DataFrame:
    """Percent of rows missing (NULL, or NaN for floats) per column, whole table, one pass."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.count_if(is_missing_col(df, c)).alias(c) for c in cols]
    return null_rates_of(df.agg(*aggs), cols, name_col, pct_col)


def null_rates_of(one: DataFrame, cols: list[str], name_col: str = "columna", pct_col: str = "porcentaje_nulos") -> DataFrame:
    """A8 from one row: ``_total`` rows, and the missing count of each column under its name."""
    long = one.unpivot("_total", cols, name_col, "_nulls")
    return long.select(name_col, F.coalesce(safe_div(F.col("_nulls") * 100.0, F.col("_total")),
                                            F.lit(0.0)).alias(pct_col))


def null_rates_by(df: DataFrame, group: str, cols: list[str], name_col: str = "columna") -> DataFrame:
    """A9 + R1: missing count, group size and percent per (column, group); one grouped pass."""
    aggs = [F.count(F.lit(1)).alias("total_registros")] + [
        F.count_if(is_missing_col(df, c)).alias(c) for c in cols]
    return null_rates_from(df.groupBy(group).agg(*aggs), group, cols, name_col)


def null_rates_from(wide: DataFrame, group: str, cols: list[str], name_col: str = "columna") -> DataFrame:
    """A9 from one row per group: total_registros, and the missing count of each column under its name."""
    long = wide.unpivot([group, "total_registros"], cols, name_col, "nulos")
    return long.select(
        name_col, group, "total_registros", "nulos",
        F.coalesce(safe_div(F.col("nulos") * 100.0, F.col("total_registros")), F.lit(0.0)).alias("porcentaje_nulos"))


# ---------------------------------------------------------------- means, correlations

def group_means(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """A10: mean of each column per key."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def means(df: DataFrame, cols: list[str]) -> DataFrame:
    """Global mean of each column. One row."""
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def _named_pairs(r: DataFrame, names: list[tuple[int, str, str]], a_col: str, b_col: str, r_col: str) -> DataFrame:
    """Attach output labels (pair index, a, b) to the computed pairs; one label row may reuse
    a pair (the mirrored triangle). Both sides are bounded by the number of pairs."""
    labels = r.sparkSession.createDataFrame(names, f"_p int, {a_col} string, {b_col} string")
    return F.broadcast(labels).join(r, "_p", "left").select(a_col, b_col, F.col("_r").alias(r_col))


def matrix_pairs(cols: list[str]) -> list[tuple[str, str]]:
    """The upper triangle with the diagonal."""
    return [(a, b) for i, a in enumerate(cols) for b in cols[i:]]


def matrix_from_pairs(r: DataFrame, cols: list[str], first: int = 0, a_col: str = "var_a", b_col: str = "var_b", r_col: str = "r") -> DataFrame:
    """The matrix in long form from the correlations of ``matrix_pairs(cols)``, whose first has the index ``first``."""
    upper = list(enumerate(matrix_pairs(cols), first))
    names = [(i, a, b) for i, (a, b) in upper] + [(i, b, a) for i, (a, b) in upper if a != b]
    return _named_pairs(r, names, a_col, b_col, r_col)


def target_from_pairs(r: DataFrame, target: str, feats: list[str], first: int = 0, name_col: str = "variable", r_col: str = "r") -> DataFrame:
    """The sorted target correlations from the pairs (feature, target), the first of index ``first``."""
    out = _named_pairs(r, [(i, c, target) for i, c in enumerate(feats, first)], name_col, "_t", r_col)
    return out.drop("_t").orderBy(F.col(r_col).desc_nulls_last(), F.col(name_col))


def corr_matrix(df: DataFrame, cols: list[str], a_col: str = "var_a", b_col: str = "var_b",
                r_col: str = "r") -> DataFrame:
    """Pairwise-complete Pearson matrix in long form (a, b, r), both triangles and diagonal.

    Only the upper triangle is computed; the lower one reuses it (r is symmetric)."""
    return matrix_from_pairs(pair_correlations(df, matrix_pairs(cols)), cols, 0, a_col, b_col, r_col)


def target_corr(df: DataFrame, target: str, cols: list[str], name_col: str = "variable",
                r_col: str = "r") -> DataFrame:
    """A13 + O4: correlation of each column with the target, target itself dropped, sorted desc."""
    feats = [c for c in cols if c != target]
    return target_from_pairs(pair_correlations(df, [(c, target) for c in feats]), target, feats, 0, name_col, r_col)


# ---------------------------------------------------------------- cross table

def crosstab_pct(df: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    """Row-normalised cross table in percent, one column per given value (0.0 when absent).

    Rows with NULL in either variable are excluded. The counts table is (rows x values) in
    size, so the row-total window runs over that small table, not over the data.
    """
    counts = (df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
              .groupBy(row, col).agg(F.count(F.lit(1)).alias("_n")))
    return crosstab_from_counts(counts, row, col, values)


def crosstab_from_counts(counts: DataFrame, row: str, col: str, values: list[str]) -> DataFrame:
    """A14 from its cells (row, col, ``_n``), neither NULL."""
    pct = counts.withColumn("_pct", F.col("_n") * 100.0 / F.sum("_n").over(_by(row)))
    wide = pct.groupBy(row).pivot(col, values).agg(F.first("_pct"))
    return wide.select(row, *[F.coalesce(F.col(v), F.lit(0.0)).alias(v) for v in values])


def _by(*cols):
    from pyspark.sql import Window
    return Window.partitionBy(*cols)


# ---------------------------------------------------------------- step audit

def audit_counts(steps: dict[str, DataFrame], step_col: str = "paso", count_col: str = "filas") -> DataFrame:
    """Rows per named step and rows removed relative to the previous step."""
    parts = [d.agg(F.count(F.lit(1)).alias(count_col)).select(
        F.lit(i).alias("_i"), F.lit(name).alias(step_col), count_col) for i, (name, d) in enumerate(steps.items())]
    allp = reduce(DataFrame.unionByName, parts)
    from pyspark.sql import Window
    w = Window.orderBy("_i")  # at most len(steps) rows
    return allp.select(step_col, count_col,
                       F.coalesce(F.lag(count_col).over(w) - F.col(count_col), F.lit(0)).cast("bigint").alias("eliminadas"))


def audit_steps(df: DataFrame, steps: dict[str, Column | None], step_col: str = "paso",
                count_col: str = "filas") -> DataFrame:
    """A20 in one pass: rows kept after each successive filter of one table.

    ``steps`` maps a step name to the predicate that step applies (None = no filter); step i
    keeps rows passing predicates 1..i (a filter keeps only TRUE, as ``count_if`` counts).
    """
    conds, acc = [], None
    for cond in steps.values():
        if cond is not None:
            acc = cond if acc is None else (acc & cond)
        conds.append(F.lit(True) if acc is None else acc)
    one = df.agg(*[F.count_if(c).alias(f"_s{i}") for i, c in enumerate(conds)])
    entries = [F.struct(F.lit(i).alias("_i"), F.lit(name).alias(step_col), F.col(f"_s{i}").alias(count_col))
               for i, name in enumerate(steps)]
    long = one.select(F.inline(F.array(*entries)))
    from pyspark.sql import Window
    w = Window.orderBy("_i")  # at most len(steps) rows
    return long.select(step_col, count_col,
                       F.coalesce(F.lag(count_col).over(w) - F.col(count_col), F.lit(0)).cast("bigint").alias("eliminadas"))


__all__ = ["row_count", "distinct_values", "value_counts", "value_count_sets", "count_sets", "tops_from_counts",
           "top_values", "group_and_global_modes", "mode", "group_mode", "mode_scalar",
           "quantile_exact", "median", "group_median", "null_rates", "null_rates_by", "group_means", "means",
           "pair_correlations", "matrix_pairs", "matrix_from_pairs", "target_from_pairs", "corr_matrix", "target_corr",
           "null_rates_from", "null_rates_of", "crosstab_from_counts", "crosstab_pct", "audit_counts", "audit_steps",
           "round6"]
