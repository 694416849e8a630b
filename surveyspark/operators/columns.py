"""Projections, renames and row filters.

All operators are narrow transformations: they add Project/Filter nodes that Catalyst
collapses and pushes into the scan (PushedFilters / pruned ReadSchema on parquet).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from surveyspark.functions.expressions import any_null


def common_columns(*dfs: DataFrame) -> list[str]:
    """Columns present in every table, sorted by name."""
    return sorted(reduce(lambda a, b: a & b, (set(d.columns) for d in dfs)))


def align(*dfs: DataFrame) -> list[DataFrame]:
    """Project every table onto the sorted common columns."""
    cols = common_columns(*dfs)
    return [d.select(*cols) for d in dfs]


def resolve_names(df: DataFrame, cols: list[str], case_insensitive: bool = True) -> tuple[list[str], list[str]]:
    """Map wanted names onto the table's names; returns (found, missing).

    Case-insensitive resolution finds ``Lengua`` for a wanted ``lengua`` instead of silently
    dropping it.
    """
    lookup = {c.lower(): c for c in df.columns} if case_insensitive else {c: c for c in df.columns}
    found, missing = [], []
    for c in cols:
        key = c.lower() if case_insensitive else c
        (found if key in lookup else missing).append(lookup.get(key, c))
    return found, missing


def select_available(df: DataFrame, cols: list[str], case_insensitive: bool = False) -> tuple[DataFrame, list[str]]:
    """Select the wanted columns that exist; report the missing ones."""
    found, missing = resolve_names(df, cols, case_insensitive)
    return df.select(*found), missing


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by mapping; names absent from the table are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_rename(df: DataFrame, mapping: dict[str, str], keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """P2 + P3: keep the mapped columns present (plus ``keep`` pass-through columns), rename them."""
    sel, missing = select_available(df, list(mapping))
    extra = [c for c in (keep or []) if c in df.columns]
    out = df.select(*extra, *sel.columns)
    return rename(out, mapping), missing


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose given columns are all non-NULL."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def eligible(group_eq: dict[str, Column] | None = None, *, value_col: str | None = None,
             age_col: str = "edad", min_age: int = 13, occ_col: str = "condicion_ocupacion",
             occ_value=1) -> Column:
    """Conjunctive predicate: equal group values, value known, age >= min_age, employed."""
    parts: list[Column] = [F.col(k) == v for k, v in (group_eq or {}).items()]
    if value_col:
        parts.append(F.col(value_col).isNotNull())
    parts.append(F.col(age_col) >= min_age)
    parts.append(F.col(occ_col) == occ_value)
    return reduce(lambda a, b: a & b, parts)


def drop_incomplete_in_range(df: DataFrame, range_col: str = "edad", lo: float = 0, hi: float = 12,
                             columns: list[str] | None = None, keep_null_range: bool = False) -> DataFrame:
    """Drop rows with ``lo <= range_col <= hi`` that have any NULL among ``columns``.

    ``columns`` defaults to every column of the table at call time (helper columns included).
    Three-valued logic is kept: a NULL ``range_col`` makes the condition NULL, and the row is
    dropped because ``filter`` keeps only TRUE, unless ``keep_null_range`` is set.
    """
    cols = columns if columns is not None else df.columns
    in_range = (F.col(range_col) >= lo) & (F.col(range_col) <= hi)
    keep = ~(in_range & any_null(cols))
    return df.filter(keep | F.col(range_col).isNull() if keep_null_range else keep)


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any column of the subset."""
    return df.na.drop(how="any", subset=subset)


def filter_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """Membership filter (P10); pushed to parquet as an In filter."""
    return df.filter(F.col(col).isin(values))


def split_by_type(df: DataFrame, target: str | None = None, categorical: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Numeric vs categorical columns by schema type, minus the target.

    Any ``NumericType`` counts as numeric (tinyint..decimal); ``categorical`` forces columns
    onto the categorical side.
    """
    forced = set(categorical or [])
    numeric, cats = [], []
    for f in df.schema.fields:
        if f.name == target:
            continue
        if isinstance(f.dataType, T.NumericType) and f.name not in forced:
            numeric.append(f.name)
        else:
            cats.append(f.name)
    return numeric, cats


def column_kinds(spark: SparkSession, df: DataFrame, target: str | None = None,
                 categorical: list[str] | None = None) -> DataFrame:
    """P11 as a type profile ``(column, kind, position, known)``: the kind comes from the
    schema, ``known`` (non-NULL values) from one aggregation over the whole table."""
    numeric, cats = split_by_type(df, target, categorical)
    kinds = {**{c: "numeric" for c in numeric}, **{c: "categorical" for c in cats}}
    cols = [c for c in df.columns if c in kinds]
    counts = df.agg(*[F.count(c).alias(c) for c in cols])
    entries = [F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("kind"),
                        F.lit(df.columns.index(c)).alias("position"), F.col(c).alias("known")) for c in cols]
    return counts.select(F.inline(F.array(*entries)))


def features_target(df: DataFrame, numeric: list[str], categorical: list[str], target: str) -> tuple[DataFrame, list[str], list[str], list[str]]:
    """Project to available features + target (P13); returns (df, numeric, categorical, missing)."""
    num, miss_n = resolve_names(df, numeric)
    cat, miss_c = resolve_names(df, categorical)
    return df.select(*num, *cat, target), num, cat, miss_n + miss_c
