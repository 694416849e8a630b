"""Imputation operators.

A per-column, per-group loop of jobs that re-enters results as literals does not scale.
Here every statistic for every column comes out of one aggregation
(grouping sets over the value counts), group statistics are joined back on the group key,
and global statistics enter as scalar subqueries -- the whole fill is one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from surveyspark.functions import codebooks as cb
from surveyspark.operators.aggregates import count_sets, group_and_global_modes, median, mode_scalar, tops_from_counts
from surveyspark.operators.recode import recode
from surveyspark.operators.selection import coarse_bucket, number_of, quantile_rank, quantile_table, ranked_bucket, select_rank, value_of
from surveyspark.session import BROADCAST_MAX_BYTES, broadcast_if_small, reliable_checkpoint


def _lookup(df: DataFrame, table: DataFrame, on: list[str], size: int | None = None) -> DataFrame:
    """Left join a materialised per-group lookup: broadcast behind a check of its bytes (``size`` where they are
    known), so the table itself is not shuffled for it; a lookup beyond that is a shuffled join."""
    if size is None:
        right = broadcast_if_small(table)
    else:
        right = F.broadcast(table) if size <= BROADCAST_MAX_BYTES else table
    cond = [df[k] == right[k] for k in on]
    out = df.join(right, cond, "left")
    for k in on:
        out = out.drop(right[k])
    return out


def impute_median(df: DataFrame, col: str) -> DataFrame:
    """Fill NULL with the exact global lower median; the column becomes double, unless that would lose digits
    (BIGINT, decimal, date and timestamp stay what they are)."""
    med = median(df, col, "_med").scalar()
    return df.withColumn(col, F.coalesce(_filled_type(df, col), med))


def _filled_type(df: DataFrame, col: str) -> Column:
    keeps = isinstance(df.schema[col].dataType, (T.LongType, T.DecimalType, T.DateType, T.TimestampType))
    return F.col(col) if keeps else F.col(col).cast("double")


def impute_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill NULL with each column's global mode; unchanged when a column is all NULL.

    Only columns present in the table are touched (missing names are ignored).
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    # bind the scalar once: every field read then shares one subquery execution
    out = df.withColumn("_glob", mode_scalar(df, cols))
    return out.withColumns({c: F.coalesce(F.col(c), F.col("_glob")[c]) for c in cols}).drop("_glob")


def impute_group_median(df: DataFrame, col: str, groups: list[str], eligible: Column,
                        force_null: Column | None = None) -> DataFrame:
    """Fill NULL ``col`` on eligible rows with the exact median of its group, computed over
    eligible rows with a known value; then set ``col`` to NULL where ``force_null`` is TRUE.

    NULL group keys never match (equality join), so such rows keep NULL; a group without any
    eligible value has no median and keeps NULL. ``force_null`` follows three-valued logic:
    NULL means "leave as is".
    """
    return _fill_by_group(df, col, groups, *quantile_table(df, groups, col, where=eligible, alias="_med"), eligible, force_null)


def _fill_by_group(df: DataFrame, col: str, groups: list[str], medians: DataFrame, size: int, eligible: Column,
                   force_null: Column | None) -> DataFrame:
    joined = _lookup(df, reliable_checkpoint(medians), groups, size)
    filled = F.when(F.col(col).isNull() & eligible, F.col("_med")).otherwise(F.col(col))
    if force_null is not None:
        filled = F.when(force_null, F.lit(None)).otherwise(filled)
    return joined.withColumn(col, filled.cast(df.schema[col].dataType)).drop("_med").select(*df.columns)


def _income_rule(age: str, occupation: str, min_age: int, employed) -> tuple[Column, Column]:
    """(eligible, forced to NULL) of the survey's income rule."""
    return ((F.col(age) >= min_age) & (F.col(occupation) == employed), (F.col(age) < min_age) | (F.col(occupation) != employed))


def impute_income(df: DataFrame, income: str = "ingreso_total", sex: str = "sexo", stratum: str = "estrato",
                  age: str = "edad", occupation: str = "condicion_ocupacion", min_age: int = 13,
                  employed=1) -> DataFrame:
    """I3 with the survey's rule: median per (sex, stratum) of employed people aged >= 13;
    income forced to NULL for people under 13 or not employed."""
    return impute_group_median(df, income, [sex, stratum], *_income_rule(age, occupation, min_age, employed))


def impute_by_group_mode(df: DataFrame, group: str, exclude: list[str] = (), cols: list[str] | None = None) -> DataFrame:
    """Fill every column (but ``group`` and ``exclude``) with the mode of its group, else the
    global mode; rows with a NULL group get the global mode. Non-NULL cells never change.

    One grouping-sets value count yields the group modes of all columns and, summed over
    groups, the global modes; the fill is a single projection after one lookup join.
    """
    cols = cols or [c for c in df.columns if c != group and c not in set(exclude)]
    gm, glob = group_and_global_modes(df, group, cols)
    gm = gm.select(F.col(group), *[F.col(c).alias(f"_gm_{c}") for c in cols])
    joined = _lookup(df, gm, [group]).withColumn("_glob", glob)
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"_gm_{c}"), F.col("_glob")[c]).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def impute_phase2(df: DataFrame, stratum: str = "estrato", occupation: str = "condicion_ocupacion",
                  income: str = "ingreso_total", predictors: tuple = ("nivel_educativo_cod", "anios_educacion"),
                  recode_labels: bool = True, sex: str = "sexo", age: str = "edad") -> DataFrame:
    """The phase-2 imputations, each applied only when its columns are present.

    Order: stratum median -> occupation mode on codes -> income median on codes ->
    education modes -> occupation codes to Ocupado/Desocupado (only when the column holds
    numeric codes, decided from the schema).

    Plan: ONE counting pass (grouping sets) gives every statistic its counts: the coarse value buckets of the
    stratum, the values of occupation and education, and the coarse income buckets by (sex, stratum, occupation).
    Counts add up, so rows whose stratum or occupation is filled are counted where they go: their counts move to the
    filled group afterwards, without a second look at the data. A second pass reads the incomes inside each group's
    middle bucket, a third one fills.
    """
    cols = set(df.columns)
    numeric_occ = occupation in cols and isinstance(df.schema[occupation].dataType, T.NumericType)
    employed = 1 if numeric_occ else cb.EMPLOYED
    mode_cols = ([occupation] if occupation in cols else []) + [p for p in predictors if p in cols]
    do_income = income in cols and {stratum, sex, age, occupation} <= cols
    if not do_income:
        out = impute_median(df, stratum) if stratum in cols else df
        out = impute_mode(out, mode_cols)
    else:
        out = _phase2_fused(df, stratum, occupation, income, mode_cols, sex, age, employed)
    if recode_labels and numeric_occ:
        out = recode(out, occupation, {cb.EMPLOYED_TITLE: [1]}, default=cb.NOT_EMPLOYED_TITLE)
    return out


def _phase2_fused(df: DataFrame, stratum: str, occupation: str, income: str, mode_cols: list[str], sex: str, age: str,
                  employed, min_age: int = 13) -> DataFrame:
    kinds = {c: df.schema[c].dataType for c in (stratum, income)}
    counted = df.withColumns({"_sv": number_of(F.col(stratum), kinds[stratum]), "_iv": number_of(F.col(income), kinds[income])})
    counted = counted.withColumns({"_sb": coarse_bucket(F.col("_sv")), "_ib": F.when(F.col(age) >= min_age, coarse_bucket(F.col("_iv")))})
    by_income = [sex, stratum, occupation, "_ib"]
    ranges = [f(F.when(F.col(b).isNotNull(), F.col(v))).alias(n) for b, v, p in (("_sb", "_sv", "s"), ("_ib", "_iv", "i"))
              for f, n in ((F.min, f"_{p}lo"), (F.max, f"_{p}hi"))]
    counts, gids = count_sets(counted, {"_sb": ["_sb"], "_ib": by_income, **{c: [c] for c in mode_cols}}, ranges)
    counts = reliable_checkpoint(counts)

    strata = counts.filter((F.col("_gid") == gids["_sb"]) & F.col("_sb").isNotNull()).select(
        F.lit(0).alias("_all"), "_sb", F.col("_n").alias("_c"), F.col("_slo").alias("_lo"), F.col("_shi").alias("_hi"))
    middle = ranked_bucket(strata, ["_all"], ["_sb"], quantile_rank(0.5)).select(F.struct("_lo", "_hi")).scalar()
    tops = tops_from_counts(counts.filter(F.col("_gid").isin([gids[c] for c in mode_cols])), [], mode_cols, {c: gids[c] for c in mode_cols})
    found = df.sparkSession.range(1).select(middle.alias("m"), tops.select(F.struct(*mode_cols)).scalar().alias("t")).first()
    if found["m"] is None:
        med = F.lit(None)
    elif found["m"]["_lo"] == found["m"]["_hi"]:
        med = value_of(F.lit(found["m"]["_lo"]).cast(counts.schema["_slo"].dataType), kinds[stratum])
    else:  # a stratum of many values: its middle bucket takes passes of its own
        med = median(df, stratum, "_med").scalar()
    modes = {c: F.lit(found["t"][c]).cast(df.schema[c].dataType) for c in mode_cols}
    strata_filled = F.coalesce(_filled_type(df, stratum), med)

    filled = df.withColumn(stratum, strata_filled).withColumns({c: F.coalesce(F.col(c), modes[c]) for c in mode_cols})
    eligible, force = _income_rule(age, occupation, min_age, employed)
    incomes = counts.filter((F.col("_gid") == gids["_ib"]) & F.col("_ib").isNotNull()).select(
        sex, strata_filled.alias(stratum), F.coalesce(F.col(occupation), modes[occupation]).alias(occupation), "_ib", "_n", "_ilo", "_ihi")
    incomes = incomes.filter(F.col(occupation) == employed).groupBy(sex, stratum, F.col("_ib").alias("_b")).agg(
        F.sum("_n").alias("_c"), F.min("_ilo").alias("_lo"), F.max("_ihi").alias("_hi"))
    values = filled.filter(eligible & F.col(income).isNotNull()).select(sex, stratum, number_of(F.col(income), kinds[income]).alias("_v"))
    medians, size = select_rank(values, [sex, stratum], incomes, quantile_rank(0.5))
    medians = medians.select(sex, stratum, value_of(F.col("_lo"), kinds[income]).alias("_med"))
    return _fill_by_group(filled, income, [sex, stratum], medians, size, eligible, force)
