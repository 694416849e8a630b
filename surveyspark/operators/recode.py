"""Scalar and conditional columns (C1-C15): recodes, bands, lookups, answer encoding.

Everything is a CASE/map expression evaluated inside whole-stage codegen; dictionaries are
small fixed literals (``create_map``), so no join or Python UDF is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from surveyspark.functions.expressions import col_of, key_normal

_KEEP = object()


def recode(df: DataFrame, col: str, mapping: dict[str, list], default=_KEEP, out: str | None = None) -> DataFrame:
    """Map code lists to labels.

    ``default`` = keep (other codes as text, NULL stays NULL), a literal label (applies to
    every other value *and* NULL), or None.
    """
    c = F.col(col)
    expr = None
    for label, codes in mapping.items():
        cond = c.isin(codes) if len(codes) > 1 else (c == codes[0])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if default is _KEEP:
        expr = expr.otherwise(c.cast("string"))
    else:
        expr = expr.otherwise(F.lit(default))
    return df.withColumn(out or col, expr)


def band(df: DataFrame, col: str, edges: list[float], labels: list[str], null_label: str | None,
         out: str) -> DataFrame:
    """Open-ended bands: ``< edges[i]`` -> labels[i], else labels[-1]; NULL -> null_label."""
    c = F.col(col)
    expr = F.when(c.isNull(), F.lit(null_label))
    for e, lab in zip(edges, labels):
        expr = expr.when(c < e, F.lit(lab))
    return df.withColumn(out, expr.otherwise(F.lit(labels[len(edges)])))


def band_closed(df: DataFrame, col: str, ranges: list[tuple], out: str) -> DataFrame:
    """Closed integer ranges ``lo <= x <= hi`` (hi None = open); anything else NULL (C4)."""
    c = F.col(col)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for lo, hi, lab in ranges:
        cond = (c >= lo) if hi is None else ((c >= lo) & (c <= hi))
        expr = expr.when(cond, F.lit(lab))
    return df.withColumn(out, expr.otherwise(F.lit(None).cast("string")))


def cut(df: DataFrame, col: str, edges: list[float], labels: list[str], out: str, right: bool = False) -> DataFrame:
    """Bins between consecutive edges, half-open ``[lo, hi)`` (or ``(lo, hi]``); outside -> NULL."""
    c = F.col(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = ((c > lo) & (c <= hi)) if right else ((c >= lo) & (c < hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return df.withColumn(out, expr.otherwise(F.lit(None).cast("string")))


def lookup_map(mapping: dict) -> Column:
    """A literal map column from a small fixed dictionary."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Value -> value lookup; unmapped and NULL -> NULL."""
    c = F.col(col)
    expr = F.when(c.isNull(), F.lit(None))
    for k, v in mapping.items():
        expr = expr.when(c == F.lit(k), F.lit(v))
    return df.withColumn(out or col, expr.otherwise(F.lit(None)))


def encode_answers(df: DataFrame, dictionaries: dict[str, dict], int_fields: list[str] = (),
                   error_col: str = "errores") -> DataFrame:
    """Decode answer labels into codes (C11) and integer text into ints.

    A label missing from its dictionary gives NULL and its field name is listed in
    ``error_col`` (the form raised on the first unknown key; a batch keeps going and reports).
    A NULL label stays NULL without error. One projection over the input columns.
    """
    codes, errors = {}, []
    for field, mapping in dictionaries.items():
        if field in df.columns:
            src = F.col(field)
            code = F.try_element_at(lookup_map(mapping), src).cast("int")
            codes[field] = code
            errors.append(F.when(src.isNotNull() & code.isNull(), F.lit(field)))
    for field in int_fields:
        if field in df.columns:
            src = F.col(field)
            val = F.trim(src.cast("string")).try_cast("int")
            codes[field] = val
            errors.append(F.when(src.isNotNull() & val.isNull(), F.lit(field)))
    cols = [codes[c].alias(c) if c in codes else F.col(c) for c in df.columns]
    err = F.filter(F.array(*errors), lambda x: x.isNotNull()) if errors else F.array().cast("array<string>")
    return df.select(*cols, err.alias(error_col))


def decode_answers(df: DataFrame, dictionaries: dict[str, dict]) -> DataFrame:
    """Inverse of ``encode_answers``: codes -> labels (used to build answer records)."""
    cols = []
    for c in df.columns:
        if c in dictionaries:
            inverse = {v: k for k, v in dictionaries[c].items()}
            cols.append(F.try_element_at(lookup_map(inverse), F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def jitter(df: DataFrame, col: str, sigma: float, seed: int, out: str, key: str | None = None) -> DataFrame:
    """Add seeded Gaussian noise ``sigma * N(0,1)`` (C14).

    With ``key`` the noise is a function of (key, seed) only (``key_normal``): reproducible
    under any partitioning. Without it, ``randn(seed)`` (depends on the partition layout).
    """
    noise = key_normal(key, seed) if key else F.randn(seed)
    return df.withColumn(out, col_of(col).cast("double") + F.lit(sigma) * noise)


def vector_elements(df: DataFrame, vec: str, names: list[str], drop: bool = False) -> DataFrame:
    """Vector column -> scalar columns by position."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(F.col(vec))
    out = df.withColumns({n: arr[i] for i, n in enumerate(names)})
    return out.drop(vec) if drop else out


def coalesce_all(df: DataFrame, fills: dict[str, Column]) -> DataFrame:
    """Replace NULL by a value per column (C16), one projection for all columns."""
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in fills.items()})
