"""Column-level helpers. All return JVM-side Column expressions (no Python UDFs)."""

from __future__ import annotations

from functools import reduce
import operator

from pyspark.sql import Column, DataFrame, functions as F, types as T

HASH_HEX_DIGITS = 8
HASH_SPACE = 16 ** HASH_HEX_DIGITS  # 2**32


def col_of(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def is_missing(field: T.StructField) -> Column:
    """NULL test; float/double columns also count NaN (isnan on other types raises under ANSI)."""
    c = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_missing_col(df: DataFrame, name: str) -> Column:
    return is_missing(df.schema[name])


def any_null(cols: list[str]) -> Column:
    return reduce(operator.or_, [F.col(c).isNull() for c in cols])


def key_text(key, tie: list[str] | tuple = ()) -> Column:
    """The key as text; a NULL key stands as ``<null>`` followed by the ``tie`` columns."""
    null = F.concat(F.lit("<null>"), *[F.concat(F.lit(":"), F.coalesce(col_of(c).cast("string"), F.lit(""))) for c in tie])
    return F.coalesce(col_of(key).cast("string"), null)


def key_hash(key, seed: int, tie: list[str] | tuple = ()) -> Column:
    """Deterministic, partitioning-independent 8-hex-digit hash of a key and a seed.

    ``substr(md5(key || ':' || seed), 1, 8)``: equal in Spark and in any SQL engine with md5,
    so sampling and splitting results do not depend on how the data is partitioned. NULL keys
    have a hash too (see ``key_text``).
    """
    return F.substring(F.md5(F.concat(key_text(key, tie), F.lit(f":{seed}"))), 1, HASH_HEX_DIGITS)


def key_uniform(key, seed: int, part: int = 0) -> Column:
    """Deterministic uniform in (0, 1) from the ``part``-th 8-hex slice of md5(key:seed)."""
    h = F.substring(F.md5(F.concat(col_of(key).cast("string"), F.lit(f":{seed}"))), 1 + 8 * part, HASH_HEX_DIGITS)
    return (F.conv(h, 16, 10).cast("double") + 0.5) / float(HASH_SPACE)


def key_normal(key, seed: int) -> Column:
    """Deterministic standard normal per key (Box-Muller on two md5 slices).

    Unlike ``randn(seed)`` it does not depend on how rows are partitioned, so reruns, retries
    and different cluster sizes give the same value for the same key.
    """
    import math

    u1, u2 = key_uniform(key, seed, 0), key_uniform(key, seed, 1)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def hex_threshold(fraction: Column | float) -> Column:
    """Text bound t with ``key_hash < t`` for the given fraction of hashes: 8 hex digits of
    floor(fraction * 2**32), and "g", which sorts after every hex digit, from 1 on."""
    frac = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    digits = F.lpad(F.lower(F.hex(F.floor(F.least(frac, F.lit(1.0)) * F.lit(float(HASH_SPACE))).cast("bigint"))), HASH_HEX_DIGITS, "0")
    return F.when(frac >= 1.0, F.lit("g")).otherwise(digits)


def pct_deviation(value, reference) -> Column:
    """Percent deviation of value from reference, 0 when the reference is 0."""
    v, r = col_of(value), col_of(reference)
    return F.when(r != 0, (v - r) / F.abs(r) * 100.0).otherwise(F.lit(0.0))


def fmt(c, decimals: int, signed: bool = False, suffix: str = "") -> Column:
    """Fixed-decimals text (``.1f``/``.2f``/``.4f``, optionally signed), rounded half-up first."""
    spec = ("%+." if signed else "%.") + f"{decimals}f" + suffix.replace("%", "%%")
    return F.format_string(spec, F.round(col_of(c).cast("double"), decimals))


def round6(c) -> Column:
    return F.round(col_of(c).cast("double"), 6)


def safe_div(num, den) -> Column:
    """Division that yields NULL instead of raising on a zero denominator (ANSI mode)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))
