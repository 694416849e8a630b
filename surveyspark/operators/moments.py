"""Pairwise-complete moments of column pairs by blocks.

A block is an Arrow batch as a matrix X with a matrix M of what is known. M'M, X'M, (X*X)'M and X'X give the counts,
means and co-moments of all pairs of columns at once, whatever the pattern of missing values; rows are never multiplied
by pairs. Blocks of a task are merged there by the parallel formula for means and co-moments; a task sends one row for
each pair, and Spark merges these the same way. X is taken relative to a value of each column near its mean, so sums
cancel nothing that matters; pairs of which a column hardly varies where the other is known are summed again from
their rows, so that a constant has variance 0 exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from surveyspark.functions.expressions import is_missing_col, safe_div

_FIELDS = ("n", "mx", "my", "cxx", "cyy", "cxy")
SCHEMA = "_p int, " + ", ".join(f"{c} double" for c in _FIELDS)

#: A sum of squares below this share of what it is taken from has lost its digits.
LOST = 1e-9


def block_moments(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of each pair (left[i], right[i]) of columns of ``x``; NaN is missing."""
    known = ~np.isnan(x)
    counts = known.sum(axis=0)
    mean = np.where(known, x, 0.0).sum(axis=0) / np.maximum(counts, 1)
    near = np.where(known, np.abs(x - mean), np.inf).argmin(axis=0)
    shift = np.where(counts > 0, x[near, np.arange(x.shape[1])], 0.0)
    m, d = known.astype(np.float64), np.where(known, x - shift, 0.0)
    pair = (left, right)
    n, both = (m.T @ m)[pair], (d.T @ d)[pair]
    sums, squares = d.T @ m, (d * d).T @ m
    sx, sy, qx, qy = sums[pair], sums[right, left], squares[pair], squares[right, left]
    some = np.maximum(n, 1)
    out = {"n": n, "mx": shift[left] + sx / some, "my": shift[right] + sy / some,
           "cxx": np.maximum(qx - sx * sx / some, 0.0), "cyy": np.maximum(qy - sy * sy / some, 0.0), "cxy": both - sx * sy / some}
    lost = np.flatnonzero((n > 0) & ((out["cxx"] < LOST * qx) | (out["cyy"] < LOST * qy)))
    for i in lost:
        rows = known[:, left[i]] & known[:, right[i]]
        a, b = d[rows, left[i]], d[rows, right[i]]
        ma, mb = (v[0] if v.min() == v.max() else v.mean() for v in (a, b))
        out["mx"][i], out["my"][i] = shift[left[i]] + ma, shift[right[i]] + mb
        out["cxx"][i], out["cyy"][i], out["cxy"][i] = (a - ma) @ (a - ma), (b - mb) @ (b - mb), (a - ma) @ (b - mb)
    return out


def merge(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Two blocks' moments as one's."""
    n = a["n"] + b["n"]
    share = b["n"] / np.maximum(n, 1)
    dx, dy = (np.where(a["n"] > 0, np.where(b["n"] > 0, b[c] - a[c], 0.0), b[c] - a[c]) for c in ("mx", "my"))
    weight = a["n"] * share
    return {"n": n, "mx": a["mx"] + dx * share, "my": a["my"] + dy * share, "cxx": a["cxx"] + b["cxx"] + dx * dx * weight,
            "cyy": a["cyy"] + b["cyy"] + dy * dy * weight, "cxy": a["cxy"] + b["cxy"] + dx * dy * weight}


def _numbers(df: DataFrame, pairs: list[tuple[str, str]]):
    """(columns as doubles, NaN as NULL, named c0, c1, ...; left and right index of each pair)."""
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: i for i, c in enumerate(cols)}
    left, right = (np.array([at[pair[k]] for pair in pairs], dtype=np.int64) for k in (0, 1))
    return [F.when(~is_missing_col(df, c), F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)], left, right


def _matrix(columns: list[pa.Array]) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])


def pair_moments(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """A row for each pair and task: pair index ``_p``, rows with both known, means, co-moments. NaN counts as missing."""
    columns, left, right = _numbers(df, pairs)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = block_moments(_matrix(batch.columns), left, right)
                total = one if total is None else merge(total, one)
        if total is not None:
            arrays = [pa.array(np.arange(len(left), dtype=np.int32)), *[pa.array(total[c]) for c in _FIELDS]]
            yield pa.RecordBatch.from_arrays(arrays, names=["_p", *_FIELDS])

    return df.select(*columns).mapInArrow(blocks, SCHEMA)


def profile_blocks(df: DataFrame, keys: list[str], missing: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Two statistics of a table in ONE scan, as tagged rows of each task: ``_kind`` "counts" has, per tuple of the (few)
    ``keys``, the rows and how many of them miss each column of ``missing`` (array ``_missing``); "moments" has what
    ``pair_moments`` gives for ``pairs``. Both add up: ``profile_counts`` and ``merged_moments``."""
    columns, left, right = _numbers(df, pairs)
    flags = [is_missing_col(df, c).cast("long").alias(f"f{i}") for i, c in enumerate(missing)]
    names = [f"k{i}" for i in range(len(keys))]
    data = df.select(*[F.col(k).cast("string").alias(n) for k, n in zip(keys, names)], *flags, *columns)
    first = len(names) + len(flags)
    schema = "_kind string, " + "".join(f"{n} string, " for n in names) + "_rows long, _missing array<long>, " + SCHEMA
    count = [([], "count_all"), *[(f"f{i}", "sum") for i in range(len(missing))]]
    sums = [("count_all", "sum"), *[(f"f{i}_sum", "sum") for i in range(len(missing))]]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            one = block_moments(_matrix(batch.columns[first:]), left, right)
            total = one if total is None else merge(total, one)
            seen.append(pa.Table.from_batches([batch]).group_by(names).aggregate(count))
        if total is None:
            return
        table = pa.concat_tables(seen).group_by(names).aggregate(sums)
        nulls = np.column_stack([table.column(f"f{i}_sum_sum").to_numpy() for i in range(len(missing))]).tolist()
        n, p = table.num_rows, len(left)
        out = {"_kind": ["counts"] * n + ["moments"] * p, **{k: table.column(k).to_pylist() + [None] * p for k in names},
               "_rows": table.column("count_all_sum").to_pylist() + [None] * p, "_missing": nulls + [None] * p,
               "_p": [None] * n + list(range(p)), **{c: [None] * n + total[c].tolist() for c in _FIELDS}}
        kinds = {"_kind": pa.string(), **dict.fromkeys(names, pa.string()), "_rows": pa.int64(), "_missing": pa.list_(pa.int64()), "_p": pa.int32()}
        yield pa.RecordBatch.from_arrays([pa.array(v, type=kinds.get(c, pa.float64())) for c, v in out.items()], names=list(out))

    out = data.mapInArrow(blocks, schema)
    return out.withColumnsRenamed(dict(zip(names, [f"_key{i}" for i in range(len(keys))])))


def profile_counts(blocks: DataFrame, keys: list[str], missing: list[str], rows: str = "_rows") -> DataFrame:
    """``keys``, number of rows, and per column of ``missing`` the rows that miss it (a column of that name, suffix ``_nulos``)."""
    only = blocks.filter(F.col("_kind") == "counts")
    return only.groupBy(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)]).agg(
        F.sum("_rows").alias(rows), *[F.sum(F.col("_missing")[i]).alias(f"{c}_nulos") for i, c in enumerate(missing)])


def merged_moments(blocks: DataFrame) -> DataFrame:
    """One row for each pair: the tasks' moments merged by the parallel formula (means relative to the least of them, so
    that equal means stay equal exactly)."""
    pair = Window.partitionBy("_p")
    known = blocks.filter("n > 0")
    for c in ("mx", "my"):
        base = F.min(c).over(pair)
        known = known.withColumn(f"_d{c}", F.col(c) - (base + F.sum(F.col("n") * (F.col(c) - base)).over(pair) / F.sum("n").over(pair)))
    between = {"cxx": F.col("_dmx") * F.col("_dmx"), "cyy": F.col("_dmy") * F.col("_dmy"), "cxy": F.col("_dmx") * F.col("_dmy")}
    return known.groupBy("_p").agg(F.sum("n").alias("n"), *[F.sum(F.col(c) + F.col("n") * d).alias(c) for c, d in between.items()])


def pair_correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pairwise-complete Pearson r for the given column pairs: (pair index ``_p``, ``_r``). Pairs without a row where both
    are known are left out; zero variance gives NULL (no ANSI error, no NaN)."""
    return correlations(merged_moments(pair_moments(df, pairs)))


def correlations(moments: DataFrame) -> DataFrame:
    """(``_p``, ``_r``) from merged moments."""
    return moments.select("_p", safe_div(F.col("cxy"), F.sqrt("cxx") * F.sqrt("cyy")).alias("_r"))


__all__ = ["block_moments", "correlations", "merge", "merged_moments", "pair_correlations", "pair_moments", "profile_blocks",
           "profile_counts"]
