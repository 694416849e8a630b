"""Exact top-k inner products by a pivot-distance index.

Vectors are turned into integers (floor of 1024 times each component) and given one more coordinate,
sqrt(M^2 - |v|^2) with M the largest norm, and 0 for queries. Then the order by inner product is the
order by Euclidean distance, |q - v|^2 = |q|^2 + M^2 - 2 q.v, and the triangle inequality holds.
Every vector is keyed by its nearest pivot and its distance to it; each pivot's vectors are cut into
annuli of about equal size. A query visits annuli in order of the least distance that the triangle
inequality allows them, in rounds of growing width, and stops where that distance is beyond its
k-th best so far. So the result is exact; equal scores go to the smaller vec_id.

The pivots are drawn from a bounded sample (``sample`` rows); every row is indexed. Large annuli, and
the queries that visit one, are split into blocks of bounded size, so one frequent vector fills no task.

Cases: null vectors, those with null or non-finite components, and rows without a vec_id take no part;
vectors of different length have no product; repeated rows count once; an empty table gives no rows.
The rows of a query's own vec_id are not its candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveyspark.llm.common import batch_of, stored

NEVER = -(1 << 62)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, v) of the rows that take part; v: floor(1024 x) of each component, as doubles."""
    x = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False)) & (F.size(x) > 0)
    v = F.transform(x, lambda c: F.floor(c * 1024).cast("double"))
    return df.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.size(x).alias("dim"), v.alias("v")).distinct()


def _square(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, c: s + c * c)


@dataclass
class Index:
    """What every task needs to know of the index; of bounded size (pivots x annuli)."""

    pivots: dict[int, np.ndarray]  # by dimension: pivots, with their further coordinate
    most: dict[int, float]  # by dimension: the largest squared norm
    blocks: dict[int, np.ndarray]  # by dimension: rows (block, pivot, least distance, largest distance)


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist() if isinstance(column, pa.Array) else list(column), dtype=np.float64)


def _distances(v: np.ndarray, last: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    full = np.hstack([v, last[:, None]])
    return np.sqrt(np.maximum((full**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * full @ pivots.T, 0))


ASSIGNED = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("v", pa.list_(pa.float64())), ("pivot", pa.int32()), ("dist", pa.float64())])


def _assign(pivots: dict[int, np.ndarray], most: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                v = _matrix(part.column(2))
                d = _distances(v, np.sqrt(np.maximum(most[dim] - (v**2).sum(1), 0)), pivots[dim])
                near = d.argmin(1)
                yield batch_of(ASSIGNED, part.column(0), part.column(1), part.column(2), near.astype("i4"), d[np.arange(len(d)), near])

    return run


def build_index(vectors: DataFrame, *, pivots: int, annuli: int, sample: int) -> tuple[DataFrame, Index]:
    """The vectors with their block (stored), and the index."""
    most = {r["dim"]: r["m"] for r in vectors.groupBy("dim").agg(F.max(_square(F.col("v"))).alias("m")).collect()}
    points: dict[int, np.ndarray] = {}
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()
    for dim in most:
        v = np.array([r.v for r in drawn if r.dim == dim], dtype=np.float64).reshape(-1, dim)
        if not len(v):
            v = np.zeros((1, dim))
        full = np.hstack([v, np.sqrt(np.maximum(most[dim] - (v**2).sum(1), 0))[:, None]])
        chosen, far = [0], np.full(len(full), np.inf)
        while len(chosen) < min(pivots, len(full)):  # each next pivot is the sample's farthest from those chosen
            far = np.minimum(far, ((full - full[chosen[-1]]) ** 2).sum(1))
            if far.max() == 0:
                break
            chosen.append(int(far.argmax()))
        points[dim] = full[chosen]
    keyed = vectors.mapInArrow(_assign(points, most), "vec_id long, dim int, v array<double>, pivot int, dist double")
    keyed = stored(keyed, "pivot-distances")
    cuts = keyed.groupBy("dim", "pivot").agg(F.percentile_approx("dist", [i / annuli for i in range(1, annuli)], 2000).alias("cuts"))  # pivots rows
    ring = F.size(F.filter("cuts", lambda c: c < F.col("dist")))
    placed = keyed.join(F.broadcast(cuts), ["dim", "pivot"]).select("vec_id", "dim", "v", "dist", (F.col("pivot") * annuli + ring).alias("block"))
    placed = stored(placed, "pivot-annuli")
    rows = placed.groupBy("dim", "block").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi")).collect()  # pivots x annuli rows
    blocks = {dim: np.array([(r.block, r.block // annuli, r.lo, r.hi) for r in rows if r.dim == dim], dtype=np.float64) for dim in most}
    return placed, Index(points, most, blocks)


VISITS = pa.schema([("query_id", pa.int64()), ("dim", pa.int32()), ("block", pa.int32()), ("v", pa.list_(pa.float64())), ("least", pa.int64())])


def _visits(index: Index, first: int, last: int):
    """The annuli that each query visits as its ``first``-th to ``last``-th nearest, unless its k-th best rules them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query_id, dim, v, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks, q = index.blocks[dim], np.array([v], dtype=np.float64)
                d = _distances(q, np.zeros(1), index.pivots[dim])[0][blocks[:, 1].astype(int)]
                bound = np.maximum(np.maximum(blocks[:, 2] - d, d - blocks[:, 3]), 0)
                order = np.lexsort((blocks[:, 0], bound))[first:last]
                reach = np.sqrt(max((q**2).sum() + index.most[dim] - 2 * least, 0)) if least > NEVER else np.inf
                order = order[bound[order] <= reach * (1 + 1e-9) + 1e-3]
                n = len(order)
                if n:
                    yield batch_of(VISITS, [query_id] * n, [dim] * n, blocks[order, 0].astype("i4"), [v] * n, [least] * n)

    return run


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where those are exact."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _scan(k: int):
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": [], "qhash": [], "vec_id": [], "score": []})
        ids, out = vectors["vec_id"].to_numpy(), []
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], _matrix(vectors["v"])[order]
        for at in range(0, len(queries), 256):
            part = queries.iloc[at : at + 256]
            scores = _products(_matrix(part["v"]), v)
            for query_id, mark, least, s in zip(part["query_id"], part["qhash"], part["least"], scores, strict=True):
                at_least = np.flatnonzero((s >= least) & (ids != query_id))
                best = at_least[np.argsort(-s[at_least], kind="stable")[:k]]
                out.append(pd.DataFrame({"query_id": query_id, "qhash": mark, "vec_id": ids[best], "score": s[best]}))
        return pd.concat(out)

    return run


def top_k(vectors: DataFrame, query: Column | None = None, *, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = 32, annuli: int = 16, sample: int = 4096,
          rounds=(2, 34, None), block_rows: int = 8192, block_queries: int = 2048) -> DataFrame:
    """Per query: query_id, rank (from 1), vec_id, score. ``query``: condition on vec_id; by default those divisible by 100."""
    spark = vectors.sparkSession
    given = stored(integer_vectors(vectors, id_col, vec_col), "integer-vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if given.isEmpty():
        return empty
    placed, index = build_index(given, pivots=pivots, annuli=annuli, sample=sample)
    queries = given.where(F.col("vec_id") % 100 == 0 if query is None else query).select(F.col("vec_id").alias("query_id"), "dim", "v")
    sizes = placed.groupBy("dim", "block").agg((F.floor((F.count("*") - 1) / block_rows) + 1).cast("int").alias("parts"))
    best, first = None, 0
    by_query = W.partitionBy("query_id", "qhash").orderBy(F.desc("score"), "vec_id")
    for last in rounds:
        todo = queries.withColumn("qhash", F.xxhash64("v"))
        if best is not None:
            reached = best.where(F.col("rank") == k).select("query_id", "qhash", F.col("score").alias("least"))
            todo = todo.join(reached, ["query_id", "qhash"], "left").select("query_id", "dim", "v", F.coalesce("least", F.lit(NEVER)).alias("least"))
        else:
            todo = todo.select("query_id", "dim", "v", F.lit(NEVER).cast("long").alias("least"))
        visits = stored(todo.mapInArrow(_visits(index, first, last), "query_id long, dim int, block int, v array<double>, least long"), "annulus-visits")
        crowd = visits.groupBy("dim", "block").agg((F.floor((F.count("*") - 1) / block_queries) + 1).cast("int").alias("crowds"))
        layout = F.broadcast(crowd.join(sizes, ["dim", "block"]))  # pivots x annuli rows at most
        left = visits.withColumn("qhash", F.xxhash64("v")).join(layout, ["dim", "block"]).withColumns({"crowd": F.pmod(F.xxhash64("query_id", "v"), "crowds").cast("int"), "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
        right = placed.join(layout, ["dim", "block"]).withColumns({"part": F.pmod(F.xxhash64("vec_id", "v"), "parts").cast("int"), "crowd": F.explode(F.sequence(F.lit(0), F.col("crowds") - 1))})
        key = ["dim", "block", "part", "crowd"]
        found = left.select(*key, "query_id", "qhash", "v", "least").groupBy(*key).cogroup(right.select(*key, "vec_id", "v").groupBy(*key)).applyInPandas(_scan(k), "query_id long, qhash long, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = stored(found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k), "top-k")
        first = last
    return best.select("query_id", "rank", "vec_id", "score")
