"""M13 over large tables: random forests grown from counted rows.

A forest looks at a row only through its label and the bins of its features, so rows that agree in them are one row with
a count. Bagging draws a row's Poisson(1) copies for each tree; the sum over ``n`` equal rows is Poisson(n), drawn at
once. The forests of a grid share their trees: the bags and the features tried at a node depend on the seed, the tree and
the node alone, so a forest of fewer trees is the first of a larger one's, and a shallower tree is a deeper one cut off.
They are the forests of separate fits. All trees of a fit grow together, level by level: tasks add up the histograms of the
nodes in the works, the best splits are found where the histograms meet, and only those come to the driver.

As Spark's forest: Gini impurity, midpoints between distinct values as thresholds (beyond ``maxBins`` values: of bins of
about equal weight, from all rows), ``featureSubsetStrategy`` at each node, ``minInstancesPerNode`` and ``minInfoGain``,
leaves of one parent with one prediction merged. The models are Spark's ``RandomForestClassificationModel``. The trees do
not depend on how the table is partitioned. NaN goes right at every node.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from surveyspark.session import reliable_checkpoint, scratch_path

#: The column with the number of rows that a counted row stands for.
COUNT = "_rows"
#: Counted rows in a block (about), counted rows a task gets in large tables, histogram cells a task holds, cells that meet in one row.
BLOCK, TASK_ROWS, CELLS, PART_CELLS = 4096, 500_000, 1 << 22, 1 << 17
_LEAF_CUT = 1 << 20
_TREE_PARAMS = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
                "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "probabilityCol", "rawPredictionCol", "seed"}
_U = np.uint64


class CountedForest(RandomForestClassifier):
    """A forest that ``fit_counted`` grows from rows with a COUNT (``ml.ClassifierPipeline`` counts them)."""

    def can_count(self) -> bool:
        """Settings that ``fit_counted`` knows; with others the forest is Spark's own."""
        return (self.getImpurity() == "gini" and self.getBootstrap() and self.getSubsamplingRate() == 1.0
                and self.getMinWeightFractionPerNode() == 0.0 and not (self.hasParam("weightCol") and self.isSet("weightCol")))

    def subset_size(self, features: int) -> int:
        """Features tried at a node (as Spark's ``featureSubsetStrategy``)."""
        how = self.getFeatureSubsetStrategy().lower()
        if how == "auto":
            how = "all" if self.getNumTrees() == 1 else "sqrt"
        named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
        if how in named:
            return named[how]
        if how.isdigit():
            return min(int(how), features)
        return max(1, math.ceil(float(how) * features))


def counted(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct rows of ``columns``, each with its COUNT: checkpointed, and dealt to all cores."""
    rows = reliable_checkpoint(df.groupBy(*columns).agg(F.count(F.lit(1)).alias(COUNT)))
    return rows.repartition(max(2 * df.sparkSession.sparkContext.defaultParallelism, rows.count() // TASK_ROWS))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def tried(seed: int, trees: np.ndarray, heaps: np.ndarray, features: int, size: int) -> np.ndarray:
    """The features tried at nodes (tree, heap number), ascending: those with the least hashes of seed, tree, node and feature."""
    if size >= features:
        return np.tile(np.arange(features), (len(trees), 1))
    node = _mix(_mix(trees.astype(_U) + _mix(np.array([seed & (1 << 64) - 1], dtype=_U))) + heaps.astype(_U))
    hashes = _mix(node[:, None] + _mix(np.arange(1, features + 1, dtype=_U))[None, :])
    return np.sort(np.argpartition(hashes, size - 1, axis=1)[:, :size], axis=1)


# ---------------------------------------------------------------- bins

def thresholds(rows: DataFrame, features: int, max_bins: int) -> list[np.ndarray]:
    """The candidate thresholds of each feature, from all rows (columns x, an array, and COUNT)."""
    schema = pa.schema([("feature", pa.int32()), ("value", pa.float64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, features)
            n = batch.column(1).to_numpy()
            found = [np.unique(x[:, f], return_inverse=True) for f in range(features)]
            at = np.repeat(np.arange(features), [len(v) for v, _ in found])
            sums = [np.bincount(i, weights=n, minlength=len(v)) for v, i in found]
            yield pa.RecordBatch.from_arrays([pa.array(a, type=t) for a, t in zip((at, np.concatenate([v for v, _ in found]), np.concatenate(sums).astype(np.int64)), schema.types)], schema=schema)

    values = rows.select("x", COUNT).mapInArrow(run, "feature int, value double, n long").where(~F.isnan("value"))
    values = reliable_checkpoint(values.groupBy("feature", "value").agg(F.sum("n").alias("n")))
    distinct = {r[0]: r[1] for r in values.groupBy("feature").count().collect()}
    many = [f for f, d in distinct.items() if d > max_bins]
    out: list[list[float]] = [[] for _ in range(features)]
    for f, v in values.where(~F.col("feature").isin(many)).select("feature", "value").collect():  # at most features x maxBins rows
        out[f].append(v)
    cuts = [(lambda v: (v[1:] + v[:-1]) / 2)(np.array(sorted(v))) for v in out]
    if many:
        one = Window.partitionBy("feature")
        order = one.orderBy("value")
        wide = values.where(F.col("feature").isin(many)).withColumns({"_all": F.sum("n").over(one), "_to": F.sum("n").over(order)})
        wide = wide.withColumn("_bin", F.floor((F.col("_to") - 1) * float(max_bins) / F.col("_all")))
        wide = wide.withColumns({"_next": F.lead("value").over(order), "_after": F.lead("_bin").over(order)})
        got = wide.where(F.col("_bin") != F.col("_after")).select("feature", ((F.col("value") + F.col("_next")) / 2).alias("cut")).collect()
        for f in many:
            cuts[f] = np.array(sorted(r[1] for r in got if r[0] == f))
    return cuts


def blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Checkpointed blocks (block, rows, bins, y, n) of about BLOCK rows that agree in no (label, bins), the same under any partitioning."""
    width = len(cuts)
    kind = np.uint8 if max(map(len, cuts)) < 256 else np.uint16
    schema = pa.schema([("y", pa.int32()), ("bins", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, width)
            bins = np.empty(x.shape, dtype=kind)
            for f, c in enumerate(cuts):
                bins[:, f] = np.searchsorted(c, x[:, f], side="left")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b.tobytes() for b in bins], pa.binary()), batch.column(2)], schema=schema)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bins", "ascending"), ("y", "ascending")])
        y, n = (table.column(c).to_numpy() for c in ("y", "n"))
        packed = [[table.column("block")[0].as_py()], [table.num_rows], [b"".join(table.column("bins").to_pylist())], [y.astype(np.int32).tobytes()], [n.astype(np.int64).tobytes()]]
        return pa.table(packed, schema=pa.schema([("block", pa.int64()), ("rows", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()), ("n", pa.binary())]))

    binned = rows.select("y", "x", COUNT).mapInArrow(run, "y int, bins binary, n long")
    binned = reliable_checkpoint(binned.groupBy("y", "bins").agg(F.sum("n").alias("n")))
    total = binned.count()
    if not total:
        raise ValueError("a forest needs rows")
    number = math.ceil(total / BLOCK)
    tasks = min(number, max(2 * rows.sparkSession.sparkContext.defaultParallelism, total // TASK_ROWS))
    dealt = binned.withColumn("block", F.pmod(F.xxhash64("y", "bins"), F.lit(number)).cast("long")).repartition(tasks, "block")
    return reliable_checkpoint(dealt.groupBy("block").applyInArrow(pack, "block long, rows int, bins binary, y binary, n binary"))


# ---------------------------------------------------------------- trees

@dataclass
class Tree:
    """Nodes in the order of their making; ``left`` is a node's left child (the right one follows), or the node itself."""

    heap: list[int] = field(default_factory=lambda: [1])
    feature: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [_LEAF_CUT])
    left: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    stats: list[np.ndarray | None] = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, cut: int, gain: float, left: np.ndarray, right: np.ndarray) -> None:
        child = len(self.heap)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, child, gain
        for k, stats in enumerate((left, right)):
            self.heap.append(2 * self.heap[node] + k)
            self.feature.append(0)
            self.cut.append(_LEAF_CUT)
            self.left.append(child + k)
            self.gain.append(-1.0)
            self.stats.append(stats)

    def nodes(self, depth: int, cuts: list[np.ndarray]) -> list[tuple]:
        """Spark's node records of the tree cut off at ``depth``, in preorder, with equal leaves of a parent merged."""
        leaf = [i == left or h.bit_length() > depth for i, (left, h) in enumerate(zip(self.left, self.heap))]
        says = [int(np.argmax(s)) for s in self.stats]
        for i in reversed(range(len(leaf))):
            a = self.left[i]
            leaf[i] = leaf[i] or (leaf[a] and leaf[a + 1] and says[a] == says[a + 1])
        out: list[list] = []
        stack = [(0, -1, 0)]
        while stack:
            i, parent, slot = stack.pop()
            at, stats = len(out), self.stats[i]
            if parent >= 0:
                out[parent][slot] = at
            total = float(stats.sum())
            impurity = 1 - float(((stats / total) ** 2).sum()) if total else 0.0
            cell = (-1, [], -1) if leaf[i] else (self.feature[i], [float(cuts[self.feature[i]][self.cut[i]])], -1)
            out.append([at, float(says[i]), impurity, stats.tolist(), int(total), -1.0 if leaf[i] else self.gain[i], -1, -1, cell])
            if not leaf[i]:
                stack += [(self.left[i] + 1, at, 7), (self.left[i], at, 6)]
        return [tuple(x) for x in out]


def best_splits(cells: np.ndarray, widths: np.ndarray, classes: int, min_rows: int, min_gain: float):
    """Per node: its statistics, the place of its best split (-1: none) among its histograms' bins, its gain, the statistics left of it.

    ``cells``: the histograms of the nodes' features one after another, bins x classes; ``widths``: nodes x features tried, their bins."""
    hist = cells.reshape(-1, classes)
    flat = widths.ravel()
    ends = np.cumsum(flat)
    starts = ends - flat
    total = np.add.reduceat(hist, starts, axis=0)
    upto = np.cumsum(hist, axis=0)
    of = np.repeat(np.arange(len(flat)), flat)
    left = upto - (upto[starts] - hist[starts])[of]
    whole = total[of]
    right = whole - left
    nl, nr, n = left.sum(1), right.sum(1), whole.sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gini = lambda s, m: 1 - ((s / m[:, None]) ** 2).sum(1)
        gain = gini(whole, n) - nl / n * gini(left, nl) - nr / n * gini(right, nr)
    ok = (nl >= max(min_rows, 1)) & (nr >= max(min_rows, 1))
    ok[ends - 1] = False
    gain = np.where(ok & (gain > 0) & (gain >= min_gain), gain, -np.inf)
    node_starts = starts[:: widths.shape[1]]
    best = np.maximum.reduceat(gain, node_starts)
    owner = of // widths.shape[1]
    hits = np.flatnonzero(gain == best[owner])
    at = hits[np.searchsorted(owner[hits], np.arange(len(node_starts)))]
    return total[:: widths.shape[1]], np.where(np.isfinite(best), at, -1), best, left[at]


def grow(data: DataFrame, cuts: list[np.ndarray], classes: int, *, trees: int, depth: int, seed: int, size: int, min_rows: int, min_gain: float) -> list[Tree]:
    """All trees, level by level; a level's nodes go in passes of CELLS histogram cells at most (or one node)."""
    features = len(cuts)
    bins = np.array([len(c) + 1 for c in cuts])
    kind = np.uint8 if max(map(len, cuts)) < 256 else np.uint16
    forest = [Tree() for _ in range(trees)]
    active = [(t, 0) for t in range(trees)]
    for level in range(max(depth, 1)):
        chosen = tried(seed, np.array([t for t, _ in active]), np.array([forest[t].heap[i] for t, i in active]), features, size)
        cells = bins[chosen].sum(1) * classes
        following: list[tuple[int, int]] = []
        start = 0
        while start < len(active):
            stop = start + max(1, int(np.searchsorted(np.cumsum(cells[start:]), CELLS, side="right")))
            found = _pass(data, forest, active[start:stop], chosen[start:stop], bins, classes, kind, seed, level, min_rows, min_gain)
            for (t, i), k, (stats, at, gain, left) in zip(active[start:stop], range(start, stop), found):
                tree = forest[t]
                tree.stats[i] = stats
                if at < 0 or level >= depth:
                    continue
                ends = np.cumsum(bins[chosen[k]])
                j = int(np.searchsorted(ends, at, side="right"))
                tree.split(i, int(chosen[k][j]), int(at - ends[j] + bins[chosen[k][j]]), gain, left, stats - left)
                if level + 1 < depth:
                    following += [(t, c) for c in (tree.left[i], tree.left[i] + 1) if np.count_nonzero(tree.stats[c]) > 1]
            start = stop
        active = following
        if not active:
            break
    return forest


def _pass(data, forest, nodes, chosen, bins, classes, kind, seed, level, min_rows, min_gain) -> list[tuple]:
    """(statistics, place of the best split or -1, gain, statistics left of it) of each node, in order."""
    features, widths = len(bins), bins[chosen]
    base = (np.cumsum(widths.ravel()) - widths.ravel()).reshape(widths.shape) * classes
    own = widths.sum(1) * classes
    ends = np.cumsum(own)
    part = (ends - own) // PART_CELLS  # nodes whose histograms meet in one row
    first = np.flatnonzero(np.diff(part, prepend=-1))
    spans = [(int(a), int(b)) for a, b in zip(first, [*first[1:], len(nodes)])]
    by_tree: dict[int, list[int]] = {}
    for k, (t, _) in enumerate(nodes):
        by_tree.setdefault(t, []).append(k)
    plans = []
    for t, slots in by_tree.items():
        tree = forest[t]
        slot = np.full(len(tree.heap), -1, dtype=np.int64)
        slot[[nodes[k][1] for k in slots]] = slots
        plans.append((t, np.array(tree.feature), np.array(tree.cut), np.array(tree.left), slot, int(ends[slots[0]] - own[slots[0]]), int(ends[slots[-1]])))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros(int(ends[-1]))
        for batch in batches:
            for block, rows, raw, y, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = np.frombuffer(raw, dtype=kind)
                y, n = np.frombuffer(y, dtype=np.int32).astype(np.int64), np.frombuffer(n, dtype=np.int64)
                line = np.arange(rows) * features
                for t, feature, cut, left, slot, lo, hi in plans:
                    weight = np.random.Generator(np.random.PCG64([seed & (1 << 64) - 1, t, block])).poisson(n)
                    at = np.zeros(rows, dtype=np.int64)
                    for _ in range(level):
                        at = left.take(at) + (x.take(line + feature.take(at)) > cut.take(at))
                    mine = slot.take(at)
                    use = np.flatnonzero((mine >= 0) & (weight > 0))
                    s = mine.take(use)
                    cell = x.take(line.take(use)[:, None] + chosen.take(s, axis=0)).astype(np.int64) * classes
                    cell += base.take(s, axis=0)
                    cell += (y.take(use) - lo)[:, None]
                    hist[lo:hi] += np.bincount(cell.ravel(), weights=np.repeat(weight.take(use), cell.shape[1]), minlength=hi - lo)
        parts = [(p, hist[ends[a] - own[a] : ends[b - 1]]) for p, (a, b) in enumerate(spans)]
        schema = pa.schema([("part", pa.int32()), ("hist", pa.binary())])
        for p, h in parts:
            if h.any():
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([h.tobytes()], pa.binary())], schema=schema)

    out = pa.schema([("node", pa.int32()), ("stats", pa.binary()), ("at", pa.int64()), ("gain", pa.float64()), ("below", pa.binary())])

    def choose(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = spans[key[0].as_py()]
        hist = np.zeros(int(ends[b - 1] - ends[a] + own[a]))
        for table in tables:
            for h in table.column("hist"):
                hist += np.frombuffer(h.as_buffer(), dtype=np.float64)
        stats, at, gain, left = best_splits(hist, widths[a:b], classes, min_rows, min_gain)
        inside = at - (ends[a:b] - own[a:b] - ends[a] + own[a]) // classes
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(a, b), pa.int32()), pa.array([s.tobytes() for s in stats]), pa.array(np.where(at < 0, -1, inside)),
                                          pa.array(gain), pa.array([s.tobytes() for s in left])], schema=out)

    hists = data.mapInArrow(add_up, "part int, hist binary")
    got = hists.groupBy("part").applyInArrow(choose, "node int, stats binary, at long, gain double, below binary").toArrow()
    none = (np.zeros(classes), -1, -1.0, np.zeros(classes))
    found = [none] * len(nodes)
    for node, stats, at, gain, below in zip(*(c.to_pylist() for c in got.columns), strict=True):
        found[node] = (np.frombuffer(stats), at, gain, np.frombuffer(below))
    return found


# ---------------------------------------------------------------- models

def _class_count(rows: DataFrame, label: str) -> int:
    attr = rows.schema[label].metadata.get("ml_attr", {})
    return len(attr["vals"]) if "vals" in attr else int(rows.agg(F.max(label)).first()[0]) + 1


@dataclass
class Grown:
    """The trees of a forest before they are cut off at its depth."""

    trees: list[Tree]
    cuts: list[np.ndarray]
    classes: int
    depth: int


def _arrays(rows: DataFrame, forest: CountedForest) -> DataFrame:
    return rows.select(F.col(forest.getLabelCol()).cast("int").alias("y"), vector_to_array(forest.getFeaturesCol()).alias("x"), F.col(COUNT).cast("long").alias(COUNT))


def grow_counted(rows: DataFrame, forests: list[CountedForest]) -> list[Grown]:
    """The trees of ``forests`` (which may differ in any setting but the columns) over rows with a COUNT."""
    classes, flat = _class_count(rows, forests[0].getLabelCol()), _arrays(rows, forests[0])
    features = rows.schema[forests[0].getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs")
    if features is None:
        head = flat.select(F.size("x")).first()
        if head is None:
            raise ValueError("a forest needs rows")
        features = head[0]
    keys = [(f.getMaxBins(), f.getSeed(), f.subset_size(features), f.getMinInstancesPerNode(), f.getMinInfoGain()) for f in forests]
    laid: dict[int, tuple] = {}
    grown: dict[tuple, list[Tree]] = {}
    for key in keys:
        if key[0] not in laid:
            cuts = thresholds(flat, features, key[0])
            laid[key[0]] = cuts, blocks(flat, cuts)
        if key not in grown:
            alike = [f for f, k in zip(forests, keys) if k == key]
            most, deep = (max(get(f) for f in alike) for get in (CountedForest.getNumTrees, CountedForest.getMaxDepth))
            cuts, data = laid[key[0]]
            grown[key] = grow(data, cuts, classes, trees=most, depth=deep, seed=key[1], size=key[2], min_rows=key[3], min_gain=key[4])
    return [Grown(grown[key][: f.getNumTrees()], laid[key[0]][0], classes, f.getMaxDepth()) for key, f in zip(keys, forests)]


def confusions(rows: DataFrame, forest: CountedForest, points: list[Grown]) -> list[list[tuple]]:
    """(label, prediction, rows) counts of each grown forest over rows with a COUNT, predicted as Spark's model does:
    the trees' class shares are added up, the first largest sum is it."""
    plans = []  # a tree is walked once for all points that cut it off at the same depth
    for depth in sorted({p.depth for p in points}):
        mine = [i for i, p in enumerate(points) if p.depth == depth]
        for lead in {id(points[i].trees[0]): i for i in mine}.values():
            same = [i for i in mine if points[i].trees[0] is points[lead].trees[0]]
            longest = max((points[i] for i in same), key=lambda p: len(p.trees))
            plans.append(([_walk(t.nodes(depth, longest.cuts)) for t in longest.trees], {len(points[i].trees): [j for j in same if len(points[j].trees) == len(points[i].trees)] for i in same}))
    features, classes = len(points[0].cuts), points[0].classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(points), classes, classes))
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, features)
            y, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            line = np.arange(len(x))
            for walks, ends in plans:
                raw = np.zeros((len(x), classes))
                for t, (feature, cut, left, right, shares, steps) in enumerate(walks, 1):
                    at = np.zeros(len(x), dtype=np.int64)
                    for _ in range(steps):
                        at = np.where(x[line, feature[at]] <= cut[at], left[at], right[at])
                    raw += shares[at]
                    for i in ends.get(t, ()):
                        np.add.at(sums[i], (y, raw.argmax(1)), n)
        point, label, says = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(point, pa.int32()), pa.array(label, pa.int32()), pa.array(says, pa.int32()), pa.array(sums[point, label, says].astype(np.int64))],
                                         names=["point", "label", "prediction", "n"])

    got = _arrays(rows, forest).mapInArrow(run, "point int, label int, prediction int, n long").groupBy("point", "label", "prediction").agg(F.sum("n").alias("n"))
    out: list[list[tuple]] = [[] for _ in points]
    for point, label, says, n in got.collect():  # at most points x classes x classes rows
        out[point].append((float(label), float(says), n))
    return out


def _walk(nodes: list[tuple]) -> tuple:
    """Arrays to walk a tree by: leaves lead to themselves."""
    leaf = np.array([n[6] < 0 for n in nodes])
    own = np.arange(len(nodes))
    left, right = (np.where(leaf, own, [n[k] for n in nodes]) for k in (6, 7))
    feature = np.array([max(n[8][0], 0) for n in nodes])
    cut = np.array([n[8][1][0] if n[8][1] else 0.0 for n in nodes])
    stats = np.array([n[3] for n in nodes])
    depth = np.zeros(len(nodes), dtype=int)
    for i in np.flatnonzero(~leaf):
        depth[[left[i], right[i]]] = depth[i] + 1
    sums = stats.sum(1, keepdims=True)
    return feature, cut, left, right, np.divide(stats, sums, out=np.zeros_like(stats), where=sums > 0), int(depth.max())


def fit_counted(rows: DataFrame, forests: list[CountedForest]) -> Iterator[RandomForestClassificationModel]:
    """Spark's models of ``forests`` over rows with a COUNT, one after another."""
    for forest, grown in zip(forests, grow_counted(rows, forests)):
        yield _model(rows.sparkSession, forest, grown.trees, grown.cuts, grown.classes)


def _model(spark, forest: CountedForest, trees: list[Tree], cuts: list[np.ndarray], classes: int) -> RandomForestClassificationModel:
    """Spark's model of the trees, through the files that it is saved in."""
    path = scratch_path(spark, "forest")
    given, defaults = ({p.name: v for p, v in m.items()} for m in (forest._paramMap, forest._defaultParamMap))
    about = {"timestamp": 0, "sparkVersion": spark.version}
    top = {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", **about, "uid": forest.uid, "paramMap": given, "defaultParamMap": defaults,
           "numFeatures": len(cuts), "numClasses": classes, "numTrees": len(trees)}
    params = [{k: v for k, v in m.items() if k in _TREE_PARAMS} for m in (given, defaults)]
    one = {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", **about, "paramMap": params[0], "defaultParamMap": params[1]}
    spark.createDataFrame([(json.dumps(top),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    meta = [(t, json.dumps({**one, "uid": f"dtc_{uuid.uuid4().hex[:12]}"}), 1.0) for t in range(len(trees))]
    spark.createDataFrame(meta, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    node = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
                      ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                      ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])
    names = [f.name for f in node]
    inner = [f.name for f in node.field("split").type]
    records = [(t, dict(zip(names, (*n[:-1], dict(zip(inner, n[-1])))))) for t, tree in enumerate(trees) for n in tree.nodes(forest.getMaxDepth(), cuts)]
    table = pa.table([pa.array([t for t, _ in records], pa.int32()), pa.array([n for _, n in records], node)], names=["treeID", "nodeData"])
    spark.createDataFrame(table).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
