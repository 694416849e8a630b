"""M13, M14 from counted rows: the forests of a grid, their bags, splits and scores (each test builds its own rows)."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from surveyspark.operators import forest as FO
from surveyspark.operators import ml as M


def _rows(n=240, copies=1):
    data = [(i % 2, float(i % 17), None if i % 13 == 0 else "abc"[i % 3], "xy"[i // 5 % 2], "no" if (i * 7) % 17 < 6 or i % 29 == 0 else "yes") for i in range(n)]
    return data * copies


SCHEMA = "fold int, x double, c string, d string, y string"


def _pipe(**params):
    return M.classifier_pipeline("y", ["x"], ["c", "d"], scale_numeric=True, unknown="ignore", count_rows=True, **{"numTrees": 3, "maxDepth": 3, **params})


def _trees(model):
    return model.stages[-1].toDebugString.split("\n", 1)[1]


def test_forest_is_grown_from_distinct_rows_under_any_partitioning(spark, monkeypatch):
    """Equal rows reach the forest as one row with a count, and the trees do not depend on the partitions."""
    seen, grow = [], FO.grow_counted
    monkeypatch.setattr(FO, "grow_counted", lambda rows, forests: seen.append((rows.count(), rows.agg(F.sum(FO.COUNT)).first()[0])) or grow(rows, forests))
    data = _rows(copies=20)
    df = spark.createDataFrame(data, SCHEMA)
    pipe, _ = M.classifier_pipeline("y", ["x"], ["c", "d"], count_rows=True, numTrees=3, maxDepth=3)  # a scaled x would differ in its last bits
    one, more = pipe.fit(df.repartition(1)), pipe.fit(df.repartition(5, "x"))
    assert seen == [(len({r[1:] for r in data}), len(data))] * 2
    assert _trees(one) == _trees(more) and isinstance(one.stages[-1], RandomForestClassificationModel)


def test_grid_of_counted_forests_is_that_of_separate_fits(spark):
    """Fewer trees are the first ones, shallower trees are cut off; fitting apart gives the same."""
    df = spark.createDataFrame(_rows(), SCHEMA).cache()
    pipe, rf = _pipe()
    points = [{rf.numTrees: n, rf.maxDepth: d} for n, d in ((5, 4), (5, 1), (3, 4))]
    found = dict(pipe.fitMultiple(df, points))
    assert [_trees(found[i]) for i in range(len(points))] == [_trees(pipe.fit(df, p)) for p in points]
    assert [m.stages[-1].getNumTrees for m in found.values()] == [5, 5, 3]
    assert all(t.depth <= p[rf.maxDepth] for i, p in enumerate(points) for t in found[i].stages[-1].trees)
    entropy = dict(pipe.fitMultiple(df, [{rf.impurity: "entropy"}]))[0]  # a setting that only Spark's forest knows
    assert entropy.stages[-1].getImpurity() == "entropy"


def test_scores_of_the_folds_are_those_of_all_their_rows(spark):
    df = spark.createDataFrame(_rows(copies=3), SCHEMA).cache()
    pipe, rf = _pipe()
    cv = M.grid_search(pipe, rf, [2], [1, 4], "fold", 2)
    got = cv.fit(df)
    plain = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    want = np.array([[plain.evaluate(m.transform(df.where(f"fold = {f}"))) for _, m in sorted(pipe.fitMultiple(df.where(f"fold != {f}"), cv.getEstimatorParamMaps()), key=lambda x: x[0])] for f in range(2)])
    assert np.allclose(got.avgMetrics, want.mean(0), atol=1e-12) and np.allclose(got.stdMetrics, want.std(0), atol=1e-12)
    best = cv.getEstimatorParamMaps()[int(np.argmax(want.mean(0)))]
    assert _trees(got.bestModel) == _trees(pipe.fit(df, best))
    with pytest.raises(ValueError, match="folds"):
        cv.fit(df.withColumn("fold", F.lit(7)))


def test_bags_splits_and_leaves(spark, tmp_path):
    """A tree's bag has Poisson(rows) rows; splits are the best by brute force; minInstancesPerNode counts bag rows; models are kept whole."""
    data = [(0, float(i % 200), "a", "x", "yes" if i % 200 >= 70 else "no") for i in range(4000)]
    df = spark.createDataFrame(data, SCHEMA)
    pipe, _ = M.classifier_pipeline("y", ["x"], [], count_rows=True, numTrees=40, maxDepth=4, maxBins=256, minInstancesPerNode=300)
    model = pipe.fit(df)
    roots = [t._call_java("rootNode") for t in model.stages[-1].trees]
    sizes = np.array([r.impurityStats().rawCount() for r in roots])
    assert abs(sizes.mean() - 4000) < 5 * (4000 / 40) ** 0.5 and 0.5 < sizes.std() / 4000**0.5 < 1.5
    assert all(r.split().threshold() == 69.5 and r.leftChild().subtreeDepth() == r.rightChild().subtreeDepth() == 0 for r in roots)
    assert M.evaluate(model, df, "y").first().accuracy == 1.0
    model.write().save(f"{tmp_path}/m")
    again = type(model).load(f"{tmp_path}/m")
    assert _trees(again) == _trees(model)
    few, _ = M.classifier_pipeline("y", ["x"], [], count_rows=True, numTrees=1, maxDepth=1, maxBins=4)
    cuts = FO.thresholds(spark.createDataFrame([([float(i)], 1) for i in range(100)] + [([7.0], 100)], f"x array<double>, {FO.COUNT} long"), 1, 4)
    assert len(few.fit(df).stages) == len(model.stages) and cuts[0].tolist() == [6.5, 49.5]


def test_best_split_by_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(50):
        widths = rng.integers(1, 6, (4, 2))
        total = rng.integers(0, 9, (4, 3))
        hist = []
        for k in range(4):
            for w in widths[k]:
                cells = np.zeros((w, 3))
                for c in range(3):
                    np.add.at(cells[:, c], rng.integers(0, w, total[k, c]), 1)
                hist.append(cells)
        stats, at, gain, left = FO.best_splits(np.concatenate(hist).ravel(), widths, 3, 2, 0.0)
        gini = lambda s: 1 - ((s / s.sum()) ** 2).sum()
        for k in range(4):
            assert stats[k].tolist() == total[k].tolist()
            best = 0.0
            for h in hist[2 * k : 2 * k + 2]:
                for b in range(len(h) - 1):
                    low, high = h[: b + 1].sum(0), h[b + 1 :].sum(0)
                    if min(low.sum(), high.sum()) >= 2:
                        best = max(best, gini(total[k]) - (low.sum() * gini(low) + high.sum() * gini(high)) / total[k].sum())
            assert (at[k] < 0 and best < 1e-12) or abs(gain[k] - best) < 1e-9


def test_counted_forest_does_as_well_as_sparks(spark):
    """On noisy labels its trees are as large and as right as those of Spark's forest."""
    rng = np.random.default_rng(1)
    x, c, d = rng.integers(0, 60, 6000), rng.integers(0, 3, 6000), rng.integers(0, 2, 6000)
    y = ((x > 30) ^ (rng.random(6000) < 0.2)) | (c == 2)
    df = spark.createDataFrame([(0, float(a), "abc"[b], "xy"[e], "yes" if g else "no") for a, b, e, g in zip(x, c, d, y)], SCHEMA).cache()
    mine, theirs = (M.classifier_pipeline("y", ["x"], ["c", "d"], count_rows=own, numTrees=30, maxDepth=5, maxBins=64)[0].fit(df) for own in (True, False))
    assert type(M.classifier_pipeline("y", ["x"], [], count_rows=False)[1]) is RandomForestClassifier
    a, b = (M.evaluate(m, df, "y").first().accuracy for m in (mine, theirs))
    sizes = [m.stages[-1].totalNumNodes for m in (mine, theirs)]
    assert abs(a - b) < 0.01 and a > 0.85 and 0.7 < sizes[0] / sizes[1] < 1.4


def test_forests_of_a_grid_are_grown_once(spark, monkeypatch):
    """Points that differ in trees and depth only are one forest; another setting is one of its own."""
    from pyspark.ml.linalg import Vectors

    grown, grow = [], FO.grow
    monkeypatch.setattr(FO, "grow", lambda *a, **k: grown.append((k["trees"], k["depth"])) or grow(*a, **k))
    rows = spark.createDataFrame([(float(v > 5), Vectors.dense([float(v)]), 10**8) for v in range(12)], ["label", "features", FO.COUNT])
    base = FO.CountedForest(seed=3)
    points = [base.copy({base.numTrees: n, base.maxDepth: d}) for n in (2, 4) for d in (1, 2)] + [base.copy({base.numTrees: 2, base.minInstancesPerNode: 2 * 10**9})]
    got = FO.grow_counted(rows, points)
    assert grown == [(4, 2), (2, 5)] and [len(g.trees) for g in got] == [2, 2, 4, 4, 2]
    assert all(t.heap == [1, 2, 3] and abs(t.stats[0].sum() - 12e8) < 1e6 for g in got[:4] for t in g.trees)
    assert all(t.heap == [1] for t in got[4].trees)
    assert sorted(FO.confusions(rows, base, got[:1])[0]) == [(0.0, 0.0, 6 * 10**8), (1.0, 1.0, 6 * 10**8)]
