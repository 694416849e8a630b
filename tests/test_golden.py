"""Goldens: published audit and cluster-profile report values (confusion matrix, metrics, shares)."""

from pyspark.sql import functions as F

from surveyspark.functions import codebooks as cb
from surveyspark.operators import aggregates as A
from surveyspark.operators import metrics as MT
from surveyspark.operators import ml as M

# Published audit: confusion matrix rows = true DESOCUPADO, OCUPADO; columns = predicted.
CELLS = [("DESOCUPADO", "DESOCUPADO", 8710), ("DESOCUPADO", "OCUPADO", 7305),
         ("OCUPADO", "DESOCUPADO", 3320), ("OCUPADO", "OCUPADO", 14494)]


def audit_rows(spark):
    cells = spark.createDataFrame(CELLS, "y string, pred string, n int")
    return cells.select("y", "pred", F.explode(F.array_repeat(F.lit(1), F.col("n"))).alias("_")).drop("_")


def test_audit_golden_metrics(spark):
    df = audit_rows(spark)
    assert df.count() == 33829
    m = MT.weighted_metrics(df, "y", "pred").collect()[0]
    assert round(m.accuracy, 4) == 0.6859
    assert round(m.precision_weighted, 4) == 0.6929
    assert round(m.recall_weighted, 4) == 0.6859
    assert round(m.f1_weighted, 4) == 0.6794


def test_audit_golden_per_class_and_report(spark):
    df = audit_rows(spark)
    cc = {r.clase: (r.tp, r.fp, r.fn, r.tn) for r in MT.class_counts(MT.confusion_matrix(df, "y", "pred")).collect()}
    assert cc == {"DESOCUPADO": (8710, 3320, 7305, 14494), "OCUPADO": (14494, 7305, 3320, 8710)}
    rep = {r.etiqueta: r for r in MT.classification_report(df, "y", "pred").collect()}
    assert (round(rep["DESOCUPADO"].precision, 2), round(rep["DESOCUPADO"].recall, 2), round(rep["DESOCUPADO"].f1_score, 2)) == (0.72, 0.54, 0.62)
    assert (round(rep["OCUPADO"].precision, 2), round(rep["OCUPADO"].recall, 2), round(rep["OCUPADO"].f1_score, 2)) == (0.66, 0.81, 0.73)
    assert rep["DESOCUPADO"].support == 16015 and rep["OCUPADO"].support == 17814
    assert round(rep["accuracy"].f1_score, 2) == 0.69 and rep["accuracy"].support == 33829
    assert (round(rep["macro avg"].precision, 2), round(rep["macro avg"].recall, 2), round(rep["macro avg"].f1_score, 2)) == (0.69, 0.68, 0.68)
    assert (round(rep["weighted avg"].precision, 2), round(rep["weighted avg"].recall, 2), round(rep["weighted avg"].f1_score, 2)) == (0.69, 0.69, 0.68)


def test_audit_golden_shares(spark):
    df = audit_rows(spark)
    real = {r.y: round(r.pct, 2) for r in A.value_counts(df, "y", normalize=True).collect()}
    pred = {r.pred: round(r.pct, 2) for r in A.value_counts(df, "pred", normalize=True).collect()}
    assert real == {"OCUPADO": 52.66, "DESOCUPADO": 47.34}
    assert pred == {"OCUPADO": 64.44, "DESOCUPADO": 35.56}
    rvp = {r.clase: (r.real, r.predicho) for r in MT.real_vs_predicted(df, "y", "pred").collect()}
    assert rvp == {"DESOCUPADO": (16015, 12030), "OCUPADO": (17814, 21799)}


def test_cluster_profile_golden_labels(spark):
    # Published cluster means (rounded) against the published global means.
    feats = cb.CLUSTER_FEATURES
    glob = [43.69, 7.23, 9.25, 6.35, 1.99, 1.99, 1.10, 1.99]
    c0 = [50.23, 4.93, 9.24, 6.68, 1.26, 1.34, 1.41, 1.79]
    c1 = [42.11, 9.90, 9.96, 6.75, 2.00, 2.00, 1.05, 1.99]
    # Build rows whose cluster means are c0 / c1 and whose overall mean is glob:
    # one row per cluster plus a balancing row, so cluster means are exact.
    bal = [3 * g - a - b for g, a, b in zip(glob, c0, c1)]
    schema = "k int, " + ", ".join(f"{f} double" for f in feats)
    df = spark.createDataFrame([(0, *c0), (1, *c1), (2, *bal)], schema)
    _, prof = M.cluster_profile(df, "k", feats)
    text = {r.cluster: r.perfil for r in prof.collect()}
    assert text[0].startswith("edad ALTO (+15.0%), nivel_educativo_cod BAJO (-31.8%), Concentracion BAJO (")
    assert "Socializar BAJO" in text[0] and "Experiencia ALTO (+28.2%)" in text[0]
    assert text[1] == "nivel_educativo_cod ALTO (+36.9%)"


def test_profile_average_text(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0)], "k int, x double")
    _, prof = M.cluster_profile(df, "k", ["x"])
    assert {r.perfil for r in prof.collect()} == {cb.PROFILE_AVERAGE_TEXT}


def test_metrics_match_spark_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import StringIndexer

    # imperfect predictions over three classes
    rows = [("a", "a")] * 50 + [("a", "b")] * 10 + [("b", "b")] * 30 + [("b", "c")] * 5 + [("c", "c")] * 20 + [("c", "a")] * 8
    df = spark.createDataFrame(rows, "y string, pred string")
    idx = StringIndexer(inputCol="y", outputCol="label").fit(df)
    # index predictions in the label indexer's space
    mapping = {lab: float(i) for i, lab in enumerate(idx.labels)}
    both = idx.transform(df).withColumn(
        "prediction", F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col("pred")])
    ours = MT.weighted_metrics(df, "y", "pred").collect()[0]
    for metric, value in (("accuracy", ours.accuracy), ("weightedPrecision", ours.precision_weighted),
                          ("weightedRecall", ours.recall_weighted), ("f1", ours.f1_weighted)):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert abs(ev.evaluate(both) - value) < 1e-9, metric


def test_profile_lines_golden(spark):
    from surveyspark.plans import jobs as J
    feats = cb.CLUSTER_FEATURES
    glob = [43.69, 7.23, 9.25, 6.35, 1.99, 1.99, 1.10, 1.99]
    c0 = [50.23, 4.93, 9.24, 6.68, 1.26, 1.34, 1.41, 1.79]
    c1 = [42.11, 9.90, 9.96, 6.75, 2.00, 2.00, 1.05, 1.99]
    bal = [3 * g - a - b for g, a, b in zip(glob, c0, c1)]
    df = spark.createDataFrame([(0, *c0), (1, *c1), (2, *bal)], "k int, " + ", ".join(f"{f} double" for f in feats))
    details, profiles = M.cluster_profile(df, "k", feats)
    lines = J.profile_lines(details, profiles)
    got = [r.linea for r in lines.filter("cluster = 1").orderBy("line_no").collect()]
    assert got == ["Cluster 1:", "  Perfil: nivel_educativo_cod ALTO (+36.9%)", "  Detalles:",
                   "    - edad: 42.11 (Global: 43.69)", "    - nivel_educativo_cod: 9.90 (Global: 7.23)",
                   "    - Lengua: 9.96 (Global: 9.25)", "    - Etnia: 6.75 (Global: 6.35)",
                   "    - Concentracion: 2.00 (Global: 1.99)", "    - Socializar: 2.00 (Global: 1.99)",
                   "    - Experiencia: 1.05 (Global: 1.10)", "    - Movilidad: 1.99 (Global: 1.99)"]
    title = [r.linea for r in lines.filter("cluster IS NULL").orderBy("line_no").collect()]
    assert title[0] == "INTERPRETACIÓN DE CLUSTERS (K-Means)" and len(title) == 3
