"""Sources and sinks: CSV round trips, single-file opt-in, path resolution, text reports."""

from pyspark.sql import functions as F

from surveyspark.plans import jobs as J
from surveyspark.session import scratch_path
from surveyspark.sources import files as S
from surveyspark.sources import models as SM


def test_write_csv_single_file_and_read_back(spark):
    df = spark.range(50).select(F.col("id").cast("int").alias("a"), F.lit("x,\"y\"").alias("s"))
    path = scratch_path(spark, "single") + "/out.csv"
    S.write_csv(df.repartition(4), path, single_file=True)
    assert S.path_exists(spark, path) and not S.path_exists(spark, path + "._tmp_single")
    back = S.read_csv(spark, path, quote='"', escape='"')
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_resolve_source_glob_and_default(spark):
    root = scratch_path(spark, "res")
    S.write_csv(spark.range(3), f"{root}/data_2024")
    assert S.resolve_source(spark, [f"{root}/nope", f"{root}/data_*"]).endswith("data_2024")
    assert S.resolve_source(spark, [f"{root}/a", f"{root}/b"]) == f"{root}/a"
    assert S.resolve_source(spark, [f"{root}/a"], default=f"{root}/z") == f"{root}/z"


def test_load_model_missing_raises(spark):
    import pytest
    with pytest.raises(FileNotFoundError):
        SM.load_model(spark, scratch_path(spark, "no_model"))


def test_text_report_lines(spark):
    m = spark.createDataFrame([(0.68585, 0.69289, 0.68585, 0.67937)],
                              "accuracy double, precision_weighted double, recall_weighted double, f1_weighted double")
    lines = [r.linea for r in J.metrics_lines(m).orderBy("line_no").collect()]
    assert lines == ["Accuracy: 0.6859", "Precision (weighted): 0.6929", "Recall (weighted): 0.6859",
                     "F1 (weighted): 0.6794"]
    nr = spark.createDataFrame([("Lengua", 28.7412), ("edad", 0.7093)], "columna string, porcentaje_nulos double")
    out = [r.linea for r in J.null_rate_lines(nr, ["edad", "Lengua"]).orderBy("line_no").collect()]
    assert out == ["PORCENTAJE DE NULOS POR VARIABLE SELECCIONADA", "=" * 45, "edad: 0.71%", "Lengua: 28.74%"]
    path = scratch_path(spark, "lines")
    S.write_report(J.metrics_lines(m).select("linea"), path, "text")
    assert spark.read.text(path).count() == 4


def test_save_reports_writes_every_table(spark):
    reports = {"a": spark.range(3), "b": spark.range(5).selectExpr("id * 2 AS x")}
    root = scratch_path(spark, "reports")
    paths = J.save_reports(reports, root)
    assert {k: spark.read.parquet(v).count() for k, v in paths.items()} == {"a": 3, "b": 5}


def test_run_imputation_observes_filter_counts(spark):
    from conftest import SF_MID
    from surveyspark.plans import catalog as Q
    src, dst = scratch_path(spark, "filtered"), scratch_path(spark, "imputed")
    S.write_csv(Q.ext(spark, SF_MID), src)
    audit = {}
    J.run_imputation(spark, src, dst, schema=Q.EXT_SCHEMA, audit=audit)
    assert audit == {"leidos": 15000, "conservados": 12958, "eliminados": 2042}
    assert spark.read.option("header", "true").csv(dst).count() == 12958


def test_answer_sink_is_idempotent_and_the_stream_goes_on(spark):
    """A replayed micro-batch gives the same two tables; a later call scores only what has arrived since."""
    from pyspark.sql import functions as F

    from surveyspark.operators import ml as M
    from surveyspark.session import scratch_path
    from surveyspark.streaming import answer_sink, read_answers, score_answers_stream

    data = spark.range(200).selectExpr("id AS row_id", "CAST(id % 60 AS INT) AS edad", "IF(id % 60 >= 40, 'OCUPADO', 'DESOCUPADO') AS condicion_ocupacion")
    pipe, _ = M.classifier_pipeline("condicion_ocupacion", ["edad"], [], 42, numTrees=3, maxDepth=3, maxBins=128)
    model = pipe.fit(data)
    answers = data.selectExpr("row_id", "CASE WHEN row_id % 9 = 0 THEN 'old' WHEN row_id % 10 = 3 THEN NULL ELSE CAST(edad AS STRING) END AS edad")
    out = scratch_path(spark, "sink")
    nothing = read_answers(spark, model, answers.schema, out)
    assert {k: v.count() for k, v in nothing.items()} == {"scored": 0, "rejected": 0}

    def tables():
        return {k: sorted(map(str, v.collect())) for k, v in read_answers(spark, model, answers.schema, out).items()}

    sink = answer_sink(model, out)
    sink(answers, 0)
    first = tables()
    sink(answers.repartition(5), 0)  # the same batch once more
    assert tables() == first and len(first["scored"]) + len(first["rejected"]) == 200
    sink(answers.limit(0), 1)
    assert tables() == first

    src, dst, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    answers.filter("row_id < 100").coalesce(1).write.parquet(src)
    one = score_answers_stream(spark, model, src, answers.schema, dst, ckpt)
    assert one["scored"].count() + one["rejected"].count() == 100
    answers.filter("row_id >= 100").repartition(2).write.mode("append").parquet(src)
    two = score_answers_stream(spark, model, src, answers.schema, dst, ckpt, files_per_batch=1)
    assert two["scored"].count() + two["rejected"].count() == 200 and two["scored"].select("lote").distinct().count() == 3
    good = two["scored"].join(data.select("row_id", "condicion_ocupacion"), "row_id")
    assert good.filter(F.col("prediccion") != F.col("condicion_ocupacion")).count() == 0
    bad = {r.row_id: r.errores for r in two["rejected"].collect()}
    assert bad == {i: ["edad"] for i in range(200) if i % 9 == 0 or i % 10 == 3}


def test_analysis_reports_come_from_one_scan(spark):
    """V8: V1, V2, V3 and A8 equal the single reports, and none of their plans reads the source again."""
    from conftest import SF_MID

    from surveyspark.plans import catalog as Q

    e = Q.ext(spark, SF_MID)
    one = J.profile_reports(e)
    each = {f"nulos_{k}": v for k, v in J.null_report(e).items()}
    each.update({f"corr_{k}": v for k, v in J.correlation_report(e).items()})
    each["ocupacion_por_edad"] = J.occupation_by_age(e)

    def text(df):
        return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())

    assert set(one) == {*each, "nulos_rasgos"}
    for name, want in each.items():
        assert one[name].columns == want.columns and text(one[name]) == text(want), name
    for name, df in one.items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" not in plan and "Relation" not in plan, name
    empty = J.profile_reports(e.limit(0))
    assert empty["corr_matriz"].filter("r IS NOT NULL").count() == 0 and empty["ocupacion_por_edad"].count() == 0


def test_single_csv_file_is_read_in_splits(spark, tmp_path):
    """Many tasks read one file; records with line breaks, quotes and blank lines that cross splits come back whole."""
    texts = ['"', 'a "b"\n\n,c', "\n\n\n" + "x" * 300 + '\n"\n', "plain", "", None, "é,\r\n" * 40, '""\n""', " s "]
    rows = [(i, texts[i % len(texts)], f"l{i % 3}" if i % 4 else None) for i in range(300)]
    schema = "doc_id long, text string, lang string"
    path = f"{tmp_path}/one.csv"
    S.write_csv(spark.createDataFrame(rows, schema).repartitionByRange(5, "doc_id"), path, single_file=True)
    whole = spark.read.options(header="true", multiLine="true", escape='"', lineSep="\n").schema(schema).csv(path)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("97", "1000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            if size == "97":
                assert spark.read.text(path).rdd.getNumPartitions() > 100
            got = S.read_csv_file(spark, path, schema)
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str) and got.count() == 300
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    one = f"{tmp_path}/head.csv"
    S.write_csv(spark.createDataFrame([], schema), one, single_file=True)
    assert S.read_csv_file(spark, one, schema).collect() == []
