"""Edge cases and invariants of the DataFrame operators (small in-memory tables)."""

import math

import pytest

from pyspark.sql import functions as F

from surveyspark.functions import codebooks as cb
from surveyspark.operators import aggregates as A
from surveyspark.operators import columns as P
from surveyspark.operators import impute as I
from surveyspark.operators import metrics as MT
from surveyspark.operators import ml as M
from surveyspark.operators import recode as C
from surveyspark.operators import reshape as R
from surveyspark.operators import sampling as K


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


# ---------------------------------------------------------------- projections / filters

def test_align_and_union_cast_conflicts(spark):
    a = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    b = spark.createDataFrame([("7", 8)], "x string, y int")
    assert P.common_columns(a, b) == ["x", "y"]
    u = R.union_common(a, b)
    assert dict(u.dtypes) == {"x": "string", "y": "int"}
    assert rows(u) == [("1", 2), ("7", 8)]


def test_select_available_reports_missing_and_resolves_case(spark):
    df = spark.createDataFrame([(1, 2)], "Lengua int, edad int")
    out, missing = P.select_available(df, ["edad", "lengua", "nope"], case_insensitive=True)
    assert out.columns == ["edad", "Lengua"] and missing == ["nope"]
    out2, missing2 = P.select_available(df, ["edad", "lengua"])
    assert out2.columns == ["edad"] and missing2 == ["lengua"]


def test_drop_incomplete_three_valued(spark):
    df = spark.createDataFrame(
        [(1, 5, None), (2, 5, 1), (3, None, 1), (4, 30, None), (5, -1, None)], "id int, edad int, v int")
    kept = P.drop_incomplete_in_range(df, "edad", 0, 12, columns=["edad", "v"])
    # 1: child with NULL -> drop; 2: complete child -> keep; 3: NULL age -> NULL condition -> drop;
    # 4: adult with NULL -> keep; 5: negative age outside range -> keep
    assert [r.id for r in kept.orderBy("id").collect()] == [2, 4, 5]


def test_split_by_type_numeric_types(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(1, 2, Decimal("1.50"), "a", 3)], "a tinyint, b bigint, c decimal(10,2), d string, y int")
    num, cat = P.split_by_type(df, target="y")
    assert num == ["a", "b", "c"] and cat == ["d"]


# ---------------------------------------------------------------- recodes

def test_recode_keep_and_default(spark):
    df = spark.createDataFrame([(1,), (0,), (3,), (7,), (None,)], "c int")
    kept = C.recode(df, "c", cb.EMPLOYMENT_CODES)
    assert [r.c for r in kept.collect()] == ["OCUPADO", "DESOCUPADO", "DESOCUPADO", "7", None]
    binary = C.recode(df, "c", {cb.EMPLOYED_TITLE: [1]}, default=cb.NOT_EMPLOYED_TITLE)
    assert [r.c for r in binary.collect()] == ["Ocupado", "Desocupado", "Desocupado", "Desocupado", "Desocupado"]


def test_age_bands_edges(spark):
    df = spark.createDataFrame([(-3.0,), (4.9,), (12.0,), (17.5,), (65.0,), (120.0,), (None,)], "edad double")
    c3 = C.band(df, "edad", cb.AGE_CLUSTER_EDGES, cb.AGE_CLUSTER_LABELS, cb.AGE_CLUSTER_NULL, "b")
    assert [r.b for r in c3.collect()] == ["0-4 años", "0-4 años", "5-12 años", "13-17 años", "65+ años", "65+ años", "Sin Edad"]
    c4 = C.band_closed(df, "edad", cb.AGE_RANGES, "b")
    assert [r.b for r in c4.collect()] == [None, None, None, None, "65+", "65+", None]
    c5 = C.cut(df, "edad", cb.AGE_BIN_EDGES, cb.AGE_BIN_LABELS, "b")
    assert [r.b for r in c5.collect()] == [None, "0-4", "5-12", "13-17", "65+", None, None]


def test_encode_answers_reports_unknown(spark):
    df = spark.createDataFrame([("Mujer", "Si", " 42 "), ("Otro", None, "x")], "sexo string, Movilidad string, edad string")
    out = C.encode_answers(df, {"sexo": cb.SEXO, "Movilidad": cb.SI_NO}, int_fields=["edad"])
    got = [(r.sexo, r.Movilidad, r.edad, list(r.errores)) for r in out.collect()]
    assert got == [(2, 1, 42, []), (None, None, None, ["sexo", "edad"])]


def test_code_books_complete():
    assert len(cb.NIVEL_EDUCATIVO) == 12 and sorted(cb.NIVEL_EDUCATIVO.values()) == list(range(1, 13))
    assert len(cb.LENGUA) == 14 and sorted(cb.LENGUA.values()) == list(range(1, 15))
    assert len(cb.ETNIA) == 9 and sorted(cb.ETNIA.values()) == list(range(1, 10))
    assert cb.SEXO == {"Hombre": 1, "Mujer": 2} and cb.SI_NO == {"Si": 1, "No": 2}


def test_reports_on_empty_table(spark):
    df = spark.createDataFrame([], "edad int, v double, g string")
    assert [(r.columna, r.porcentaje_nulos) for r in A.null_rates(df, ["edad", "v"]).collect()] == [("edad", 0.0), ("v", 0.0)]
    assert A.null_rates_by(df, "g", ["v"]).count() == 0
    assert A.row_count(df).collect()[0].n == 0
    assert A.value_counts(df, "g", normalize=True).count() == 0


def test_is_missing_nan_vs_null(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), None), (None, 2)], "d double, i int")
    out = A.null_rates(df, ["d", "i"])
    got = {r.columna: r.porcentaje_nulos for r in out.collect()}
    assert math.isclose(got["d"], 200 / 3) and math.isclose(got["i"], 100 / 3)


# ---------------------------------------------------------------- modes / medians

def test_mode_ties_smallest_and_all_null(spark):
    df = spark.createDataFrame([(2, "b", None), (1, "a", None), (2, "a", None), (1, "b", None)], "x int, s string, z int")
    m = A.mode(df, ["x", "s", "z"]).collect()[0]
    assert (m.x, m.s, m.z) == (1, "a", None)


def test_mode_on_empty_table(spark):
    df = spark.createDataFrame([], "x int, s string")
    m = A.mode(df, ["x", "s"]).collect()
    assert len(m) == 1 and m[0].x is None and m[0].s is None


def test_group_mode_null_key_excluded(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 9), ("b", None)], "g string, v int")
    out = {r.g: r.v for r in A.group_mode(df, "g", ["v"]).collect()}
    assert out == {"a": 1, "b": None}  # a group without a known value keeps its row


def test_median_is_lower_middle(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "x int")
    assert A.median(df, "x").collect()[0].mediana == 2.0


def test_exact_quantile_matches_disc_on_skew(spark):
    # one group holds a third of the rows with heavy duplicates; tiny groups; NULL values
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        F.when(F.col("id") % 7 == 0, F.lit(5.0)).when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise((F.col("id") * 7919 % 10007) / 100.0).alias("v"))
    extra = spark.createDataFrame([(900, 1.0), (901, 2.0), (901, 1.0), (902, None)], "g long, v double")
    df = df.unionByName(extra)
    exact = {r.g: r.mediana for r in A.quantile_exact(df, ["g"], "v", small=1000).collect()}
    disc = {r.g: r.mediana for r in df.filter("v IS NOT NULL").groupBy("g").agg(
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("mediana")).collect()}
    assert exact == disc and exact[901] == 1.0 and 902 not in exact
    assert A.median(df, "v").collect() == df.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("mediana")).collect()
    for q in (0.1, 0.9):
        ex = {r.g: r.m for r in A.quantile_exact(df, ["g"], "v", q=q, alias="m", small=1000).collect()}
        ref = {r.g: r.m for r in df.filter("v IS NOT NULL").groupBy("g").agg(
            F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY v)").alias("m")).collect()}
        assert ex == ref


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 3.0), (3.0, 5.0, None)], "a double, c double, b double")
    out = {(r.var_a, r.var_b): r.r for r in A.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert out[("a", "c")] is None and out[("c", "c")] is None
    assert math.isclose(out[("a", "b")], 1.0) and out[("a", "b")] == out[("b", "a")]


# ---------------------------------------------------------------- imputation invariants

def _survey_like(spark):
    data = [(i, ["13-17", "18-24", None][i % 3], (i % 4) if i % 5 else None, ("x" if i % 2 else "y") if i % 7 else None)
            for i in range(60)]
    return spark.createDataFrame(data, "id int, g string, a int, s string")


def test_impute_group_mode_keeps_known_cells_and_fills_all(spark):
    df = _survey_like(spark)
    out = I.impute_by_group_mode(df, "g", exclude=["id"])
    before = {r.id: r for r in df.collect()}
    after = {r.id: r for r in out.collect()}
    assert len(after) == len(before)
    for k, r in before.items():
        for c in ("a", "s"):
            if r[c] is not None:
                assert after[k][c] == r[c]
            else:
                assert after[k][c] is not None
    # NULL-group rows get the global mode
    glob = A.mode(df, ["a", "s"]).collect()[0]
    for k, r in before.items():
        if r.g is None and r.a is None:
            assert after[k].a == glob.a


def test_impute_group_mode_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None)], "id int, g string, z int")
    out = I.impute_by_group_mode(df, "g", exclude=["id"])
    assert [r.z for r in out.collect()] == [None, None]


def test_impute_income_three_valued(spark):
    cols = "id int, sexo int, estrato int, edad int, condicion_ocupacion int, ingreso_total double"
    df = spark.createDataFrame([
        (1, 1, 1, 30, 1, 100.0), (2, 1, 1, 40, 1, 300.0), (3, 1, 1, 50, 1, None),   # filled with 100 (lower median)
        (4, 1, 1, 10, 1, 50.0),                                                   # under 13 -> NULL
        (5, 1, 1, 30, 2, 70.0),                                                   # not employed -> NULL
        (6, 1, 1, None, 1, 80.0),                                                 # NULL age, employed: kept
        (7, 1, 1, None, 2, 90.0),                                                 # NULL age, not employed: NULL
        (8, None, 1, 30, 1, None),                                                # NULL group: stays NULL
        (9, 2, 3, 30, 1, None),                                                   # group without median: NULL
    ], cols)
    out = {r.id: r.ingreso_total for r in I.impute_income(df).collect()}
    assert out == {1: 100.0, 2: 300.0, 3: 100.0, 4: None, 5: None, 6: 80.0, 7: None, 8: None, 9: None}


def test_impute_median_makes_double(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (5,)], "e int")
    out = I.impute_median(df, "e")
    assert dict(out.dtypes)["e"] == "double" and [r.e for r in out.collect()] == [1.0, 3.0, 3.0, 5.0]


# ---------------------------------------------------------------- sampling invariants

def test_split_disjoint_cover_and_partition_independent(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = K.split(df, "k", [0.8, 0.2], 42, part_col="p")
    b = K.split(df.repartition(7), "k", [0.8, 0.2], 42, part_col="p")
    assert rows(a) == rows(b)
    parts = K.split(df, "k", [0.8, 0.2], 42)
    n0, n1 = parts[0].count(), parts[1].count()
    assert n0 + n1 == 2000 and parts[0].join(parts[1], "k").count() == 0
    assert 1500 < n0 < 1700


def test_hash_rank_matches_window(spark):
    from pyspark.sql import Window
    from surveyspark.functions.expressions import key_hash
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    ranked = K.hash_rank(df, "k", 7, ["c"], rank_col="r")
    w = Window.partitionBy("c").orderBy(key_hash("k", 7), "k")
    expect = df.withColumn("r", F.row_number().over(w).cast("bigint"))
    assert rows(ranked, "k", "c", "r") == rows(expect, "k", "c", "r")


def test_stratified_split_sizes(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") < 300, "a").otherwise("b").alias("y"))
    out = K.stratified_split(df, "k", "y", 0.8, 42, part_col="p")
    got = {(r.y, r.p): r.n for r in out.groupBy("y", "p").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 0): 240, ("a", 1): 60, ("b", 0): 560, ("b", 1): 140}


def test_folds_balanced(spark):
    out = K.assign_folds(spark.range(1003).withColumnRenamed("id", "k"), "k", 5, 42)
    counts = sorted(r[1] for r in out.groupBy("fold").count().collect())
    assert counts == [200, 200, 201, 201, 201]


def test_sample_cap_whole_table_when_small(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert K.sample_cap(df, "k", 1000).count() == 100
    assert 400 < K.sample_cap(spark.range(5000).withColumnRenamed("id", "k"), "k", 1000).count() < 1600


# ---------------------------------------------------------------- metrics

def test_confusion_cells_sum_and_zero_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    cm = MT.confusion_matrix(df, "y", "p")
    cells = {(r.y, r.pred): r.n for r in cm.collect()}
    assert len(cells) == 9 and sum(cells.values()) == 4 and cells[("c", "c")] == 0


def test_audit_counts(spark):
    a = spark.range(10)
    out = A.audit_counts({"a": a, "b": a.filter("id < 7")})
    assert [(r.paso, r.filas, r.eliminadas) for r in out.collect()] == [("a", 10, 0), ("b", 7, 3)]


def test_audit_steps_matches_audit_counts(spark):
    a = spark.range(20).withColumn("v", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")))
    one = A.audit_steps(a, {"a": None, "b": F.col("id") < 15, "c": F.col("v").isNotNull()})
    many = A.audit_counts({"a": a, "b": a.filter("id < 15"), "c": a.filter("id < 15 AND v IS NOT NULL")})
    assert rows(one) == rows(many)


def test_top_k_two_stage_equals_single_window(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1000).alias("v"), "id")
    order = [F.col("v").desc(), F.col("id")]
    one = R.top_k_per_group(df, "g", order, 5)
    two = R.top_k_per_group(df, "g", order, 5, buckets=16)
    assert rows(one) == rows(two) and one.count() == 15


def test_top_missing_hides_zero(spark):
    t = spark.createDataFrame([("x", "g", 10, 0, 0.0), ("y", "g", 10, 5, 50.0), ("z", "g", 10, 1, 10.0)],
                              "columna string, cluster_edad string, total_registros bigint, nulos bigint, porcentaje_nulos double")
    out = R.top_missing(t, k=10)
    assert [r.columna for r in out.orderBy("rank").collect()] == ["y", "z"]


def test_key_normal_is_standard_normal_and_partition_free(spark):
    from surveyspark.functions.expressions import key_normal
    df = spark.range(200000).select(key_normal("id", 42).alias("z"))
    m = df.agg(F.avg("z").alias("m"), F.stddev("z").alias("s")).collect()[0]
    assert abs(m.m) < 0.01 and abs(m.s - 1) < 0.01
    a = rows(spark.range(1000).select("id", key_normal("id", 3).alias("z")))
    b = rows(spark.range(1000).repartition(7).select("id", key_normal("id", 3).alias("z")))
    assert a == b


def test_pct_deviation_zero_reference(spark):
    from surveyspark.functions.expressions import pct_deviation
    df = spark.createDataFrame([(5.0, 0.0), (11.0, 10.0), (-9.0, -10.0)], "a double, b double")
    got = [r[0] for r in df.select(pct_deviation("a", "b")).collect()]
    assert got[0] == 0.0 and math.isclose(got[1], 10.0) and math.isclose(got[2], 10.0)


def test_heaped_median_stops_at_the_value(spark, monkeypatch):
    """Half of a group at one value: the bracket closes on it, without further rounds."""
    rows = spark.range(60000).select(F.lit("a").alias("g"), F.when(F.col("id") % 2 == 0, F.lit(1000.0)).otherwise(F.col("id") / 7.0).alias("v"))
    made = []
    monkeypatch.setattr(A, "reliable_checkpoint", lambda d, keep=A.reliable_checkpoint: made.append(1) or keep(d))
    got = A.group_median(rows, ["g"], "v").collect()
    want = rows.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("m")).first().m
    assert [r.mediana for r in got] == [want] and len(made) <= 3


def test_metrics_over_5000_classes(spark):
    """No list of classes on the driver, no cap: weighted metrics over 5,000 classes."""
    from surveyspark.operators import metrics as MT
    df = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("y"),
                                   F.when(F.col("id") < 15000, F.col("id") % 5000).otherwise((F.col("id") + 1) % 5000).cast("string").alias("p"))
    r = MT.weighted_metrics(df, "y", "p").first()
    assert r.accuracy == r.recall_weighted == 0.75 and abs(r.precision_weighted - 0.75) < 1e-9


def test_lookup_does_not_shuffle_the_table(spark):
    """With a tiny broadcast threshold the filled table is still not shuffled by its groups."""
    from surveyspark.operators import impute as IM
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        df = spark.range(5000).selectExpr("id AS row_id", "CASE WHEN id % 5 = 0 THEN NULL ELSE id * 1.0D END AS ingreso_total", "int(1 + id % 2) AS sexo",
                                          "int(1 + id % 5) AS estrato", "int(20 + id % 40) AS edad", "1 AS condicion_ocupacion")
        out = IM.impute_income(df)
        assert "BroadcastHashJoin" in (plan := out._jdf.queryExecution().executedPlan().toString()) and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_broadcast_check_is_in_bytes(spark):
    from surveyspark.session import broadcast_if_small, table_bytes
    few = spark.createDataFrame([("x" * 5000,)] * 10, "t string")
    assert table_bytes(few) > 50_000
    assert "Broadcast" not in broadcast_if_small(few, 10_000)._jdf.queryExecution().logical().toString()


def test_population_scaling_and_invalid_numbers(spark):
    """The scaled column has population std 1; NULL raises by default."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    out = Pipeline(stages=M.feature_stages(["x"], [], scale_numeric=True)).fit(df).transform(df)
    assert abs(out.select(F.stddev_pop(vector_to_array("features")[0]).alias("s")).first().s - 1) < 1e-12
    with pytest.raises(Exception):
        bad = df.union(spark.createDataFrame([(None,)], "x double"))
        Pipeline(stages=M.feature_stages(["x"], [])).fit(bad).transform(bad).collect()


def test_split_and_ranks_with_null_keys(spark):
    """K2-K5: NULL keys and classes count; a part of weight 0 is empty; the answer does not depend on partitioning."""
    df = spark.createDataFrame([(None if i % 4 == 0 else i, i, None if i % 3 == 0 else "c") for i in range(600)], "k int, id int, y string")
    assert [p.count() for p in K.split(df, "k", [1.0, 0.0], tie=["id"])] == [600, 0]
    assert K.split(df, "k", [0.8, 0.2, 0.0], tie=["id"])[2].count() == 0
    assert K.sample_n(df, "k", 100, tie=["id"]).count() == 100 and K.sample_n(df.limit(6), "k", 100).count() == 6
    a = sorted(K.stratified_split(df, "k", "y", part_col="p", tie=["id"]).select("id", "p").collect())
    assert a == sorted(K.stratified_split(df.repartition(7), "k", "y", part_col="p", tie=["id"]).select("id", "p").collect())
    assert sum(r.p == 0 for r in a) == 480
    folds = K.assign_folds(df, "k", 5, label="y", tie=["id"]).groupBy("y", "fold").count().collect()
    assert all(r.fold is not None for r in folds) and {r["count"] for r in folds} == {40, 80}


# ---------------------------------------------------------------- exact selection, cuts, blocked moments

def test_quantiles_keep_every_digit(spark):
    """BIGINT beyond 2^53, decimals, dates and timestamps, negative and extreme values, against percentile_disc."""
    big = 2 ** 53
    rows = [(i % 3, big + 1 + (i * 7919) % 101, -(2 ** 62) + i if i % 2 else 2 ** 62 - i, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, a long, b long, i int").selectExpr(
        "g", "a", "b", "CAST(a AS DECIMAL(38,10)) / 3 AS c", "date_add(DATE'1960-01-01', i * 37 % 20000) AS d",
        "timestamp_micros(a - 4000000000000000 + i) AS e", "CASE WHEN i % 5 = 0 THEN double('NaN') WHEN i % 7 = 0 THEN -double('inf') ELSE i - 200.5D END AS f")
    data = df.collect()
    for c in "abcdef":
        for q in (0.5, 0.1, 1.0):
            want = {}
            for g in range(3):
                values = sorted((r[c] for r in data if r.g == g), key=lambda v: (v != v, v))
                want[g] = values[max(1, math.ceil(q * len(values))) - 1]
            for small in (3, 100_000):
                got = {r.g: r.m for r in A.quantile_exact(df, ["g"], c, q=q, alias="m", small=small).collect()}
                assert str(sorted(got.items())) == str(sorted(want.items())), (c, q, small)
    assert A.median(spark.createDataFrame([(big + 1,)], "x long"), "x").first().mediana == big + 1
    assert A.median(spark.createDataFrame([(None,)], "x long"), "x").first().mediana is None


def test_few_values_need_one_pass(spark, monkeypatch):
    """A column of few values is answered from the first counts: one checkpoint, no second look at the data."""
    from surveyspark.operators import selection as S
    made = []
    monkeypatch.setattr(S, "reliable_checkpoint", lambda d, keep=S.reliable_checkpoint: made.append(1) or keep(d))
    df = spark.range(1000).selectExpr("CAST(id % 5 AS INT) AS x")
    table, _ = S.quantile_table(df, [], "x")
    assert [r[0] for r in table.collect()] == [2.0] and made == [1]
    assert "Range (0, 1000" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_sample_n_filters_before_it_shuffles(spark):
    """K2: unique hashes need no exchange at all; copies of a key are ranked among themselves only."""
    df = spark.range(20000).selectExpr("id AS k", "id % 10 AS x")
    out = K.sample_n(df, "k", 500, 7)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 500 and "Join" not in plan and "Window" not in plan and "Aggregate" not in plan and "Filter" in plan
    one = spark.range(3000).selectExpr("7L AS k", "id")
    a = sorted(r.id for r in K.sample_n(one, "k", 250, tie=["id"]).collect())
    assert a == list(range(250)) == sorted(r.id for r in K.sample_n(one.repartition(7), "k", 250, tie=["id"]).collect())
    nulls = spark.range(3000).selectExpr("CAST(NULL AS BIGINT) AS k", "id")
    b = sorted(r.id for r in K.sample_n(nulls, "k", 250, tie=["id"]).collect())
    assert len(b) == 250 and b != a and b == sorted(r.id for r in K.sample_n(nulls.repartition(5), "k", 250, tie=["id"]).collect())
    assert K.sample_n(df, "k", 0).count() == 0 and K.sample_n(df, "k", 20000).count() == 20000 and K.sample_n(df.limit(0), "k", 5).count() == 0


def test_sample_cap_splits_heavy_and_null_keys(spark):
    """K1: the size stays within 3 sigma for one key, for NULL keys and for a mix; light keys stay together."""
    base = spark.range(4000).selectExpr("id", "id % 7 AS x")
    for expr in ("5L", "CAST(NULL AS BIGINT)", "CASE WHEN id % 3 = 0 THEN 1L WHEN id % 3 = 1 THEN NULL ELSE id END"):
        df = base.selectExpr("id", "x", f"{expr} AS k")
        for seed in (1, 2, 3):
            got = K.sample_cap(df, "k", 400, seed)
            n = got.count()
            assert abs(n - 400) <= 3 * math.sqrt(400 * 0.9) and got.columns == df.columns
            assert sorted(r.id for r in got.collect()) == sorted(r.id for r in K.sample_cap(df.repartition(5), "k", 400, seed).collect())
    pairs = base.selectExpr("id", "id DIV 2 AS k")
    taken = K.sample_cap(pairs, "k", 400, 1).groupBy("k").count()
    assert taken.filter("count <> 2").count() == 0


def test_correlations_of_200_columns_do_not_multiply_rows(spark):
    """20,100 pairs in one pass; the plan generates no rows from rows."""
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 200)) + rng.integers(-5, 5, size=200) * 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    cols = [f"v{i}" for i in range(200)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(3)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    out = A.pair_correlations(df, pairs)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["_p"]: r["_r"] for r in out.collect()}
    assert len(got) == 20100
    for p in range(0, 20100, 401):
        i, j = (cols.index(c) for c in pairs[p])
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert math.isclose(got[p], np.corrcoef(x[both, i], x[both, j])[0, 1], abs_tol=1e-9)


def test_correlation_of_a_column_constant_where_the_other_is_known(spark):
    """Zero variance among the shared rows is NULL, however the values around it lie."""
    rows = [(0.1, 1.0 + i * 0.3, None) for i in range(7)] + [(float(i) * 1e5, None, 3.0) for i in range(50)] + [(0.1, 5.5, 0.7)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {(r.var_a, r.var_b): r.r for r in A.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] is None and got[("b", "c")] is None and got[("b", "b")] == pytest.approx(1.0)
    assert got[("a", "c")] is not None


def test_grid_search_fits_feature_stages_once_for_each_fold(spark, monkeypatch):
    """The stages before the forest do not depend on the grid: fitted once a fold, the models are those of separate fits."""
    from pyspark.ml import Pipeline

    fits, fit = [], M.PopulationScaler._fit
    monkeypatch.setattr(M.PopulationScaler, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    data = [(i % 2, float(i % 17), None if i % 13 == 0 else "abc"[i % 3], "xy"[i // 5 % 2], "no" if (i * 7) % 17 < 6 else "yes") for i in range(240)]
    df = spark.createDataFrame(data, "fold int, x double, c string, d string, y string").repartition(2, "x").cache()
    pipe, rf = M.classifier_pipeline("y", ["x"], ["c", "d"], scale_numeric=True, numTrees=2, maxDepth=2)
    model = M.grid_search(pipe, rf, [2, 3], [1, 3], "fold", 2).fit(df)
    assert len(fits) == 2 + 1 and len(model.avgMetrics) == 4
    points = model.getEstimatorParamMaps()
    trees = lambda m: m.stages[-1].toDebugString.split("\n", 1)[1]
    found = dict(pipe.fitMultiple(df, points))
    assert [trees(found[i]) for i in range(4)] == [trees(Pipeline(stages=pipe.getStages()).fit(df, p)) for p in points]
    assert [list(x) for x in found[0].stages[3].labelsArray] == [list(M.string_indexer(c).fit(df).labels) for c in ("c", "d")]
    by_stage = [{pipe.getStages()[0].handleInvalid: "skip"}]  # a setting of an earlier stage: fitted apart
    assert len(dict(pipe.fitMultiple(df, by_stage))) == 1
