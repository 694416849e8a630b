"""Registry of named queries: each callable takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver's parquet tables (or data Spark derives from them): the survey view
of ``orders``, ``documents`` LEFT JOIN ``labels`` and ``lineitem``. Every query runs over
whole tables. Doubles are rounded to 6 decimals so results compare across engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from surveyspark.functions import codebooks as cb
from surveyspark.functions.expressions import key_hash, round6
from surveyspark.operators import aggregates as A
from surveyspark.operators import columns as P
from surveyspark.operators import impute as I
from surveyspark.operators import metrics as MT
from surveyspark.operators import ml as M
from surveyspark.operators import recode as C
from surveyspark.operators import reshape as R
from surveyspark.operators import sampling as K
from surveyspark.plans import jobs as J
from surveyspark.session import reliable_checkpoint, scratch_path
from surveyspark.sources import files as S
from surveyspark.sources import models as SM
from surveyspark.sources import testdata as T

# Names used by the phase-2 (income / stratum) imputations, applied to the survey view.
PHASE2_RENAME = {"ESTRATO": "estrato", "OCUP300": "condicion_ocupacion", "INGTOT": "ingreso_total",
                 "C207": "sexo", "C208": "edad", "C366": "nivel_educativo_cod", "C366_1": "anios_educacion"}
IMPUTE_COLS = ["condicion_ocupacion", "sexo", "nivel_educativo_cod", "Lengua", "Etnia", "Concentracion",
               "Socializar", "Movilidad", "Experiencia"]
PLANTED_AGE = 40
RF_PLANTED = {"maxBins": 128}


# ---------------------------------------------------------------- shared inputs

def ext(spark, d) -> DataFrame:
    """Filtered extract: row_id + the ten business columns, employment recoded."""
    return J.extract(T.survey(spark, d), keep=["row_id"])[0]


def wide(spark, d) -> DataFrame:
    return P.select_rename(T.survey(spark, d), cb.WIDE_RENAME, keep=["row_id"])[0]


def phase2(spark, d) -> DataFrame:
    return P.select_rename(T.survey(spark, d), PHASE2_RENAME, keep=["row_id"])[0]


def ranged(spark, d) -> DataFrame:
    return C.band_closed(ext(spark, d), "edad", cb.AGE_RANGES, "age_range")


def clean_features(spark, d) -> DataFrame:
    return P.drop_null(ext(spark, d), cb.CLUSTER_FEATURES)


def rule_scored(spark, d) -> DataFrame:
    """(y, pred) pairs: y is the recoded employment, pred a fixed age rule."""
    e = P.filter_not_null(ext(spark, d), "condicion_ocupacion")
    pred = F.when(F.col("edad") >= PLANTED_AGE, F.lit(cb.EMPLOYED)).otherwise(F.lit(cb.NOT_EMPLOYED))
    return e.select("row_id", F.col("condicion_ocupacion").alias("y"), pred.alias("pred"))


def planted(spark, d) -> DataFrame:
    """Labelled rows whose class is a noise-free age rule (known answer: accuracy 1.0)."""
    e = P.filter_not_null(ext(spark, d), "edad")
    y = F.when(F.col("edad") >= PLANTED_AGE, F.lit(cb.EMPLOYED)).otherwise(F.lit(cb.NOT_EMPLOYED))
    return e.withColumn("condicion_ocupacion", y)


def blobs(spark, d) -> DataFrame:
    """Three well-separated blobs: centre 100 * (row_id % 3) on each feature + (row_id % 7) / 10."""
    s = T.survey(spark, d).select("row_id")
    base = F.lit(100.0) * (F.col("row_id") % 3) + (F.col("row_id") % 7) / 10.0
    return s.select("row_id", base.alias("f1"), (base + 1.0).alias("f2"), (base * 2.0).alias("f3"))


def _r6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: round6(c) for c in cols})


def _doubles(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]


def _round_all(df: DataFrame) -> DataFrame:
    return _r6(df, _doubles(df))


# ---------------------------------------------------------------- S: sources and sinks

def q_csv_quoted(spark, d):
    path = scratch_path(spark, "extract_quoted")
    S.write_csv(ext(spark, d), path, quote_all=True)
    back = S.read_csv(spark, path, quote='"', escape='"')
    return back.withColumn("row_id", F.col("row_id").cast("bigint"))


def q_csv_unquoted(spark, d):
    path = scratch_path(spark, "extract_plain")
    S.write_csv(ext(spark, d), path)
    back = S.read_csv(spark, path, multiline=False)
    return back.withColumn("row_id", F.col("row_id").cast("bigint"))


EXT_SCHEMA = ("row_id bigint, condicion_ocupacion string, sexo int, edad int, nivel_educativo_cod int, "
              "Lengua int, Etnia int, Concentracion int, Socializar int, Movilidad int, Experiencia int")


def q_csv_schema(spark, d):
    path = scratch_path(spark, "extract_typed")
    S.write_csv(ext(spark, d), path)
    return S.read_csv(spark, path, schema=EXT_SCHEMA)


def q_resolve_source(spark, d):
    root = scratch_path(spark, "resolve")
    S.write_csv(ext(spark, d), f"{root}/extract_2024")
    src = S.resolve_source(spark, [f"{root}/missing.csv", f"{root}/extract_*"])
    return S.read_csv(spark, src, schema=EXT_SCHEMA)


def q_report_roundtrip(spark, d):
    path = scratch_path(spark, "null_report")
    S.write_report(A.null_rates(ext(spark, d), cb.CLUSTER_FEATURES), path, "parquet")
    return _round_all(S.read_report(spark, path, "parquet"))


def q_model_roundtrip(spark, d):
    data = planted(spark, d).select("row_id", "edad", "condicion_ocupacion")
    pipe, _ = M.classifier_pipeline("condicion_ocupacion", ["edad"], [], 42, numTrees=5, maxDepth=3, **RF_PLANTED)
    model = pipe.fit(data)
    path = scratch_path(spark, "model")
    SM.save_model(model, path)
    loaded = SM.load_model(spark, path)
    return M.score(loaded, data).select("row_id", F.col("condicion_ocupacion").alias("y"), "prediccion")


# ---------------------------------------------------------------- P: projections and filters

def q_extract(spark, d):
    return ext(spark, d)


def q_align_union(spark, d):
    s = T.survey(spark, d)
    e0 = s.filter(F.col("src") == 0).drop("REGION")
    e1 = s.filter(F.col("src") == 1).drop("MES")
    e2 = (s.filter(F.col("src") == 2).withColumn("ESTRATO", F.col("ESTRATO").cast("string"))
          .withColumn("EXTRA", F.lit(1)))
    return _round_all(R.union_common(*P.align(e0, e1, e2)))


def q_wide_select(spark, d):
    return _round_all(wide(spark, d))


def q_not_null_target(spark, d):
    return P.filter_not_null(ext(spark, d), "condicion_ocupacion").select("row_id", "condicion_ocupacion")


def q_eligible_earners(spark, d):
    w = wide(spark, d)
    cond = P.eligible(value_col="ingreso_total", occ_col="ocupado", occ_value=1)
    return _round_all(w.filter(cond).select("row_id", "sexo", "estrato", "ingreso_total"))


def q_drop_incomplete(spark, d):
    return P.drop_incomplete_in_range(ranged(spark, d), "edad", 0, 12).select("row_id", "edad", "age_range")


def q_drop_null_features(spark, d):
    return clean_features(spark, d).select("row_id", *cb.CLUSTER_FEATURES)


def q_known_classes(spark, d):
    return P.filter_in(ext(spark, d), "condicion_ocupacion", [cb.EMPLOYED, cb.NOT_EMPLOYED]).select(
        "row_id", "condicion_ocupacion")


def q_column_kinds(spark, d):
    e = ext(spark, d).drop("row_id")
    return P.column_kinds(spark, e, target="condicion_ocupacion")


def q_features_target(spark, d):
    out, _, _, _ = P.features_target(ext(spark, d), cb.MODEL_NUMERIC, cb.MODEL_CATEGORICAL, cb.TARGET)
    return out


# ---------------------------------------------------------------- C: scalar columns

def q_recode_binary(spark, d):
    s = T.survey(spark, d).select("row_id", F.col("OCUP300").alias("condicion_ocupacion"))
    return C.recode(s, "condicion_ocupacion", {cb.EMPLOYED_TITLE: [1]}, default=cb.NOT_EMPLOYED_TITLE)


def q_age_clusters(spark, d):
    e = ext(spark, d).select("row_id", "edad")
    return C.band(e, "edad", cb.AGE_CLUSTER_EDGES, cb.AGE_CLUSTER_LABELS, cb.AGE_CLUSTER_NULL, "cluster_edad")


def q_age_ranges(spark, d):
    return ranged(spark, d).select("row_id", "edad", "age_range")


def q_age_bins(spark, d):
    e = ext(spark, d).select("row_id", "edad")
    return C.cut(e, "edad", cb.AGE_BIN_EDGES, cb.AGE_BIN_LABELS, "rango_edad")


def q_label_numbers(spark, d):
    return J.occupation_numeric(ext(spark, d)).select("row_id", "condicion_ocupacion_num", "Experiencia")


def q_missing_rates_docs(spark, d):
    dl = T.documents_labels(spark, d)
    return _round_all(A.null_rates(dl, ["lang", "source", "n_chars", "quality", "toxic"]))


def q_encode_answers(spark, d):
    e = ext(spark, d)
    answers = C.decode_answers(e.withColumn("edad", F.col("edad").cast("string")), cb.ANSWER_DICTIONARIES)
    coded = C.encode_answers(answers, cb.ANSWER_DICTIONARIES, int_fields=["edad"])
    return coded.withColumn("n_errores", F.size("errores").cast("int")).drop("errores")


def q_vector_elements(spark, d):
    v = M.assemble(clean_features(spark, d).select("row_id", "edad", "sexo"), ["edad", "sexo"], "v")
    return C.vector_elements(v, "v", ["v0", "v1"], drop=True).select("row_id", "v0", "v1")


def q_jitter(spark, d):
    return _round_all(J.age_scatter(ext(spark, d)))


def q_scatter_sample(spark, d):
    return J.age_scatter(ext(spark, d)).drop("edad_jitter")


# ---------------------------------------------------------------- A: aggregations

def q_row_count(spark, d):
    return A.row_count(ext(spark, d))


def q_distinct_pairs(spark, d):
    return A.distinct_values(wide(spark, d), ["sexo", "estrato"])


def q_value_counts(spark, d):
    return _round_all(A.value_counts(ext(spark, d), "condicion_ocupacion", normalize=True))


def q_global_mode(spark, d):
    return A.mode(ext(spark, d), IMPUTE_COLS)


def q_group_mode(spark, d):
    return A.group_mode(ranged(spark, d), "age_range", IMPUTE_COLS)


def q_group_mode_docs(spark, d):
    return A.group_mode(T.documents_labels(spark, d), "lang", ["source", "quality", "toxic"])


def q_global_median(spark, d):
    return A.median(wide(spark, d), "estrato")


def q_group_median(spark, d):
    w = wide(spark, d)
    cond = P.eligible(occ_col="ocupado", occ_value=1)
    return A.group_median(w, ["sexo", "estrato"], "ingreso_total", where=cond)


def q_group_median_income_exact(spark, d):
    w = wide(spark, d)
    cond = P.eligible(occ_col="ocupado", occ_value=1)
    return A.group_median(w, ["sexo", "estrato"], "ingreso_total", where=cond)


def q_median_price_exact(spark, d):
    li = T.table(spark, d, "lineitem", ["l_returnflag", "l_extendedprice"])
    return A.group_median(li, ["l_returnflag"], "l_extendedprice")


def q_group_median_parts(spark, d):
    p = T.table(spark, d, "part", ["p_brand", "p_size"])
    return A.group_median(p, ["p_brand"], "p_size")


def q_null_rates(spark, d):
    return _round_all(A.null_rates(ext(spark, d), cb.CLUSTER_FEATURES))


def q_null_rates_by(spark, d):
    return _round_all(J.null_report(ext(spark, d))["resumen"])


def q_group_means(spark, d):
    return _round_all(A.group_means(ext(spark, d), "sexo", cb.CLUSTER_FEATURES))


def q_global_means(spark, d):
    return _round_all(A.means(ext(spark, d), cb.CLUSTER_FEATURES))


def q_corr_matrix(spark, d):
    return _round_all(J.correlation_report(ext(spark, d))["matriz"])


def q_target_corr(spark, d):
    return _round_all(J.correlation_report(ext(spark, d))["objetivo"])


def q_corr_lineitem(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _round_all(A.corr_matrix(T.table(spark, d, "lineitem", cols), cols))


def q_crosstab(spark, d):
    return _round_all(J.occupation_by_age(ext(spark, d)))


def q_confusion(spark, d):
    return MT.confusion_matrix(rule_scored(spark, d), "y", "pred")


def q_class_counts(spark, d):
    return MT.class_counts(MT.confusion_matrix(rule_scored(spark, d), "y", "pred"))


def q_weighted_metrics(spark, d):
    return _round_all(MT.weighted_metrics(rule_scored(spark, d), "y", "pred"))


def q_class_report(spark, d):
    return _round_all(MT.classification_report(rule_scored(spark, d), "y", "pred"))


def q_real_vs_pred(spark, d):
    return MT.real_vs_predicted(rule_scored(spark, d), "y", "pred")


def q_audit_series(spark, d):
    return _round_all(MT.audit_series(rule_scored(spark, d), "y", "pred"))


def q_class_shares(spark, d):
    sc = rule_scored(spark, d)
    y = A.value_counts(sc, "y", normalize=True).select(F.lit("real").alias("serie"), F.col("y").alias("clase"), "n", "pct")
    p = A.value_counts(sc, "pred", normalize=True).select(F.lit("prediccion").alias("serie"), F.col("pred").alias("clase"), "n", "pct")
    return _round_all(y.unionByName(p))


def q_metrics_lines(spark, d):
    return J.metrics_lines(MT.weighted_metrics(rule_scored(spark, d), "y", "pred"))


def q_null_rate_lines(spark, d):
    return J.null_rate_lines(A.null_rates(ext(spark, d), cb.CLUSTER_FEATURES), cb.CLUSTER_FEATURES)


def q_audit_counts(spark, d):
    r = ranged(spark, d)
    from surveyspark.functions.expressions import any_null
    in_range = (F.col("edad") >= 0) & (F.col("edad") <= 12)
    complete = ~any_null(cb.CLUSTER_FEATURES)  # integer features: NULL is the only missing value
    return A.audit_steps(r, {"leidos": None, "sin_menores_incompletos": ~(in_range & any_null(r.columns)),
                             "sin_nulos_features": complete})


# ---------------------------------------------------------------- R / O: reshape, order

def q_null_pct_matrix(spark, d):
    return _round_all(J.null_report(ext(spark, d))["porcentaje"])


def q_null_count_matrix(spark, d):
    m = J.null_report(ext(spark, d))["cantidad"]
    return m.select("columna", *[F.col(c).cast("bigint").alias(c) for c in m.columns if c != "columna"])


def q_top_missing(spark, d):
    return _round_all(J.null_report(ext(spark, d))["top"])


def q_head(spark, d):
    return R.head(ext(spark, d), 5, ["row_id"])


# ---------------------------------------------------------------- K: sampling

def q_sample_cap(spark, d):
    return K.sample_cap(ext(spark, d), "row_id", 10000, 42).select("row_id")


def q_sample_n(spark, d):
    return K.sample_n(ext(spark, d), "row_id", 5000, 42).select("row_id")


def q_split(spark, d):
    return K.split(ext(spark, d).select("row_id"), "row_id", [0.8, 0.2], 42, part_col="part")


def q_stratified_split(spark, d):
    e = P.filter_not_null(ext(spark, d), "condicion_ocupacion").select("row_id", "condicion_ocupacion")
    return K.stratified_split(e, "row_id", "condicion_ocupacion", 0.8, 42, part_col="part")


def q_folds(spark, d):
    return K.assign_folds(ext(spark, d).select("row_id"), "row_id", 5, 42)


# ---------------------------------------------------------------- I: imputation

def q_impute_median(spark, d):
    return I.impute_median(phase2(spark, d), "estrato").select("row_id", "estrato")


def q_impute_mode(spark, d):
    return I.impute_mode(phase2(spark, d), ["condicion_ocupacion"]).select("row_id", "condicion_ocupacion")


def q_impute_income(spark, d):
    return _round_all(I.impute_income(phase2(spark, d)).select("row_id", "ingreso_total"))


def q_impute_education(spark, d):
    return I.impute_mode(phase2(spark, d), ["nivel_educativo_cod", "anios_educacion"]).select(
        "row_id", "nivel_educativo_cod", "anios_educacion")


def q_impute_phase2(spark, d):
    return _round_all(I.impute_phase2(phase2(spark, d)))


def q_impute_by_age(spark, d):
    return J.impute_by_age(ext(spark, d), drop_helper=False)


def q_imputed_counts(spark, d):
    """Flagship: C4 -> P8 -> I6, then rows per (age range, employment)."""
    imp = J.impute_by_age(ext(spark, d), drop_helper=False)
    return imp.groupBy("age_range", "condicion_ocupacion").agg(F.count(F.lit(1)).alias("n"))


def q_imputation_job(spark, d):
    src = scratch_path(spark, "filtered")
    dst = scratch_path(spark, "imputed")
    S.write_csv(ext(spark, d), src)
    J.run_imputation(spark, src, dst, schema=EXT_SCHEMA)
    return S.read_csv(spark, dst, schema=EXT_SCHEMA)


def q_extract_job(spark, d):
    """V7 end to end: three CSV extracts (two quoted, one plain) -> aligned union -> extract."""
    s = T.survey(spark, d)
    root = scratch_path(spark, "raw")
    S.write_csv(s.filter(F.col("src") == 0).drop("REGION"), f"{root}/y0", quote_all=True)
    S.write_csv(s.filter(F.col("src") == 1).drop("MES"), f"{root}/y1", quote_all=True)
    S.write_csv(s.filter(F.col("src") == 2), f"{root}/y2")
    out = J.run_extract(spark, [f"{root}/y0", f"{root}/y1"], [f"{root}/y2"], keep=["row_id"])
    return out.withColumn("row_id", F.col("row_id").cast("bigint"))


# ---------------------------------------------------------------- M: machine learning

def q_standardize_sample(spark, d):
    z = M.standardize(clean_features(spark, d), ["edad", "nivel_educativo_cod"], ddof=1)
    return _round_all(z.select("row_id", "edad_z", "nivel_educativo_cod_z"))


def q_standardize_pop(spark, d):
    z = M.standardize(clean_features(spark, d), ["edad", "nivel_educativo_cod"], ddof=0)
    return _round_all(z.select("row_id", "edad_z", "nivel_educativo_cod_z"))


def q_scaled_vector(spark, d):
    a = M.assemble(clean_features(spark, d).select("row_id", "edad", "nivel_educativo_cod"),
                   ["edad", "nivel_educativo_cod"])
    _, sc = M.scale_vector(a)
    return _round_all(C.vector_elements(sc.select("row_id", "scaledFeatures"), "scaledFeatures",
                                        ["edad_z", "nivel_educativo_cod_z"], drop=True))


def _blob_clusters(spark, d, res_pred: DataFrame) -> DataFrame:
    sizes = res_pred.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.avg("f1").alias("media_f1"))
    from pyspark.sql import Window
    return _round_all(sizes.select(
        F.row_number().over(Window.orderBy("media_f1")).cast("bigint").alias("orden"), "n", "media_f1"))


def q_kmeans_planted(spark, d):
    b = reliable_checkpoint(blobs(spark, d))
    a = M.assemble(b, ["f1", "f2", "f3"])
    _, sc = M.scale_vector(a)
    _, pred = M.kmeans(sc, "scaledFeatures", 3, 42)
    return _blob_clusters(spark, d, pred)


def q_kmeans_centers(spark, d):
    b = reliable_checkpoint(blobs(spark, d))
    a = M.assemble(b, ["f1", "f2", "f3"])
    model, _ = M.kmeans(a, "features", 3, 42)
    c = M.centers(b, model, ["f1", "f2", "f3"])
    from pyspark.sql import Window
    return _round_all(c.select(F.row_number().over(Window.orderBy("f1")).cast("bigint").alias("orden"), "f1", "f2", "f3"))


def q_pca_variance(spark, d):
    li = T.table(spark, d, "lineitem", ["l_quantity", "l_discount"])
    a = M.assemble(li, ["l_quantity", "l_discount"])
    _, sc = M.scale_vector(a)
    model, _ = M.pca(reliable_checkpoint(sc), "scaledFeatures", 2)
    return _round_all(M.explained_variance(li, model))


def q_cluster_details(spark, d):
    details, _ = M.cluster_profile(clean_features(spark, d), "sexo", cb.CLUSTER_FEATURES)
    return _round_all(details)


def q_cluster_profiles(spark, d):
    _, profiles = M.cluster_profile(clean_features(spark, d), "sexo", cb.CLUSTER_FEATURES)
    return profiles


def q_cluster_profile_lines(spark, d):
    details, profiles = M.cluster_profile(clean_features(spark, d), "sexo", cb.CLUSTER_FEATURES)
    return J.profile_lines(details, profiles)


def q_clustering_job_planted(spark, d):
    res = J.clustering(blobs(spark, d), features=["f1", "f2", "f3"], key="row_id")
    return _blob_clusters(spark, d, res["predicciones"])


def q_cluster_points_planted(spark, d):
    """V5 on the blobs: f2 = f1 + 1 and f3 = 2 * f1, so PC1 = sqrt(3) * z(f1) and PC2 = 0 (signs free)."""
    pts = J.cluster_points(blobs(spark, d), features=["f1", "f2", "f3"], key="row_id")
    return _round_all(pts.select("row_id", F.abs("pca_x").alias("pca_x"), F.abs("pca_y").alias("pca_y")))


def q_cluster_points(spark, d):
    """V5 on two real features: rows and the variance of each axis, which do not depend on signs or labels."""
    pts = J.cluster_points(ext(spark, d), features=["edad", "nivel_educativo_cod"])
    one = pts.agg(F.count("*").cast("double").alias("filas"), F.var_samp("pca_x").alias("var_x"), F.var_samp("pca_y").alias("var_y"))
    return _round_all(one)


def q_string_index(spark, d):
    e = ext(spark, d).select("row_id", "Lengua")
    _, out = M.string_index(e, "Lengua", "lengua_idx")
    return out.select("row_id", F.col("lengua_idx").cast("int").alias("lengua_idx"))


def q_one_hot(spark, d):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    e = ext(spark, d).select("row_id", "Etnia")
    pipe = Pipeline(stages=[M.string_indexer("Etnia", "etnia_idx"), M.one_hot(["etnia_idx"], ["etnia_oh"], "ignore")])
    out = pipe.fit(e).transform(e)
    arr = vector_to_array(F.col("etnia_oh"))
    return out.select("row_id", (F.array_position(arr, 1.0) - 1).cast("int").alias("oh_pos"),
                      F.size(arr).alias("oh_len"))


def q_forest_planted(spark, d):
    data = reliable_checkpoint(planted(spark, d))
    pipe, _ = M.classifier_pipeline("condicion_ocupacion", ["edad"], [], 42, numTrees=20, maxDepth=5, **RF_PLANTED)
    model = pipe.fit(data)
    return M.score(model, data).select("row_id", F.col("condicion_ocupacion").alias("y"), "prediccion")


def q_grid_search(spark, d):
    res = J.run_training(planted(spark, d), numeric=["edad"], categorical=[], rf_params=RF_PLANTED)
    return _round_all(res["metrics"])


def q_training_sk_style(spark, d):
    res = J.run_training(planted(spark, d), numeric=["edad"], categorical=cb.MODEL_CATEGORICAL,
                         num_trees=(50, 100), max_depth=(5, 10), stratified=True, unknown="ignore",
                         scale_numeric=True, rf_params=RF_PLANTED)
    return _round_all(res["metrics"])


def noisy(spark, d) -> DataFrame:
    """``planted`` with a fifth of the labels flipped, by a hash of the row: no model can do better than the rule."""
    flip = key_hash("row_id", 7) < F.lit("33333333")
    other = F.when(F.col("condicion_ocupacion") == cb.EMPLOYED, F.lit(cb.NOT_EMPLOYED)).otherwise(F.lit(cb.EMPLOYED))
    return planted(spark, d).withColumn("condicion_ocupacion", F.when(flip, other).otherwise(F.col("condicion_ocupacion")))


def q_training_noisy(spark, d):
    """M16 on labels with noise: hold-out metrics of the rule, and the mean accuracy of each grid point over the folds."""
    res = J.run_training(noisy(spark, d), numeric=["edad"], categorical=[], rf_params={**RF_PLANTED, "minInstancesPerNode": 100})
    names = res["metrics"].columns
    metrics = res["metrics"].unpivot([], names, "clave", "valor").withColumn("tabla", F.lit("metricas"))
    point = F.format_string("numTrees=%d,maxDepth=%d", "numTrees", "maxDepth")
    grid = res["grid"].select(point.alias("clave"), F.col("accuracy").alias("valor"), F.lit("rejilla").alias("tabla"))
    return _round_all(metrics.unionByName(grid).select("tabla", "clave", "valor"))


def _planted_model(spark, d):
    data = reliable_checkpoint(planted(spark, d))
    pipe, _ = M.classifier_pipeline("condicion_ocupacion", ["edad"], [], 42, numTrees=20, maxDepth=5,
                                    **RF_PLANTED)
    return pipe.fit(data), data


def _answers(spark, d, data: DataFrame) -> DataFrame:
    """Answer records as the form sends them: labels, and the age as text."""
    return C.decode_answers(data.drop("condicion_ocupacion").withColumn("edad", F.col("edad").cast("string")),
                            cb.ANSWER_DICTIONARIES)


def _bad_answers(spark, d, data: DataFrame) -> DataFrame:
    """Answer records of which some have an unknown label, an age that is no number, or none."""
    return _answers(spark, d, data).withColumns({
        "sexo": F.when(F.col("row_id") % 11 == 0, F.lit("?")).otherwise(F.col("sexo")),
        "edad": F.when(F.col("row_id") % 13 == 0, F.lit("x1")).when(F.col("row_id") % 17 == 0, F.lit(None)).otherwise(F.col("edad"))})


def q_score_records(spark, d):
    model, data = _planted_model(spark, d)
    out = J.score_answers(model, _answers(spark, d, data))["scored"]
    return _round_all(out.select("row_id", "prediccion", "p_DESOCUPADO", "p_OCUPADO"))


def q_score_records_rejected(spark, d):
    """Records with an unknown label, an age that is no number, or none, come back as given with the bad fields."""
    model, data = _planted_model(spark, d)
    out = J.score_answers(model, _bad_answers(spark, d, data))["rejected"]
    return out.select("row_id", "sexo", "edad", F.array_join("errores", ",").alias("errores"))


def q_audit_job(spark, d):
    model, data = _planted_model(spark, d)
    return _round_all(J.run_audit(model, data)["por_clase"])


def q_analysis_job(spark, d):
    out = J.run_analysis(ext(spark, d))
    return _round_all(J.analysis_long(out))


def q_stream_scoring(spark, d):
    from surveyspark.streaming.scoring import score_stream_to_table
    model, data = _planted_model(spark, d)
    src = scratch_path(spark, "answers_in")
    data.drop("condicion_ocupacion").write.parquet(src)
    out = score_stream_to_table(spark, model, src, data.drop("condicion_ocupacion").schema,
                                scratch_path(spark, "scored_out"), scratch_path(spark, "stream_ckpt"))
    return out.select("row_id", "prediccion")


def q_stream_answers(spark, d):
    """Answers as the form sends them, arriving in files: scored and rejected records of all micro-batches."""
    from surveyspark.streaming.scoring import score_answers_stream
    model, data = _planted_model(spark, d)
    answers = _bad_answers(spark, d, data)
    src = scratch_path(spark, "form_in")
    answers.repartition(3, "row_id").write.parquet(src)
    out = score_answers_stream(spark, model, src, answers.schema, scratch_path(spark, "form_out"), scratch_path(spark, "form_ckpt"), files_per_batch=1)
    scored = out["scored"].select("row_id", "prediccion", F.lit("").alias("errores"))
    return scored.unionByName(out["rejected"].select("row_id", F.lit(None).cast("string").alias("prediccion"), F.array_join("errores", ",").alias("errores")))


def q_csv_common_types(spark, d):
    """Three extracts that disagree: a column of whole numbers in one and decimals in another, one with a text among its
    numbers, one beyond int in the last only. Each gets one type, from one pass over the files."""
    root = scratch_path(spark, "mixed")
    s = T.survey(spark, d).select("row_id", "src", "ESTRATO", "INGTOT")
    parts = [
        s.filter("src = 0").selectExpr("row_id", "CAST(floor(INGTOT) AS BIGINT) AS ingreso", "CAST(ESTRATO AS STRING) AS estrato", "CAST(row_id AS BIGINT) AS grande"),
        s.filter("src = 1").selectExpr("row_id", "INGTOT AS ingreso", "IF(row_id % 5 = 0, 'alto', CAST(ESTRATO AS STRING)) AS estrato", "CAST(NULL AS BIGINT) AS grande"),
        s.filter("src = 2").selectExpr("row_id", "CAST(NULL AS DOUBLE) AS ingreso", "CAST(ESTRATO AS STRING) AS estrato", "row_id + 3000000000 AS grande", "src AS sobra")]
    paths = [S.write_csv(p, f"{root}/y{i}", quote_all=i < 2) for i, p in enumerate(parts)]
    out = J.read_extracts(spark, paths[:2], paths[2:], one_pass=True)[0]
    kinds = F.concat_ws(",", *[F.typeof(c) for c in ("row_id", "ingreso", "estrato", "grande")])
    return out.select(F.col("row_id").cast("bigint").alias("row_id"), "ingreso", "estrato", "grande", kinds.alias("tipos"))


def q_csv_single_file(spark, d):
    """One file with one header from many partitions, in their order, quotes and line breaks inside values."""
    path = f"{scratch_path(spark, 'one')}/salida.csv"
    parts = max(5, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = T.table(spark, d, "documents", ["doc_id", "text", "lang"]).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    S.write_csv(docs.withColumn("text", F.concat(F.lit('"'), "text")), path, single_file=True)
    back = S.read_csv_file(spark, path, "doc_id long, text string, lang string")
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"), "lang")


# ---------------------------------------------------------------- NULL keys, NULL classes, ties, NaN

def null_keyed(spark, d) -> DataFrame:
    """Rows of which every fourth has no key and every third no class."""
    return ext(spark, d).select("row_id", F.expr("CASE WHEN row_id % 4 = 0 THEN NULL ELSE row_id END").alias("nkey"),
                                F.expr("CASE WHEN row_id % 3 = 0 THEN NULL ELSE condicion_ocupacion END").alias("clase"))


def q_split_zero_weight(spark, d):
    return K.split(null_keyed(spark, d), "nkey", [0.8, 0.2, 0.0], 42, "part", ["row_id"]).select("row_id", "part")


def q_sample_n_null_keys(spark, d):
    return K.sample_n(null_keyed(spark, d), "nkey", 5000, 42, ["row_id"]).select("row_id")


def q_stratified_split_null_class(spark, d):
    return K.stratified_split(null_keyed(spark, d), "nkey", "clase", 0.8, 42, "part", ["row_id"]).select("row_id", "clase", "part")


def q_folds_null_class(spark, d):
    return K.assign_folds(null_keyed(spark, d), "nkey", 5, 42, "clase", tie=["row_id"]).select("row_id", "clase", "fold")


def q_group_mode_all_null_group(spark, d):
    e = ext(spark, d).selectExpr("row_id % 7 AS g", "CASE WHEN row_id % 7 = 3 THEN NULL ELSE Lengua END AS v", "Etnia AS w")
    return A.group_mode(e, "g", ["v", "w"])


def q_group_median_heaped(spark, d):
    """Half of each group lies at one value."""
    li = T.table(spark, d, "lineitem", ["l_orderkey", "l_returnflag", "l_extendedprice"])
    heaped = li.select("l_returnflag", F.expr("CASE WHEN l_orderkey % 2 = 0 THEN 1000.0 ELSE l_extendedprice END").alias("v"))
    return A.group_median(heaped, ["l_returnflag"], "v")


def q_group_median_bigint(spark, d):
    """A7 beyond 2^53, where doubles no longer tell neighbours apart."""
    li = T.table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_returnflag"])
    big = li.select("l_returnflag", F.expr("9007199254740993 + (l_orderkey * 7919 + l_partkey) % 1000003 - 500000").alias("v"))
    return A.group_median(big, ["l_returnflag"], "v")


def q_median_decimal(spark, d):
    """A6 of a decimal of 30 digits, exact to the last one."""
    o = T.table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    v = "CAST(123456789012345678 AS DECIMAL(28,0)) * 100 + (o_orderkey * 31 + o_custkey) % 9973"
    return A.median(o.select(F.expr(f"CAST({v} AS DECIMAL(38,0))").alias("v")), "v").select(F.col("mediana").cast("string").alias("mediana"))


def q_group_median_date(spark, d):
    li = T.table(spark, d, "lineitem", ["l_shipdate", "l_returnflag"])
    return A.group_median(li.select("l_returnflag", F.to_date("l_shipdate").alias("f")), ["l_returnflag"], "f").select("l_returnflag", F.col("mediana").cast("string").alias("mediana"))


def heavy_keyed(spark, d) -> DataFrame:
    """A third of the rows under one key, a third without one, the others under keys of their own."""
    return ext(spark, d).select("row_id", F.expr("CASE WHEN row_id % 3 = 0 THEN 1 WHEN row_id % 3 = 1 THEN NULL ELSE row_id END").alias("hkey"))


def q_sample_cap_heavy_key(spark, d):
    return K.sample_cap(heavy_keyed(spark, d), "hkey", 1000, 42, ["row_id"]).select("row_id")


def q_sample_n_heavy_key(spark, d):
    """The sample ends inside the heavy key, whose rows share a hash."""
    keyed = heavy_keyed(spark, d).filter("row_id % 3 = 0 OR row_id % 11 = 2")
    return K.sample_n(keyed, "hkey", 700, 42, ["row_id"]).select("row_id")


def q_corr_matrix_nan(spark, d):
    """NaN is a missing value, as NULL is."""
    e = ext(spark, d).selectExpr("CASE WHEN row_id % 10 = 0 THEN double('NaN') ELSE double(edad) END AS edad", "nivel_educativo_cod", "sexo")
    return _round_all(A.corr_matrix(e, ["edad", "nivel_educativo_cod", "sexo"]))


def q_drop_incomplete_keep(spark, d):
    return P.drop_incomplete_in_range(ext(spark, d), "edad", 0, 12, columns=["Lengua", "Etnia"], keep_null_range=True).select("row_id")


def q_audit_text_lines(spark, d):
    return J.audit_lines(J.audit_tables(rule_scored(spark, d), "y", "pred"), "y", "pred")


def q_clustering_facts(spark, d):
    """M8 on real data: the clusters' means, weighted by size, are the global means, whatever their labels."""
    e = ext(spark, d)
    res = J.clustering(e)
    sizes = res["predicciones"].groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"))
    per = res["detalles"].join(sizes, "cluster").groupBy("feature").agg(
        F.sum("n").cast("double").alias("filas"), (F.sum(F.col("media_cluster") * F.col("n")) / F.sum("n")).alias("media"))
    return _round_all(per)


def q_clustering_fixpoint(spark, d):
    """M4 on real data: no row lies nearer to another centre than to its own, and each centre is its rows' mean."""
    feats = cb.CLUSTER_FEATURES
    res = J.clustering(ext(spark, d))
    rows = M.standardize(res["predicciones"], feats, 1)
    centres = {r["cluster"]: [r[f] for f in feats] for r in res["centros"].collect()}  # k rows

    def distance(centre):
        return sum((F.col(f"{f}_z") - F.lit(c)) * (F.col(f"{f}_z") - F.lit(c)) for f, c in zip(feats, centre))

    far = F.array(*[distance(centres[i]) for i in sorted(centres)])
    rows = rows.withColumn("_d", far)
    astray = F.count_if(F.get("_d", F.col("prediction")) > F.array_min("_d") + 1e-6)
    off = [F.max(F.abs(F.col(f"m_{f}") - F.element_at(F.create_map(*[F.lit(x) for i in centres for x in (i, centres[i][k])]), F.col("prediction"))))
           for k, f in enumerate(feats)]
    means = rows.groupBy("prediction").agg(*[F.avg(f"{f}_z").alias(f"m_{f}") for f in feats], F.count("*").alias("n"), astray.alias("astray"))
    return means.agg(F.sum("n").alias("filas"), F.sum("astray").alias("mal_asignadas"), (F.greatest(*off) < 0.05).alias("centros_en_la_media"))


def q_one_hot_keep(spark, d):
    """A level that the fit has not seen gets the slot of its own."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    e = ext(spark, d).select("row_id", "Etnia").filter("Etnia IS NOT NULL")
    pipe = Pipeline(stages=[M.string_indexer("Etnia", "etnia_idx"), M.one_hot(["etnia_idx"], ["etnia_oh"], "keep")])
    arr = vector_to_array(F.col("etnia_oh"))
    out = pipe.fit(e.filter("Etnia <> 5")).transform(e)
    return out.select("row_id", (F.array_position(arr, 1.0) - 1).cast("int").alias("oh_pos"))


QUERIES = {
    # sources / sinks
    "csv_quoted_roundtrip": q_csv_quoted,
    "csv_unquoted_roundtrip": q_csv_unquoted,
    "csv_schema_read": q_csv_schema,
    "resolve_source_glob": q_resolve_source,
    "report_roundtrip": q_report_roundtrip,
    "model_save_load": q_model_roundtrip,
    # projections / filters
    "extract_recode": q_extract,
    "align_union_extracts": q_align_union,
    "wide_select_rename": q_wide_select,
    "not_null_target": q_not_null_target,
    "eligible_earners": q_eligible_earners,
    "drop_incomplete_children": q_drop_incomplete,
    "drop_null_features": q_drop_null_features,
    "known_classes": q_known_classes,
    "column_kinds": q_column_kinds,
    "features_target": q_features_target,
    # scalar
    "recode_binary": q_recode_binary,
    "age_clusters": q_age_clusters,
    "age_ranges": q_age_ranges,
    "age_bins": q_age_bins,
    "label_numbers": q_label_numbers,
    "missing_rates_documents": q_missing_rates_docs,
    "encode_answers": q_encode_answers,
    "vector_elements": q_vector_elements,
    "age_scatter_jitter": q_jitter,
    "age_scatter_sample": q_scatter_sample,
    # aggregates
    "row_count": q_row_count,
    "distinct_pairs": q_distinct_pairs,
    "value_counts": q_value_counts,
    "global_mode": q_global_mode,
    "group_mode": q_group_mode,
    "group_mode_documents": q_group_mode_docs,
    "global_median": q_global_median,
    "group_median_income": q_group_median,
    "group_median_parts": q_group_median_parts,
    "group_median_income_exact": q_group_median_income_exact,
    "median_price_exact": q_median_price_exact,
    "null_rates": q_null_rates,
    "null_rates_by_cluster": q_null_rates_by,
    "group_means": q_group_means,
    "global_means": q_global_means,
    "corr_matrix": q_corr_matrix,
    "target_corr": q_target_corr,
    "corr_matrix_lineitem": q_corr_lineitem,
    "crosstab_occupation_age": q_crosstab,
    "confusion_matrix": q_confusion,
    "class_counts": q_class_counts,
    "weighted_metrics": q_weighted_metrics,
    "classification_report": q_class_report,
    "real_vs_predicted": q_real_vs_pred,
    "audit_series": q_audit_series,
    "class_shares": q_class_shares,
    "audit_counts": q_audit_counts,
    "metrics_text_lines": q_metrics_lines,
    "null_rate_text_lines": q_null_rate_lines,
    # reshape / order
    "null_pct_matrix": q_null_pct_matrix,
    "null_count_matrix": q_null_count_matrix,
    "top_missing": q_top_missing,
    "head_rows": q_head,
    # sampling
    "split_zero_weight": q_split_zero_weight,
    "sample_n_null_keys": q_sample_n_null_keys,
    "stratified_split_null_class": q_stratified_split_null_class,
    "folds_null_class": q_folds_null_class,
    "group_mode_all_null_group": q_group_mode_all_null_group,
    "group_median_heaped": q_group_median_heaped,
    "corr_matrix_nan": q_corr_matrix_nan,
    "group_median_bigint": q_group_median_bigint,
    "median_decimal": q_median_decimal,
    "group_median_date": q_group_median_date,
    "sample_cap_heavy_key": q_sample_cap_heavy_key,
    "sample_n_heavy_key": q_sample_n_heavy_key,
    "drop_incomplete_keep_null": q_drop_incomplete_keep,
    "audit_text_lines": q_audit_text_lines,
    "one_hot_keep": q_one_hot_keep,
    "score_records_rejected": q_score_records_rejected,
    "sample_cap": q_sample_cap,
    "sample_n": q_sample_n,
    "split_80_20": q_split,
    "stratified_split": q_stratified_split,
    "assign_folds": q_folds,
    # imputation
    "impute_median": q_impute_median,
    "impute_mode": q_impute_mode,
    "impute_income": q_impute_income,
    "impute_education": q_impute_education,
    "impute_phase2": q_impute_phase2,
    "impute_by_age_range": q_impute_by_age,
    "imputed_counts": q_imputed_counts,
    "imputation_job": q_imputation_job,
    "extract_job": q_extract_job,
    # machine learning
    "standardize_sample": q_standardize_sample,
    "standardize_population": q_standardize_pop,
    "scaled_vector": q_scaled_vector,
    "kmeans_planted": q_kmeans_planted,
    "kmeans_centers": q_kmeans_centers,
    "pca_variance": q_pca_variance,
    "cluster_profile_details": q_cluster_details,
    "cluster_profile_text": q_cluster_profiles,
    "cluster_profile_lines": q_cluster_profile_lines,
    "clustering_job": q_clustering_facts,
    "clustering_job_planted": q_clustering_job_planted,
    "cluster_points": q_cluster_points,
    "cluster_points_planted": q_cluster_points_planted,
    "string_index": q_string_index,
    "one_hot": q_one_hot,
    "forest_planted": q_forest_planted,
    "grid_search_planted": q_grid_search,
    "training_stratified_planted": q_training_sk_style,
    "score_records": q_score_records,
    "audit_job": q_audit_job,
    "analysis_job": q_analysis_job,
    "stream_scoring": q_stream_scoring,
    "stream_answers": q_stream_answers,
    "csv_common_types": q_csv_common_types,
    "csv_single_file": q_csv_single_file,
    "clustering_fixpoint": q_clustering_fixpoint,
    "training_noisy_planted": q_training_noisy,
}

COVERS = {
    "split_zero_weight": "K3", "sample_n_null_keys": "K2", "stratified_split_null_class": "K4", "folds_null_class": "K5",
    "group_mode_all_null_group": "A5", "group_median_heaped": "A7", "corr_matrix_nan": "A12", "group_median_bigint": "A7", "median_decimal": "A6", "group_median_date": "A7",
    "sample_cap_heavy_key": "K1", "sample_n_heavy_key": "K2", "drop_incomplete_keep_null": "P8",
    "audit_text_lines": "S6 M18", "one_hot_keep": "M10", "score_records_rejected": "C12 M17",
    "csv_quoted_roundtrip": "S1 S5", "csv_unquoted_roundtrip": "S2 S5", "csv_schema_read": "S3",
    "resolve_source_glob": "S4", "report_roundtrip": "S6 A8", "model_save_load": "S7 S8 M17",
    "extract_recode": "P2 P3 C1", "align_union_extracts": "P1 U1", "wide_select_rename": "P4 P2 P3",
    "not_null_target": "P6", "eligible_earners": "P7", "drop_incomplete_children": "P8 C4",
    "drop_null_features": "P9", "known_classes": "P10", "column_kinds": "P11", "features_target": "P13 P12",
    "recode_binary": "C2", "age_clusters": "C3", "age_ranges": "C4", "age_bins": "C5",
    "label_numbers": "C6 C7", "missing_rates_documents": "C8 A8", "encode_answers": "C11 C12",
    "vector_elements": "C15 M1", "age_scatter_jitter": "C14 V4", "age_scatter_sample": "K2 V4",
    "row_count": "A1", "distinct_pairs": "A2", "value_counts": "A3", "global_mode": "A4 O1",
    "group_mode": "A5 O1", "group_mode_documents": "A5", "global_median": "A6", "group_median_income": "A7 P7",
    "group_median_parts": "A7", "group_median_income_exact": "A7 (bounded-state exact)",
    "median_price_exact": "A7 (bounded-state exact)", "null_rates": "A8 C8", "null_rates_by_cluster": "A9 R1 C3",
    "group_means": "A10", "global_means": "A11", "corr_matrix": "A12 V2", "target_corr": "A13 O4 V2",
    "corr_matrix_lineitem": "A12", "crosstab_occupation_age": "A14 V3 C5 P10", "confusion_matrix": "A15",
    "class_counts": "A16", "weighted_metrics": "A17", "classification_report": "A18",
    "real_vs_predicted": "A19", "audit_series": "V6", "class_shares": "A3", "audit_counts": "A20 (one pass)", "metrics_text_lines": "S6 C13", "null_rate_text_lines": "S6 C13 A8",
    "null_pct_matrix": "R2 V1", "null_count_matrix": "R2 V1", "top_missing": "O2 O3 V1", "head_rows": "O5",
    "sample_cap": "K1", "sample_n": "K2", "split_80_20": "K3", "stratified_split": "K4", "assign_folds": "K5",
    "impute_median": "I1 A6", "impute_mode": "I2 A4", "impute_income": "I3 A7",
    "impute_education": "I4", "impute_phase2": "I5", "impute_by_age_range": "I6 C4 P8 P5",
    "imputed_counts": "I6 (flagship)", "imputation_job": "I7 S3 S5", "extract_job": "V7 S1 S2 P1 U1",
    "standardize_sample": "M2", "standardize_population": "M3", "scaled_vector": "M2 M1 C15",
    "kmeans_planted": "M4", "kmeans_centers": "M5", "pca_variance": "M6",
    "cluster_profile_details": "M7 C9 C10 C13 A10 A11", "cluster_profile_text": "M7 C10", "cluster_profile_lines": "S6 C13 M7",
    "clustering_job": "M8 V8", "clustering_job_planted": "M8 M4 M6 M7 (planted)", "cluster_points": "V5 K1 M6 C15", "cluster_points_planted": "V5 M6 K1 (planted)", "string_index": "M9", "one_hot": "M10 M11",
    "forest_planted": "M12 M13 M17", "grid_search_planted": "M14 M15 M16 K3 K5",
    "training_stratified_planted": "M11 M16 K4 M3", "score_records": "M17 C11 C12", "audit_job": "M18 V6",
    "analysis_job": "V8 V1", "stream_scoring": "M17 (streaming)", "stream_answers": "M17 (streaming) C11 C12", "csv_common_types": "S1 S2 S3 U1", "csv_single_file": "S5", "clustering_fixpoint": "M2 M4 M5 M8",
    "training_noisy_planted": "M13 M14 M15 M16 K3 K5",
}
