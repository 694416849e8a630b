"""Composite jobs (V1-V8, I7, M8, M16, M18) built from the operators.

Each job takes DataFrames (or paths) and returns DataFrames; reports are tables that can
be written with ``sources.write_report``. Nothing is sampled to the driver: every report
is computed over the full data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from surveyspark.functions import codebooks as cb
from surveyspark.operators import aggregates as A
from surveyspark.operators import columns as P
from surveyspark.operators import impute as I
from surveyspark.operators import metrics as MT
from surveyspark.operators import ml as M
from surveyspark.operators import moments as MO
from surveyspark.operators import recode as C
from surveyspark.operators import reshape as R
from surveyspark.operators import sampling as K
from surveyspark.session import reliable_checkpoint
from surveyspark.sources import files as S
from surveyspark.sources.models import save_model


# ---------------------------------------------------------------- extraction (V7)

def extract(df: DataFrame, mapping: dict[str, str] = cb.EXTRACT_RENAME, keep: list[str] | None = None,
            target: str = "condicion_ocupacion") -> tuple[DataFrame, list[str]]:
    """P2 -> P3 -> C1: business columns, renamed, employment recoded to OCUPADO/DESOCUPADO."""
    out, missing = P.select_rename(df, mapping, keep)
    if target in out.columns:
        out = C.recode(out, target, cb.EMPLOYMENT_CODES)
    return out, missing


def read_extracts(spark: SparkSession, quoted: list[str], unquoted: list[str],
                  schemas: dict[str, object] | None = None, one_pass: bool = False) -> list[DataFrame]:
    """S1 for quoted files, S2 for unquoted single-line files.

    ``schemas`` maps a path to its declared schema. Paths without one are inferred each on its own (one extra pass over
    each file); with ``one_pass`` they are read as text, aligned on their common columns and typed together in one pass
    over the files (``with_common_types``), and come back as one table: for extracts that disagree, or are huge.
    """
    schemas = schemas or {}
    quoting = {**{p: {"quote": '"', "escape": '"'} for p in quoted}, **{p: {"multiline": False} for p in unquoted}}
    dfs = [S.read_csv(spark, p, schema=schemas[p], **o) for p, o in quoting.items() if p in schemas]
    undeclared = {p: o for p, o in quoting.items() if p not in schemas}
    if not one_pass:
        return dfs + [S.read_csv(spark, p, **o) for p, o in undeclared.items()]
    texts = [S.read_csv(spark, p, infer_schema=False, **o) for p, o in undeclared.items()]
    return dfs + ([S.with_common_types(R.union_common(*texts))] if texts else [])


def run_extract(spark: SparkSession, quoted: list[str], unquoted: list[str], dst: str | None = None,
                single_file: bool = False, keep: list[str] | None = None,
                schemas: dict[str, object] | None = None) -> DataFrame:
    """V7: read the yearly extracts, align on common columns, union, select/rename/recode, write."""
    unified = R.union_common(*read_extracts(spark, quoted, unquoted, schemas))
    out, _ = extract(unified, keep=keep)
    if dst:
        S.write_csv(out, dst, single_file=single_file)
    return out


# ---------------------------------------------------------------- imputation

def impute_by_age(df: DataFrame, age: str = "edad", range_col: str = "age_range",
                  drop_helper: bool = True, keys: list[str] = ("row_id",), observe: tuple | None = None) -> DataFrame:
    """C4 -> P8 -> I6 (-> drop helper): fill every answer with the mode of its age range.

    ``keys`` are pass-through identifiers (never imputed). The age-range key has a fixed,
    small domain (7 labels), so its lookup is broadcast. ``observe`` = (before, after)
    ``Observation`` objects receive the row counts around the P8 filter as a side effect of
    the first pass (A20 without an extra job).
    """
    ranged = C.band_closed(df, age, cb.AGE_RANGES, range_col)
    if observe:
        ranged = ranged.observe(observe[0], F.count(F.lit(1)).alias("filas"))
    kept = P.drop_incomplete_in_range(ranged, age, 0, 12)
    if observe:
        kept = kept.observe(observe[1], F.count(F.lit(1)).alias("filas"))
    exclude = [age] + [k for k in keys if k in df.columns]
    filled = I.impute_by_group_mode(kept, range_col, exclude=exclude)
    return filled.drop(range_col) if drop_helper else filled


def run_imputation(spark: SparkSession, src: str, dst: str | None = None, single_file: bool = False,
                   schema=None, audit: dict | None = None) -> DataFrame:
    """Read the filtered extract, impute by age range, write.

    With ``audit`` (a dict), rows read / kept / removed by the P8 filter are filled in from
    ``observe()`` metrics of the count pass: no extra job over the data.
    """
    from pyspark.sql import Observation

    df = S.read_csv(spark, src, schema=schema)
    obs = (Observation("leidos"), Observation("conservados")) if audit is not None else None
    out = impute_by_age(df, observe=obs)
    if dst:
        S.write_csv(out, dst, single_file=single_file)
    if obs:
        read, kept = obs[0].get["filas"], obs[1].get["filas"]
        audit.update({"leidos": read, "conservados": kept, "eliminados": read - kept})
    return out


# ---------------------------------------------------------------- analysis reports (V1-V5)

def null_report(df: DataFrame, age: str = "edad", cluster_col: str = "cluster_edad", k: int = 10) -> dict[str, DataFrame]:
    """V1: C3 -> A9 -> R2 (percent and count matrices) -> O2."""
    clustered = C.band(df, age, cb.AGE_CLUSTER_EDGES, cb.AGE_CLUSTER_LABELS, cb.AGE_CLUSTER_NULL, cluster_col)
    cols = [c for c in df.columns if c != cluster_col]
    return null_tables(A.null_rates_by(clustered, cluster_col, cols), cluster_col, k)


def null_tables(long: DataFrame, cluster_col: str = "cluster_edad", k: int = 10) -> dict[str, DataFrame]:
    """R2 (percent and count matrices) and O2 of the null rates by cluster."""
    labels = cb.AGE_CLUSTER_LABELS + [cb.AGE_CLUSTER_NULL]
    return {
        "resumen": long,
        "porcentaje": R.pivot_matrix(long, "columna", cluster_col, "porcentaje_nulos", labels),
        "cantidad": R.pivot_matrix(long, "columna", cluster_col, "nulos", labels),
        "top": R.top_missing(long, cluster_col, k),
    }


def occupation_numeric(df: DataFrame, target: str = "condicion_ocupacion", out: str = "condicion_ocupacion_num",
                       invert: str | None = "Experiencia") -> DataFrame:
    """C6 (+ C7): OCUPADO -> 1, DESOCUPADO -> 0; yes/no 1/2 -> 1/0."""
    out_df = C.map_values(df, target, {cb.EMPLOYED: 1, cb.NOT_EMPLOYED: 0}, out)
    if invert and invert in df.columns:
        out_df = C.map_values(out_df, invert, {1: 1, 2: 0})
    return out_df


def correlation_report(df: DataFrame, target: str = "condicion_ocupacion") -> dict[str, DataFrame]:
    """V2: C6, C7 -> A12 (numeric relevant columns) -> A13."""
    num = occupation_numeric(df, target)
    numeric, _ = P.split_by_type(num)
    cols = [c for c in numeric if c in cb.CORRELATION_FEATURES]
    return {
        "matriz": A.corr_matrix(num, cols),
        "objetivo": A.target_corr(num, "condicion_ocupacion_num", cols),
    }


def occupation_by_age(df: DataFrame, target: str = "condicion_ocupacion", age: str = "edad") -> DataFrame:
    """V3: P10 -> C5 -> A14 (percent of each condition within each age bin)."""
    known = P.filter_in(df, target, [cb.EMPLOYED, cb.NOT_EMPLOYED])
    binned = C.cut(known, age, cb.AGE_BIN_EDGES, cb.AGE_BIN_LABELS, "rango_edad")
    return A.crosstab_pct(binned, "rango_edad", target, [cb.NOT_EMPLOYED, cb.EMPLOYED])


def age_scatter(df: DataFrame, key: str = "row_id", n: int | None = None, seed: int = 42,
                target: str = "condicion_ocupacion", age: str = "edad", sigma: float = 0.1) -> DataFrame:
    """V4: points (age, jittered 0/1 label) of all rows, or of a reproducible sample of ``n`` (K2)."""
    known = P.filter_in(df, target, [cb.EMPLOYED, cb.NOT_EMPLOYED])
    pts = occupation_numeric(known, target, invert=None)
    if n is not None:
        pts = K.sample_n(pts, key, n, seed)
    return C.jitter(pts, "condicion_ocupacion_num", sigma, seed, "edad_jitter", key=key).select(
        key, age, "condicion_ocupacion_num", "edad_jitter")


def clustering(df: DataFrame, features: list[str] = cb.CLUSTER_FEATURES, k: int = 3, seed: int = 42,
               key: str | None = "row_id", points_cap: int | None = None, nulls: DataFrame | None = None) -> dict[str, DataFrame] | None:
    """M8: P2 -> (>= 2 features) -> A8 -> P9 -> (> 0 rows) -> M1 -> M2 -> M4 -> M6 -> M5, M7, V5.

    The cleaned input is checkpointed (shared storage) before the iterative fits. ``points_cap``
    samples the points (K1); by default all are returned. ``nulls``: the null rates of the features, where a caller has
    counted them already.
    Returns None when there are too few features or no complete rows.
    """
    feats = [f for f in features if f in df.columns]
    if len(feats) < 2:
        return None
    nulls = A.null_rates(df, feats, name_col="columna") if nulls is None else nulls
    ids = [key] if key and key in df.columns else []
    # only the key and the features are materialised for the iterative fits
    clean = reliable_checkpoint(P.drop_null(df.select(*ids, *feats), feats))
    if clean.isEmpty():
        return None
    assembled = M.assemble(clean, feats)
    _, scaled = M.scale_vector(assembled)
    km_model, pred = M.kmeans(scaled, "scaledFeatures", k, seed)
    pca_model, projected = M.pca(pred, "scaledFeatures", 2)
    details, profiles = M.cluster_profile(pred, "prediction", feats)
    pts = C.vector_elements(projected.select(*ids, "pcaFeatures", "prediction"),
                            "pcaFeatures", ["pca_x", "pca_y"], drop=True)
    if ids and points_cap is not None:
        pts = K.sample_cap(pts, key, points_cap, seed)
    return {
        "nulos": nulls,
        "centros": M.centers(df, km_model, feats),
        "predicciones": pred.drop("features", "scaledFeatures"),
        "varianza": M.explained_variance(df, pca_model),
        "detalles": details,
        "perfiles": profiles,
        "puntos": pts,
    }


run_clustering = clustering  # M8 name


def cluster_points(df: DataFrame, features: list[str] = cb.CLUSTER_FEATURES, k: int = 3, seed: int = 42,
                   key: str = "row_id", cap: int | None = None) -> DataFrame | None:
    """V5: 2-D PCA points (pca_x, pca_y, prediction) of all clustered rows, or of about ``cap`` of them (K1)."""
    res = clustering(df, features, k, seed, key, cap)
    return res["puntos"] if res else None


def profile_reports(df: DataFrame, target: str = "condicion_ocupacion", age: str = "edad", cluster_col: str = "cluster_edad",
                    features: list[str] = cb.CLUSTER_FEATURES, k: int = 10) -> dict[str, DataFrame]:
    """V1, V2, V3 and A8 from ONE scan of the table.

    A scan counts rows and missing values by (age cluster, age bin, condition) and gathers the moments of all column
    pairs; its few rows a task are checkpointed, and every report is a sum over them."""
    data = C.cut(C.band(df, age, cb.AGE_CLUSTER_EDGES, cb.AGE_CLUSTER_LABELS, cb.AGE_CLUSTER_NULL, cluster_col),
                 age, cb.AGE_BIN_EDGES, cb.AGE_BIN_LABELS, "rango_edad")
    num = occupation_numeric(df, target)
    numeric, _ = P.split_by_type(num)
    cols = [c for c in numeric if c in cb.CORRELATION_FEATURES]
    goal = "condicion_ocupacion_num"
    feats = [c for c in cols if c != goal]
    upper = A.matrix_pairs(cols)
    # the recoded columns stand beside the given ones, under names of their own
    recoded = {c: f"_num_{c}" for c in {*cols, goal}}
    wide = data.withColumn("_given", F.struct(*df.columns))
    wide = occupation_numeric(wide, target).withColumns({n: F.col(c) for c, n in recoded.items()})
    wide = wide.select(*[F.col(f"_given.{c}").alias(c) for c in df.columns], cluster_col, "rango_edad", *recoded.values())
    keys, missing = [cluster_col, "rango_edad", target], [c for c in df.columns if c != cluster_col]
    pairs = [(recoded[a], recoded[b]) for a, b in [*upper, *[(c, goal) for c in feats]]]
    blocks = reliable_checkpoint(MO.profile_blocks(wide.withColumn("_target", F.col(target)), [cluster_col, "rango_edad", "_target"], missing, pairs))

    counts = MO.profile_counts(blocks, keys[:2] + ["_condicion"], missing, "_filas")
    sums = [F.sum(f"{c}_nulos").alias(c) for c in missing]
    out = {f"nulos_{n}": t for n, t in null_tables(
        A.null_rates_from(counts.groupBy(cluster_col).agg(F.sum("_filas").alias("total_registros"), *sums), cluster_col, missing), cluster_col, k).items()}
    r = MO.correlations(MO.merged_moments(blocks.filter(F.col("_kind") == "moments")))
    out["corr_matriz"] = A.matrix_from_pairs(r, cols)
    out["corr_objetivo"] = A.target_from_pairs(r, goal, feats, len(upper))
    known = P.filter_in(counts.withColumnRenamed("_condicion", "_c"), "_c", [cb.EMPLOYED, cb.NOT_EMPLOYED]).filter(F.col("rango_edad").isNotNull())
    cells = known.groupBy("rango_edad", F.col("_c").alias("_cond")).agg(F.sum("_filas").alias("_n"))
    out["ocupacion_por_edad"] = A.crosstab_from_counts(cells, "rango_edad", "_cond", [cb.NOT_EMPLOYED, cb.EMPLOYED])
    present = [f for f in features if f in df.columns]
    if present:
        total = counts.agg(F.coalesce(F.sum("_filas"), F.lit(0)).alias("_total"), *[F.coalesce(F.sum(f"{c}_nulos"), F.lit(0)).alias(c) for c in present])
        out["nulos_rasgos"] = A.null_rates_of(total, present)
    return out


def run_analysis(df: DataFrame) -> dict[str, DataFrame]:
    """V8: V1 -> V2 -> V3 -> M8 over un-imputed data (all report tables). All reports that need no iteration come from
    one scan (``profile_reports``); clustering reads its complete rows on its own."""
    out = profile_reports(df)
    nulls = out.pop("nulos_rasgos", None)
    cl = clustering(df, nulls=nulls)
    if cl:
        out.update({f"cluster_{k}": v for k, v in cl.items()})
    return out


# ---------------------------------------------------------------- training (M16), audit

def run_training(df: DataFrame, target: str = cb.TARGET, key: str = "row_id", numeric: list[str] | None = None,
                 categorical: list[str] | None = None, num_trees=(20, 50), max_depth=(5, 10), folds: int = 5,
                 seed: int = 42, stratified: bool = False, unknown: str = "keep", scale_numeric: bool = False,
                 parallelism: int = 2, model_path: str | None = None, report_path: str | None = None,
                 invalid: str = "error", rf_params: dict | None = None) -> dict:
    """P6 -> P11/P13 -> K3/K4 -> M9..M14 -> M15 -> S6 -> S7.

    ``stratified`` + ``unknown="ignore"`` + ``scale_numeric`` gives the second (scikit-style)
    training flavour; defaults give the Spark-ML flavour. Folds come from K5. "grid" is the table of mean accuracies
    by grid point, "params" the best point, "metrics" the hold-out metrics of the model fitted with it.
    """
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    labelled = P.filter_not_null(df, target)
    if numeric is None and categorical is None:
        numeric, categorical = P.split_by_type(labelled.drop(key) if key in labelled.columns else labelled, target)
    else:
        numeric, _ = P.resolve_names(labelled, numeric or [])
        categorical, _ = P.resolve_names(labelled, categorical or [])
    if not numeric and not categorical:
        raise ValueError("no usable feature columns")
    labelled = labelled.select(*[c for c in [key] if c in labelled.columns], *numeric, *categorical, target)
    if stratified:
        train, test = K.stratified_split(labelled, key, target, 0.8, seed)
    else:
        train, test = K.split(labelled, key, [0.8, 0.2], seed)
    train = reliable_checkpoint(K.assign_folds(train, key, folds, seed, label=target if stratified else None))
    pipe, rf = M.classifier_pipeline(target, numeric, categorical, seed, unknown, scale_numeric, invalid, count_rows=True, **(rf_params or {}))
    cv = M.grid_search(pipe, rf, list(num_trees), list(max_depth), "fold", folds, parallelism, seed)
    cv_model = cv.fit(train)
    best = cv_model.bestModel
    metrics = M.evaluate(best, test, target)
    if report_path:
        S.write_report(metrics, report_path, "json")
    if model_path:
        save_model(best, model_path)
    return {"model": best, "metrics": metrics, "params": M.best_params(cv_model), "test": test,
            "grid": M.grid_table(df.sparkSession, cv_model)}


def score_answers(model, answers: DataFrame, numeric: list[str] = cb.MODEL_NUMERIC) -> dict[str, DataFrame]:
    """C11 -> C12 -> M17: answer records with labels and texts, encoded and scored.

    "scored": records whose answers are all valid, with label and ``p_<class>``. "rejected": the others, as
    given, with the fields that were not valid (an unknown label, a number that is not one or is missing)."""
    raw = answers.withColumn("_raw", F.struct("*"))
    coded = C.encode_answers(raw, cb.ANSWER_DICTIONARIES, int_fields=numeric)
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in numeric if c in answers.columns]),
                       lambda x: x.isNotNull())
    coded = coded.withColumn("errores", F.array_sort(F.array_union("errores", missing)))
    return {
        "scored": M.score(model, coded.filter(F.size("errores") == 0).drop("errores", "_raw")),
        "rejected": coded.filter(F.size("errores") > 0).select("_raw.*", "errores"),
    }


def run_audit(model, df: DataFrame, target: str = cb.TARGET) -> dict[str, DataFrame]:
    """Score all labelled rows and build the audit tables."""
    scored = M.score(model, P.filter_not_null(df, target))
    return audit_tables(scored, target, "prediccion")


def save_reports(reports: dict[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """S6 for a whole job: write every report table of ``reports`` under ``root/<name>``.

    Each table is written by the executors (no driver-side files); returns name -> path.
    """
    paths = {}
    for name, df in reports.items():
        paths[name] = S.write_report(df, f"{root.rstrip('/')}/{name}", fmt)
    return paths


def metrics_lines(metrics: DataFrame) -> DataFrame:
    """S6 + C13: the one-row metrics table as text lines (line_no, linea), ready for write.text."""
    entries = [F.struct(F.lit(i).alias("line_no"), F.format_string(fmt_, F.round(F.col(c), 4)).alias("linea"))
               for i, (c, fmt_) in enumerate(cb.METRIC_LINES)]
    return metrics.select(F.inline(F.array(*entries)))


def _title_lines(df: DataFrame, lines: list[str]) -> DataFrame:
    entries = [F.struct(F.lit(i).alias("line_no"), F.lit(t).alias("linea")) for i, t in enumerate(lines)]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def null_rate_lines(null_rates: DataFrame, order: list[str]) -> DataFrame:
    """S6 + C13: two title lines, then a "column: 12.34%" line per column, in the given column order."""
    pos = C.lookup_map({c: i + len(cb.NULL_RATE_TITLE) for i, c in enumerate(order)})
    rows = null_rates.select(F.element_at(pos, F.col("columna")).alias("line_no"),
                             F.format_string(cb.NULL_RATE_LINE, F.col("columna"),
                                             F.round("porcentaje_nulos", 2)).alias("linea"))
    return _title_lines(null_rates, cb.NULL_RATE_TITLE).unionByName(rows)


def audit_lines(tables: dict[str, DataFrame], y: str, pred: str) -> DataFrame:
    """S6 + C13 for the audit tables: (section, item, line_no, linea), to be sorted by the first three and written as text.

    Sections: 0 global metrics, 1 confusion matrix (a line per true class), 2 counts per class, 3 report,
    4 and 5 the shares of the true and the predicted classes. Everything stays in Spark."""
    def section(rows: DataFrame, number: int, item, *lines) -> DataFrame:
        entries = [F.struct(F.lit(i).alias("line_no"), line.alias("linea")) for i, line in enumerate(lines)]
        return rows.select(F.lit(number).alias("section"), item.cast("string").alias("item"), F.inline(F.array(*entries)))

    def num(c: str):
        return F.round(F.col(c), 4)

    metrics = tables["metricas"]
    parts = [section(metrics, 0, F.lit(""), *[F.format_string(f, num(c)) for c, f in cb.METRIC_LINES])]
    cells = F.transform(F.array_sort(F.collect_list(F.struct("pred", "n"))), lambda s: s["n"].cast("string"))
    parts.append(section(tables["matriz"].groupBy("y").agg(F.array_join(cells, " ").alias("fila")), 1, F.col("y"),
                         F.format_string(cb.AUDIT_MATRIX_LINE, F.col("y"), F.col("fila"))))
    parts.append(section(tables["por_clase"], 2, F.col("clase"), F.format_string(cb.AUDIT_CLASS_LINE, F.col("clase")),
                         *[F.format_string(f, F.col(c)) for c, f in cb.AUDIT_COUNT_LINES]))
    parts.append(section(tables["reporte"], 3, F.col("etiqueta"), F.format_string(
        cb.AUDIT_REPORT_LINE, F.col("etiqueta"), *[F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.format_string("%.4f", num(c))) for c in ("precision", "recall", "f1_score")],
        F.col("support"))))
    for number, name, col in ((4, "dist_real", y), (5, "dist_pred", pred)):
        parts.append(section(tables[name], number, F.col(col), F.format_string(cb.AUDIT_SHARE_LINE, F.col(col), F.round("pct", 2))))
    return reduce(DataFrame.unionByName, parts)


def analysis_long(reports: dict[str, DataFrame]) -> DataFrame:
    """V8 as one long table (tabla, clave, columna, valor) over the reports that do not depend on cluster labels."""
    keys = {"nulos_porcentaje": "columna", "nulos_cantidad": "columna", "corr_objetivo": "variable",
            "ocupacion_por_edad": "rango_edad", "cluster_nulos": "columna"}
    parts = []
    for name, key in keys.items():
        if name in reports:
            values = [c for c in reports[name].columns if c != key]
            df = reports[name].select(F.col(key).alias("clave"), *[F.col(c).cast("double").alias(c) for c in values])
            parts.append(df.unpivot("clave", values, "columna", "valor").withColumn("tabla", F.lit(name)))
    if "corr_matriz" in reports:
        m = reports["corr_matriz"].select(F.col("var_a").alias("clave"), F.col("var_b").alias("columna"), F.col("r").alias("valor"))
        parts.append(m.withColumn("tabla", F.lit("corr_matriz")))
    return reduce(DataFrame.unionByName, [p.select("tabla", "clave", "columna", "valor") for p in parts])


def profile_lines(details: DataFrame, profiles: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """S6 + C13 + M7: the cluster interpretation report as ordered text lines.

    Returns (cluster, line_no, linea): a title block (cluster NULL), then per cluster its
    header, profile sentence, a details header and one line per feature. Write with
    ``write_report(lines.orderBy(...).select("linea"), path, "text")``; everything stays in
    Spark (one row per cluster and feature).
    """
    spark = details.sparkSession
    title = spark.createDataFrame([(None, i, t) for i, t in enumerate(cb.PROFILE_TITLE)],
                                  f"{cluster_col} int, line_no int, linea string")
    head = profiles.select(F.col(cluster_col).cast("int").alias(cluster_col), F.inline(F.array(
        F.struct(F.lit(0).alias("line_no"), F.format_string(cb.PROFILE_CLUSTER_LINE, F.col(cluster_col)).alias("linea")),
        F.struct(F.lit(1).alias("line_no"), F.format_string(cb.PROFILE_TEXT_LINE, F.col("perfil")).alias("linea")),
        F.struct(F.lit(2).alias("line_no"), F.lit(cb.PROFILE_DETAILS_LINE).alias("linea")))))
    feats = details.select(
        F.col(cluster_col).cast("int").alias(cluster_col), (F.col("position") + 3).cast("int").alias("line_no"),
        F.format_string(cb.PROFILE_FEATURE_LINE, F.col("feature"), F.round("media_cluster", 2),
                        F.round("media_global", 2)).alias("linea"))
    return title.unionByName(head).unionByName(feats)


def audit_tables(scored: DataFrame, y: str, pred: str) -> dict[str, DataFrame]:
    """All audit tables from ONE pass over the scored rows (a checkpointed k*k count)."""
    counts = MT.pair_counts(scored, y, pred)
    cells = MT.known_pairs(counts)
    real = counts.groupBy(F.col("y").alias(y)).agg(F.sum("n").alias("n"))
    predicted = counts.groupBy(F.col("pred").alias(pred)).agg(F.sum("n").alias("n"))
    return {
        "metricas": MT.weighted_from_confusion(cells),
        "matriz": MT.confusion_from_counts(counts),
        "por_clase": MT.audit_series_from_counts(counts),
        "reporte": MT.report_from_confusion(cells),
        "dist_real": real.withColumn("pct", F.col("n") * 100.0 / real.agg(F.sum("n")).scalar()),
        "dist_pred": predicted.withColumn("pct", F.col("n") * 100.0 / predicted.agg(F.sum("n")).scalar()),
    }
