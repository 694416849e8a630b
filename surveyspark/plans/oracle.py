"""ANSI-SQL oracles (DuckDB dialect) for the registered queries.

Each string reads only the pre-registered tables and re-derives the same answer
independently of the Spark code. Doubles are rounded to 6 decimals, counts are BIGINT.
Queries with random or model-dependent output are either checked against a planted
answer or omitted (rows-only check).
"""

from __future__ import annotations

SURVEY = """survey AS (
SELECT o_orderkey AS row_id,
 CAST(o_orderkey % 3 AS INT) AS src,
 CAST(2019 + o_orderkey % 5 AS INT) AS ANIO,
 CAST(1 + o_orderkey % 12 AS INT) AS MES,
 CAST(1 + o_custkey % 25 AS INT) AS REGION,
 CAST(CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE 1 + o_custkey % 5 END AS INT) AS ESTRATO,
 CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL
           WHEN (o_orderkey * 7919) % 100 < 53 THEN 1
           WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 + o_orderkey % 4 END AS INT) AS OCUP300,
 CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice END AS DOUBLE) AS INGTOT,
 CAST(1 + o_custkey % 2 AS INT) AS C207,
 CAST(CASE WHEN o_orderkey % 141 = 0 THEN NULL ELSE (o_orderkey * 31 + o_custkey * 17) % 98 END AS INT) AS C208,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL ELSE 1 + (o_orderkey * 3 + o_custkey) % 12 END AS INT) AS C366,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL ELSE (o_orderkey + o_custkey) % 19 END AS INT) AS C366_1,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL WHEN o_custkey % 10 < 7 THEN 10 ELSE 1 + o_custkey % 14 END AS INT) AS C376,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL ELSE 1 + (o_custkey + o_orderkey) % 9 END AS INT) AS C377,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL WHEN o_orderkey % 17 = 0 THEN 1 ELSE 2 END AS INT) AS C375_5,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL WHEN o_orderkey % 19 = 0 THEN 1 ELSE 2 END AS INT) AS C375_6,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL WHEN o_custkey % 11 = 0 THEN 2 ELSE 1 END AS INT) AS C359,
 CAST(CASE WHEN (o_orderkey * 13) % 100 < 29 THEN NULL WHEN o_orderkey % 23 = 0 THEN 1 ELSE 2 END AS INT) AS C375_1
FROM orders)"""

EXT = """ext AS (
SELECT row_id,
 CASE WHEN OCUP300 = 1 THEN 'OCUPADO' WHEN OCUP300 IN (0, 2, 3, 4) THEN 'DESOCUPADO'
      ELSE CAST(OCUP300 AS VARCHAR) END AS condicion_ocupacion,
 C207 AS sexo, C208 AS edad, C366 AS nivel_educativo_cod, C376 AS Lengua, C377 AS Etnia,
 C375_5 AS Concentracion, C375_6 AS Socializar, C375_1 AS Movilidad, C359 AS Experiencia
FROM survey)"""

WIDE = """wide AS (
SELECT row_id, ANIO AS anio, MES AS mes, REGION AS region, ESTRATO AS estrato, OCUP300 AS ocupado,
 INGTOT AS ingreso_total, C207 AS sexo, C208 AS edad, C366 AS nivel_educativo, C366_1 AS anios_educacion
FROM survey)"""

PHASE2 = """p2 AS (
SELECT row_id, ESTRATO AS estrato, OCUP300 AS condicion_ocupacion, INGTOT AS ingreso_total, C207 AS sexo,
 C208 AS edad, C366 AS nivel_educativo_cod, C366_1 AS anios_educacion
FROM survey)"""

AGE_RANGE_CASE = """CASE WHEN edad IS NULL THEN NULL
 WHEN edad >= 13 AND edad <= 17 THEN '13-17' WHEN edad >= 18 AND edad <= 24 THEN '18-24'
 WHEN edad >= 25 AND edad <= 34 THEN '25-34' WHEN edad >= 35 AND edad <= 44 THEN '35-44'
 WHEN edad >= 45 AND edad <= 54 THEN '45-54' WHEN edad >= 55 AND edad <= 64 THEN '55-64'
 WHEN edad >= 65 THEN '65+' ELSE NULL END"""

AGE_CLUSTER_CASE = """CASE WHEN edad IS NULL THEN 'Sin Edad' WHEN edad < 5 THEN '0-4 años'
 WHEN edad < 13 THEN '5-12 años' WHEN edad < 18 THEN '13-17 años' WHEN edad < 25 THEN '18-24 años'
 WHEN edad < 35 THEN '25-34 años' WHEN edad < 45 THEN '35-44 años' WHEN edad < 55 THEN '45-54 años'
 WHEN edad < 65 THEN '55-64 años' ELSE '65+ años' END"""

AGE_BIN_CASE = """CASE WHEN edad >= 0 AND edad < 5 THEN '0-4' WHEN edad >= 5 AND edad < 13 THEN '5-12'
 WHEN edad >= 13 AND edad < 18 THEN '13-17' WHEN edad >= 18 AND edad < 25 THEN '18-24'
 WHEN edad >= 25 AND edad < 35 THEN '25-34' WHEN edad >= 35 AND edad < 45 THEN '35-44'
 WHEN edad >= 45 AND edad < 55 THEN '45-54' WHEN edad >= 55 AND edad < 65 THEN '55-64'
 WHEN edad >= 65 AND edad < 100 THEN '65+' ELSE NULL END"""

EXT_COLS = ["row_id", "condicion_ocupacion", "sexo", "edad", "nivel_educativo_cod", "Lengua", "Etnia",
            "Concentracion", "Socializar", "Movilidad", "Experiencia"]
IMPUTE_COLS = ["condicion_ocupacion", "sexo", "nivel_educativo_cod", "Lengua", "Etnia", "Concentracion",
               "Socializar", "Movilidad", "Experiencia"]
# written out here, so that a wrong code book in the engine shows
FEATS = ["edad", "nivel_educativo_cod", "Lengua", "Etnia", "Concentracion", "Socializar", "Experiencia", "Movilidad"]
AGE_LABELS = ["0-4 años", "5-12 años", "13-17 años", "18-24 años", "25-34 años", "35-44 años", "45-54 años", "55-64 años",
              "65+ años", "Sin Edad"]
AVERAGE_TEXT = "Valores promedio en todas las variables."
PROFILE_TITLE = ["INTERPRETACIÓN DE CLUSTERS (K-Means)", "====================================", ""]

RANGED = f"ranged AS (SELECT *, {AGE_RANGE_CASE} AS age_range FROM ext)"
KEPT = ("kept AS (SELECT * FROM ranged WHERE NOT ((edad >= 0 AND edad <= 12) AND ("
        + " OR ".join(f"{c} IS NULL" for c in EXT_COLS + ["age_range"]) + ")))")
CLEAN = "clean AS (SELECT * FROM ext WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATS) + ")"
SCORED = ("scored AS (SELECT row_id, condicion_ocupacion AS y, CASE WHEN edad >= 40 THEN 'OCUPADO' "
          "ELSE 'DESOCUPADO' END AS pred FROM ext WHERE condicion_ocupacion IS NOT NULL)")
PLANTED = ("planted AS (SELECT row_id, CASE WHEN edad >= 40 THEN 'OCUPADO' ELSE 'DESOCUPADO' END AS y "
           "FROM ext WHERE edad IS NOT NULL)")
OCC_NUM = ("occnum AS (SELECT *, CASE WHEN condicion_ocupacion = 'OCUPADO' THEN 1 "
           "WHEN condicion_ocupacion = 'DESOCUPADO' THEN 0 ELSE NULL END AS condicion_ocupacion_num, "
           "CASE WHEN Experiencia = 1 THEN 1 WHEN Experiencia = 2 THEN 0 ELSE NULL END AS Experiencia_inv FROM ext)")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _r(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def _hash(key: str = "row_id", seed: int = 42) -> str:
    return f"substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)"


def _mode_expr(src: str, c: str) -> str:
    return f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _group_mode_cte(src: str, g: str, c: str, name: str) -> str:
    return (f"{name} AS (SELECT g, v FROM (SELECT {g} AS g, {c} AS v, row_number() OVER "
            f"(PARTITION BY {g} ORDER BY count(*) DESC, {c}) AS rn FROM {src} "
            f"WHERE {g} IS NOT NULL AND {c} IS NOT NULL GROUP BY {g}, {c}) t WHERE rn = 1)")


def _group_modes(src: str, g: str, cols: list[str]) -> tuple[list[str], str]:
    ctes = [_group_mode_cte(src, g, c, f"gm_{i}") for i, c in enumerate(cols)]
    sel = (f"SELECT k.{g}, " + ", ".join(f"gm_{i}.v AS {c}" for i, c in enumerate(cols))
           + f" FROM (SELECT DISTINCT {g} FROM {src} WHERE {g} IS NOT NULL) k "
           + " ".join(f"LEFT JOIN gm_{i} ON gm_{i}.g = k.{g}" for i in range(len(cols))))
    return ctes, sel


def _null_rates(src: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS columna, {_r(f'100.0 * count_if({c} IS NULL) / count(*)', 'porcentaje_nulos')} FROM {src}"
             for c in cols]
    return "\nUNION ALL\n".join(parts)


def _null_by_cluster_cte() -> str:
    cols = EXT_COLS
    parts = [f"SELECT '{c}' AS columna, cluster_edad, count(*) AS total_registros, CAST(count_if({c} IS NULL) AS BIGINT) AS nulos "
             f"FROM clustered GROUP BY cluster_edad" for c in cols]
    return ("clustered AS (SELECT *, " + AGE_CLUSTER_CASE + " AS cluster_edad FROM ext),\n"
            "nb AS (" + "\nUNION ALL\n".join(parts) + "),\n"
            "nbp AS (SELECT columna, cluster_edad, total_registros, nulos, "
            "100.0 * nulos / total_registros AS porcentaje_nulos FROM nb)")


def _corr(a: str, b: str, src: str) -> str:
    m = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"(SELECT covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) / "
            f"NULLIF(stddev_pop(CASE WHEN {m} THEN CAST({a} AS DOUBLE) END) * "
            f"stddev_pop(CASE WHEN {m} THEN CAST({b} AS DOUBLE) END), 0) FROM {src})")


def _corr_matrix(src: str, cols: list[str], names: dict[str, str] | None = None) -> str:
    names = names or {}
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{names.get(a, a)}' AS var_a, '{names.get(b, b)}' AS var_b, "
                         f"round({_corr(a, b, src)}, 6) AS r")
    return "\nUNION ALL\n".join(parts)


CORR_COLS = ["sexo", "edad", "nivel_educativo_cod", "Lengua", "Etnia", "Concentracion", "Socializar",
             "Movilidad", "Experiencia_inv", "condicion_ocupacion_num"]
CORR_NAMES = {"Experiencia_inv": "Experiencia"}


def _confusion_cte() -> str:
    return (SCORED + ",\ncls AS (SELECT y AS c FROM scored UNION SELECT pred FROM scored),\n"
            "cnt AS (SELECT y, pred, count(*) AS n FROM scored GROUP BY y, pred),\n"
            "cm AS (SELECT a.c AS y, b.c AS pred, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n FROM cls a CROSS JOIN cls b "
            "LEFT JOIN cnt ON cnt.y = a.c AND cnt.pred = b.c),\n"
            "cc AS (SELECT c AS clase, (SELECT sum(n) FROM cm WHERE y = c AND pred = c) AS tp, "
            "(SELECT sum(n) FROM cm WHERE pred = c) - (SELECT sum(n) FROM cm WHERE y = c AND pred = c) AS fp, "
            "(SELECT sum(n) FROM cm WHERE y = c) - (SELECT sum(n) FROM cm WHERE y = c AND pred = c) AS fn, "
            "(SELECT sum(n) FROM cm) - (SELECT sum(n) FROM cm WHERE y = c) - (SELECT sum(n) FROM cm WHERE pred = c) "
            "+ (SELECT sum(n) FROM cm WHERE y = c AND pred = c) AS tn FROM cls),\n"
            "pc AS (SELECT clase, tp, fp, fn, tn, "
            "coalesce(tp * 1.0 / NULLIF(tp + fp, 0), 0.0) AS precision, "
            "coalesce(tp * 1.0 / NULLIF(tp + fn, 0), 0.0) AS recall, tp + fn AS support FROM cc),\n"
            "pcf AS (SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1_score FROM pc)")


def _planted_audit_cte() -> str:
    return (PLANTED + ",\ncls AS (SELECT DISTINCT y AS c FROM planted),\n"
            "cc AS (SELECT c AS clase, (SELECT count(*) FROM planted WHERE y = c) AS tp, 0 AS fp, 0 AS fn, "
            "(SELECT count(*) FROM planted WHERE y <> c) AS tn FROM cls)")


def _impute_group_mode_sql() -> str:
    # I6 on the P8-filtered extract with age ranges
    ctes = [SURVEY, EXT, RANGED, KEPT]
    gm = [_group_mode_cte("kept", "age_range", c, f"gm_{i}") for i, c in enumerate(IMPUTE_COLS)]
    sel = ["kept.row_id", "kept.edad", "kept.age_range"]
    for i, c in enumerate(IMPUTE_COLS):
        sel.append(f"coalesce(kept.{c}, gm_{i}.v, {_mode_expr('kept', c)}) AS {c}")
    joins = " ".join(f"LEFT JOIN gm_{i} ON gm_{i}.g = kept.age_range" for i in range(len(IMPUTE_COLS)))
    return _with(*ctes, *gm) + "SELECT " + ", ".join(sel) + " FROM kept " + joins


def _phase2_sql() -> str:
    med = "(SELECT CAST(quantile_disc(estrato, 0.5) AS DOUBLE) FROM p2)"
    s1 = f"s1 AS (SELECT * REPLACE (coalesce(CAST(estrato AS DOUBLE), {med}) AS estrato) FROM p2)"
    s2 = f"s2 AS (SELECT * REPLACE (coalesce(condicion_ocupacion, {_mode_expr('s1', 'condicion_ocupacion')}) AS condicion_ocupacion) FROM s1)"
    meds = ("meds AS (SELECT sexo, estrato, CAST(quantile_disc(ingreso_total, 0.5) AS DOUBLE) AS med FROM s2 "
            "WHERE ingreso_total IS NOT NULL AND edad >= 13 AND condicion_ocupacion = 1 GROUP BY sexo, estrato)")
    s3 = ("s3 AS (SELECT s2.* REPLACE (CASE WHEN (s2.edad < 13 OR s2.condicion_ocupacion <> 1) THEN NULL "
          "WHEN s2.ingreso_total IS NULL AND s2.edad >= 13 AND s2.condicion_ocupacion = 1 THEN meds.med "
          "ELSE s2.ingreso_total END AS ingreso_total) FROM s2 LEFT JOIN meds ON meds.sexo = s2.sexo AND meds.estrato = s2.estrato)")
    s4 = (f"s4 AS (SELECT * REPLACE (coalesce(nivel_educativo_cod, {_mode_expr('s3', 'nivel_educativo_cod')}) AS nivel_educativo_cod, "
          f"coalesce(anios_educacion, {_mode_expr('s3', 'anios_educacion')}) AS anios_educacion) FROM s3)")
    return (_with(SURVEY, PHASE2, s1, s2, meds, s3, s4)
            + "SELECT row_id, round(estrato, 6) AS estrato, CASE WHEN condicion_ocupacion = 1 THEN 'Ocupado' "
              "ELSE 'Desocupado' END AS condicion_ocupacion, round(ingreso_total, 6) AS ingreso_total, sexo, edad, "
              "nivel_educativo_cod, anios_educacion FROM s4")


def _profile_cte() -> str:
    g = "g AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in FEATS) + " FROM clean)"
    per = "per AS (SELECT sexo AS cluster, " + ", ".join(f"avg({c}) AS {c}" for c in FEATS) + " FROM clean GROUP BY sexo)"
    long = "lng AS (" + "\nUNION ALL\n".join(
        f"SELECT per.cluster, '{c}' AS feature, {i} AS position, per.{c} AS media_cluster, g.{c} AS media_global FROM per, g"
        for i, c in enumerate(FEATS)) + ")"
    dev = ("dev AS (SELECT *, CASE WHEN media_global <> 0 THEN (media_cluster - media_global) / abs(media_global) * 100.0 "
           "ELSE 0.0 END AS desviacion_pct FROM lng)")
    lab = ("lab AS (SELECT *, CASE WHEN desviacion_pct > 10.0 THEN feature || ' ALTO (' || printf('%+.1f', round(desviacion_pct, 1)) || '%)' "
           "WHEN desviacion_pct < -10.0 THEN feature || ' BAJO (' || printf('%.1f', round(desviacion_pct, 1)) || '%)' "
           "ELSE NULL END AS etiqueta FROM dev)")
    return ",\n".join([CLEAN, g, per, long, dev, lab])


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    ext_all = _with(SURVEY, EXT) + "SELECT * FROM ext"
    q["csv_quoted_roundtrip"] = ext_all
    q["csv_unquoted_roundtrip"] = ext_all
    q["csv_schema_read"] = ext_all
    q["resolve_source_glob"] = ext_all
    q["report_roundtrip"] = _with(SURVEY, EXT) + _null_rates("ext", FEATS)
    q["model_save_load"] = _with(SURVEY, EXT, PLANTED) + "SELECT row_id, y, y AS prediccion FROM planted"
    q["extract_recode"] = ext_all
    q["align_union_extracts"] = (_with(SURVEY) + "SELECT ANIO, C207, C208, C359, C366, C366_1, C375_1, C375_5, C375_6, "
                                 "C376, C377, CAST(ESTRATO AS VARCHAR) AS ESTRATO, round(INGTOT, 6) AS INGTOT, OCUP300, row_id, src FROM survey")
    q["wide_select_rename"] = (_with(SURVEY, WIDE) + "SELECT * REPLACE (round(ingreso_total, 6) AS ingreso_total) FROM wide")
    q["not_null_target"] = _with(SURVEY, EXT) + "SELECT row_id, condicion_ocupacion FROM ext WHERE condicion_ocupacion IS NOT NULL"
    q["eligible_earners"] = (_with(SURVEY, WIDE) + "SELECT row_id, sexo, estrato, round(ingreso_total, 6) AS ingreso_total FROM wide "
                             "WHERE ingreso_total IS NOT NULL AND edad >= 13 AND ocupado = 1")
    q["drop_incomplete_children"] = _with(SURVEY, EXT, RANGED, KEPT) + "SELECT row_id, edad, age_range FROM kept"
    q["drop_null_features"] = _with(SURVEY, EXT, CLEAN) + "SELECT row_id, " + ", ".join(FEATS) + " FROM clean"
    q["known_classes"] = (_with(SURVEY, EXT) + "SELECT row_id, condicion_ocupacion FROM ext "
                          "WHERE condicion_ocupacion IN ('OCUPADO', 'DESOCUPADO')")
    kinds = [("sexo", 1), ("edad", 2), ("nivel_educativo_cod", 3), ("Lengua", 4), ("Etnia", 5),
             ("Concentracion", 6), ("Socializar", 7), ("Movilidad", 8), ("Experiencia", 9)]
    q["column_kinds"] = (_with(SURVEY, EXT) + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", 'numeric' AS kind, {i} AS position, count({c}) AS known FROM ext"
        for c, i in kinds))
    q["features_target"] = (_with(SURVEY, EXT) + "SELECT edad, sexo, nivel_educativo_cod, Lengua, Etnia, Concentracion, "
                            "Socializar, Experiencia, Movilidad, condicion_ocupacion FROM ext")
    q["recode_binary"] = (_with(SURVEY) + "SELECT row_id, CASE WHEN OCUP300 = 1 THEN 'Ocupado' ELSE 'Desocupado' END "
                          "AS condicion_ocupacion FROM survey")
    q["age_clusters"] = _with(SURVEY, EXT) + f"SELECT row_id, edad, {AGE_CLUSTER_CASE} AS cluster_edad FROM ext"
    q["age_ranges"] = _with(SURVEY, EXT) + f"SELECT row_id, edad, {AGE_RANGE_CASE} AS age_range FROM ext"
    q["age_bins"] = _with(SURVEY, EXT) + f"SELECT row_id, edad, {AGE_BIN_CASE} AS rango_edad FROM ext"
    q["label_numbers"] = (_with(SURVEY, EXT, OCC_NUM) + "SELECT row_id, condicion_ocupacion_num, Experiencia_inv AS Experiencia FROM occnum")
    q["missing_rates_documents"] = (_with("dl AS (SELECT d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d "
                                          "LEFT JOIN labels l ON l.doc_id = d.doc_id)")
                                    + _null_rates("dl", ["lang", "source", "n_chars", "quality", "toxic"]))
    q["encode_answers"] = (_with(SURVEY, EXT) + "SELECT row_id, condicion_ocupacion, sexo, edad, nivel_educativo_cod, "
                           "Lengua, Etnia, Concentracion, Socializar, Movilidad, Experiencia, 0 AS n_errores FROM ext")
    q["vector_elements"] = (_with(SURVEY, EXT, CLEAN) + "SELECT row_id, CAST(edad AS DOUBLE) AS v0, CAST(sexo AS DOUBLE) AS v1 FROM clean")
    q["age_scatter_sample"] = (_with(SURVEY, EXT) + "SELECT row_id, edad, CASE WHEN condicion_ocupacion = 'OCUPADO' THEN 1 ELSE 0 END "
                               "AS condicion_ocupacion_num FROM ext WHERE condicion_ocupacion IN ('OCUPADO', 'DESOCUPADO')")
    u = ("((('0x' || substr(md5(CAST(row_id AS VARCHAR) || ':42'), {p}, 8))::BIGINT + 0.5) / 4294967296.0)")
    normal = f"(sqrt(-2.0 * ln({u.format(p=1)})) * cos(2.0 * pi() * {u.format(p=9)}))"
    q["age_scatter_jitter"] = (
        _with(SURVEY, EXT, "s AS (SELECT row_id, edad, CASE WHEN condicion_ocupacion = 'OCUPADO' THEN 1 ELSE 0 END "
                           "AS condicion_ocupacion_num FROM ext WHERE condicion_ocupacion IN ('OCUPADO', 'DESOCUPADO'))")
        + f"SELECT row_id, edad, condicion_ocupacion_num, round(condicion_ocupacion_num + 0.1 * {normal}, 6) AS edad_jitter FROM s")
    # aggregates
    q["row_count"] = "SELECT count(*) AS n FROM orders"
    q["distinct_pairs"] = _with(SURVEY, WIDE) + "SELECT DISTINCT sexo, estrato FROM wide"
    q["value_counts"] = (_with(SURVEY, EXT) + "SELECT condicion_ocupacion, count(*) AS n, "
                         "round(count(*) * 100.0 / (SELECT count(*) FROM ext WHERE condicion_ocupacion IS NOT NULL), 6) AS pct "
                         "FROM ext WHERE condicion_ocupacion IS NOT NULL GROUP BY condicion_ocupacion")
    q["global_mode"] = _with(SURVEY, EXT) + "SELECT " + ", ".join(f"{_mode_expr('ext', c)} AS {c}" for c in IMPUTE_COLS)
    ctes, sel = _group_modes("ranged", "age_range", IMPUTE_COLS)
    q["group_mode"] = _with(SURVEY, EXT, RANGED, *ctes) + sel
    ctes, sel = _group_modes("dl", "lang", ["source", "quality", "toxic"])
    q["group_mode_documents"] = (_with("dl AS (SELECT d.lang, d.source, l.quality, l.toxic FROM documents d "
                                       "LEFT JOIN labels l ON l.doc_id = d.doc_id)", *ctes) + sel)
    q["global_median"] = _with(SURVEY, WIDE) + "SELECT CAST(quantile_disc(estrato, 0.5) AS DOUBLE) AS mediana FROM wide"
    q["group_median_income"] = (_with(SURVEY, WIDE) + "SELECT sexo, estrato, CAST(quantile_disc(ingreso_total, 0.5) AS DOUBLE) "
                                "AS mediana FROM wide WHERE ingreso_total IS NOT NULL AND edad >= 13 AND ocupado = 1 GROUP BY sexo, estrato")
    q["group_median_income_exact"] = q["group_median_income"]
    q["median_price_exact"] = ("SELECT l_returnflag, CAST(quantile_disc(l_extendedprice, 0.5) AS DOUBLE) AS mediana "
                               "FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag")
    q["group_median_parts"] = ("SELECT p_brand, CAST(quantile_disc(p_size, 0.5) AS DOUBLE) AS mediana FROM part "
                               "WHERE p_size IS NOT NULL GROUP BY p_brand")
    q["null_rates"] = _with(SURVEY, EXT) + _null_rates("ext", FEATS)
    q["null_rates_by_cluster"] = (_with(SURVEY, EXT, _null_by_cluster_cte())
                                  + "SELECT columna, cluster_edad, total_registros, nulos, round(porcentaje_nulos, 6) AS porcentaje_nulos FROM nbp")
    q["group_means"] = (_with(SURVEY, EXT) + "SELECT sexo, " + ", ".join(_r(f"avg({c})", c) for c in FEATS)
                        + " FROM ext GROUP BY sexo")
    q["global_means"] = _with(SURVEY, EXT) + "SELECT " + ", ".join(_r(f"avg({c})", c) for c in FEATS) + " FROM ext"
    q["corr_matrix"] = _with(SURVEY, EXT, OCC_NUM) + _corr_matrix("occnum", CORR_COLS, CORR_NAMES)
    feats = [c for c in CORR_COLS if c != "condicion_ocupacion_num"]
    q["target_corr"] = (_with(SURVEY, EXT, OCC_NUM) + "\nUNION ALL\n".join(
        f"SELECT '{CORR_NAMES.get(c, c)}' AS variable, round({_corr(c, 'condicion_ocupacion_num', 'occnum')}, 6) AS r"
        for c in feats))
    q["corr_matrix_lineitem"] = _corr_matrix("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    q["crosstab_occupation_age"] = (
        _with(SURVEY, EXT, f"b AS (SELECT {AGE_BIN_CASE} AS rango_edad, condicion_ocupacion FROM ext "
                           "WHERE condicion_ocupacion IN ('OCUPADO', 'DESOCUPADO'))",
              "c AS (SELECT rango_edad, count(*) AS tot, count_if(condicion_ocupacion = 'DESOCUPADO') AS d, "
              "count_if(condicion_ocupacion = 'OCUPADO') AS o FROM b WHERE rango_edad IS NOT NULL GROUP BY rango_edad)")
        + "SELECT rango_edad, round(d * 100.0 / tot, 6) AS DESOCUPADO, round(o * 100.0 / tot, 6) AS OCUPADO FROM c")
    q["confusion_matrix"] = _with(SURVEY, EXT, _confusion_cte()) + "SELECT y, pred, n FROM cm"
    q["class_counts"] = (_with(SURVEY, EXT, _confusion_cte()) + "SELECT clase, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
                         "CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn FROM cc")
    q["weighted_metrics"] = (_with(SURVEY, EXT, _confusion_cte())
                             + "SELECT round(sum(tp) * 1.0 / sum(support), 6) AS accuracy, "
                               "round(sum(precision * support) / sum(support), 6) AS precision_weighted, "
                               "round(sum(recall * support) / sum(support), 6) AS recall_weighted, "
                               "round(sum(f1_score * support) / sum(support), 6) AS f1_weighted FROM pcf")
    q["classification_report"] = (
        _with(SURVEY, EXT, _confusion_cte())
        + "SELECT clase AS etiqueta, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, "
          "CAST(support AS BIGINT) AS support FROM pcf\nUNION ALL\n"
          "SELECT 'accuracy', NULL, NULL, round(sum(tp) * 1.0 / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf\nUNION ALL\n"
          "SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6), CAST(sum(support) AS BIGINT) FROM pcf\nUNION ALL\n"
          "SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
          "round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcf")
    q["real_vs_predicted"] = (_with(SURVEY, EXT, SCORED)
                              + "SELECT y AS clase, CAST(count(*) AS BIGINT) AS real, "
                                "CAST((SELECT count(*) FROM scored s2 WHERE s2.pred = s1.y) AS BIGINT) AS predicho "
                                "FROM scored s1 GROUP BY y")
    q["audit_series"] = (_with(SURVEY, EXT, _confusion_cte())
                         + "SELECT clase, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
                           "CAST(tn AS BIGINT) AS tn, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                           "round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support, "
                           "CAST((SELECT count(*) FROM scored WHERE y = clase) AS BIGINT) AS real, "
                           "CAST((SELECT count(*) FROM scored WHERE pred = clase) AS BIGINT) AS predicho FROM pcf")
    q["class_shares"] = (_with(SURVEY, EXT, SCORED)
                         + "SELECT 'real' AS serie, y AS clase, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM scored), 6) AS pct "
                           "FROM scored GROUP BY y\nUNION ALL\n"
                           "SELECT 'prediccion', pred, count(*), round(count(*) * 100.0 / (SELECT count(*) FROM scored), 6) FROM scored GROUP BY pred")
    q["audit_counts"] = (
        _with(SURVEY, EXT, RANGED, KEPT, "kc AS (SELECT * FROM kept WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATS) + ")")
        + "SELECT 'leidos' AS paso, (SELECT count(*) FROM ranged) AS filas, CAST(0 AS BIGINT) AS eliminadas\nUNION ALL\n"
          "SELECT 'sin_menores_incompletos', (SELECT count(*) FROM kept), (SELECT count(*) FROM ranged) - (SELECT count(*) FROM kept)\nUNION ALL\n"
          "SELECT 'sin_nulos_features', (SELECT count(*) FROM kc), (SELECT count(*) FROM kept) - (SELECT count(*) FROM kc)")
    wm = ("wm AS (SELECT sum(tp) * 1.0 / sum(support) AS a, sum(precision * support) / sum(support) AS p, "
          "sum(recall * support) / sum(support) AS r, sum(f1_score * support) / sum(support) AS f FROM pcf)")
    q["metrics_text_lines"] = (
        _with(SURVEY, EXT, _confusion_cte(), wm)
        + "SELECT 0 AS line_no, printf('Accuracy: %.4f', round(a, 4)) AS linea FROM wm UNION ALL "
          "SELECT 1, printf('Precision (weighted): %.4f', round(p, 4)) FROM wm UNION ALL "
          "SELECT 2, printf('Recall (weighted): %.4f', round(r, 4)) FROM wm UNION ALL "
          "SELECT 3, printf('F1 (weighted): %.4f', round(f, 4)) FROM wm")
    q["null_rate_text_lines"] = (_with(SURVEY, EXT) + "SELECT 0 AS line_no, 'PORCENTAJE DE NULOS POR VARIABLE SELECCIONADA' AS linea "
                                 f"UNION ALL SELECT 1, '{'=' * 45}'\nUNION ALL\n" + "\nUNION ALL\n".join(
        f"SELECT {i + 2} AS line_no, printf('%s: %.2f%%', '{c}', round(100.0 * count_if({c} IS NULL) / count(*), 2)) AS linea FROM ext"
        for i, c in enumerate(FEATS)))
    labels = AGE_LABELS
    q["null_pct_matrix"] = (_with(SURVEY, EXT, _null_by_cluster_cte()) + "SELECT columna, " + ", ".join(
        f"round(max(CASE WHEN cluster_edad = '{lab}' THEN porcentaje_nulos END), 6) AS \"{lab}\"" for lab in labels)
        + " FROM nbp GROUP BY columna")
    q["null_count_matrix"] = (_with(SURVEY, EXT, _null_by_cluster_cte()) + "SELECT columna, " + ", ".join(
        f"CAST(max(CASE WHEN cluster_edad = '{lab}' THEN nulos END) AS BIGINT) AS \"{lab}\"" for lab in labels)
        + " FROM nbp GROUP BY columna")
    q["top_missing"] = (_with(SURVEY, EXT, _null_by_cluster_cte(),
                              "rk AS (SELECT *, row_number() OVER (PARTITION BY cluster_edad ORDER BY porcentaje_nulos DESC, columna) AS rnk FROM nbp)")
                        + "SELECT columna, cluster_edad, total_registros, nulos, round(porcentaje_nulos, 6) AS porcentaje_nulos, "
                          "CAST(rnk AS BIGINT) AS rank FROM rk WHERE rnk <= 10 AND nulos > 0")
    q["head_rows"] = ext_all + " ORDER BY row_id LIMIT 5"
    # sampling
    cap_thr = ("lpad(lower(hex(CAST(floor((10000.0 / (SELECT count(*) FROM ext)) * 4294967296.0) AS BIGINT))), 8, '0')")
    q["sample_cap"] = (_with(SURVEY, EXT) + f"SELECT row_id FROM ext WHERE (SELECT count(*) FROM ext) <= 10000 "
                       f"OR {_hash()} < {cap_thr}")
    q["sample_n"] = _with(SURVEY, EXT) + f"SELECT row_id FROM ext ORDER BY {_hash()}, row_id LIMIT 5000"
    q["split_80_20"] = _with(SURVEY, EXT) + f"SELECT row_id, CASE WHEN {_hash()} < 'cccccccc' THEN 0 ELSE 1 END AS part FROM ext"
    q["stratified_split"] = (
        _with(SURVEY, EXT, "s AS (SELECT row_id, condicion_ocupacion, row_number() OVER (PARTITION BY condicion_ocupacion "
                           f"ORDER BY {_hash()}, row_id) AS rn, count(*) OVER (PARTITION BY condicion_ocupacion) AS sz "
                           "FROM ext WHERE condicion_ocupacion IS NOT NULL)")
        + "SELECT row_id, condicion_ocupacion, CASE WHEN rn <= floor(0.8 * sz + 0.5) THEN 0 ELSE 1 END AS part FROM s")
    q["assign_folds"] = (_with(SURVEY, EXT) + f"SELECT row_id, CAST((row_number() OVER (ORDER BY {_hash()}, row_id) - 1) % 5 AS INT) AS fold FROM ext")
    # imputation
    q["impute_median"] = (_with(SURVEY, PHASE2) + "SELECT row_id, coalesce(CAST(estrato AS DOUBLE), "
                          "(SELECT CAST(quantile_disc(estrato, 0.5) AS DOUBLE) FROM p2)) AS estrato FROM p2")
    q["impute_mode"] = (_with(SURVEY, PHASE2) + f"SELECT row_id, coalesce(condicion_ocupacion, {_mode_expr('p2', 'condicion_ocupacion')}) "
                        "AS condicion_ocupacion FROM p2")
    q["impute_income"] = (
        _with(SURVEY, PHASE2, "meds AS (SELECT sexo, estrato, CAST(quantile_disc(ingreso_total, 0.5) AS DOUBLE) AS med FROM p2 "
                              "WHERE ingreso_total IS NOT NULL AND edad >= 13 AND condicion_ocupacion = 1 GROUP BY sexo, estrato)")
        + "SELECT p2.row_id, round(CASE WHEN (p2.edad < 13 OR p2.condicion_ocupacion <> 1) THEN NULL "
          "WHEN p2.ingreso_total IS NULL AND p2.edad >= 13 AND p2.condicion_ocupacion = 1 THEN meds.med "
          "ELSE p2.ingreso_total END, 6) AS ingreso_total FROM p2 LEFT JOIN meds ON meds.sexo = p2.sexo AND meds.estrato = p2.estrato")
    q["impute_education"] = (_with(SURVEY, PHASE2) + "SELECT row_id, "
                             f"coalesce(nivel_educativo_cod, {_mode_expr('p2', 'nivel_educativo_cod')}) AS nivel_educativo_cod, "
                             f"coalesce(anios_educacion, {_mode_expr('p2', 'anios_educacion')}) AS anios_educacion FROM p2")
    q["impute_phase2"] = _phase2_sql()
    q["impute_by_age_range"] = _impute_group_mode_sql()
    q["imputed_counts"] = ("WITH imp AS (" + _impute_group_mode_sql() + ")\nSELECT age_range, condicion_ocupacion, "
                           "count(*) AS n FROM imp GROUP BY age_range, condicion_ocupacion")
    q["imputation_job"] = ("WITH imp AS (" + _impute_group_mode_sql() + ")\nSELECT * EXCLUDE (age_range) FROM imp")
    q["extract_job"] = ext_all
    # machine learning
    for name, fn in (("standardize_sample", "stddev_samp"), ("standardize_population", "stddev_pop")):
        q[name] = (_with(SURVEY, EXT, CLEAN) + "SELECT row_id, "
                   f"round((edad - (SELECT avg(edad) FROM clean)) / NULLIF((SELECT {fn}(edad) FROM clean), 0), 6) AS edad_z, "
                   f"round((nivel_educativo_cod - (SELECT avg(nivel_educativo_cod) FROM clean)) / "
                   f"NULLIF((SELECT {fn}(nivel_educativo_cod) FROM clean), 0), 6) AS nivel_educativo_cod_z FROM clean")
    q["scaled_vector"] = q["standardize_sample"]
    blob = ("blobs AS (SELECT o_orderkey AS row_id, 100.0 * (o_orderkey % 3) + (o_orderkey % 7) / 10.0 AS f1 FROM orders)")
    q["kmeans_planted"] = (_with(blob, "g AS (SELECT row_id % 3 AS k, count(*) AS n, avg(f1) AS m FROM blobs GROUP BY 1)")
                           + "SELECT CAST(row_number() OVER (ORDER BY m) AS BIGINT) AS orden, n, round(m, 6) AS media_f1 FROM g")
    q["clustering_job_planted"] = q["kmeans_planted"]
    q["cluster_points_planted"] = (
        _with(blob, "st AS (SELECT avg(f1) AS m, stddev_samp(f1) AS s FROM blobs)")
        + "SELECT row_id, round(abs((f1 - st.m) / st.s * sqrt(3)), 6) AS pca_x, CAST(0.0 AS DOUBLE) AS pca_y "
          "FROM blobs, st")
    q["kmeans_centers"] = (_with(blob, "g AS (SELECT row_id % 3 AS k, avg(f1) AS m FROM blobs GROUP BY 1)")
                           + "SELECT CAST(row_number() OVER (ORDER BY m) AS BIGINT) AS orden, round(m, 6) AS f1, "
                             "round(m + 1.0, 6) AS f2, round(m * 2.0, 6) AS f3 FROM g")
    r = "abs(corr(l_quantity, l_discount))"
    q["pca_variance"] = (f"SELECT 0 AS componente, round((1 + {r}) / 2, 6) AS varianza_explicada FROM lineitem\n"
                         f"UNION ALL SELECT 1, round((1 - {r}) / 2, 6) FROM lineitem")
    q["cluster_profile_details"] = (
        _with(SURVEY, EXT, _profile_cte())
        + "SELECT cluster, feature, position, round(media_cluster, 6) AS media_cluster, round(media_global, 6) AS media_global, "
          "round(desviacion_pct, 6) AS desviacion_pct, etiqueta FROM lab")
    q["cluster_profile_text"] = (
        _with(SURVEY, EXT, _profile_cte())
        + "SELECT cluster, coalesce(string_agg(etiqueta, ', ' ORDER BY position), "
          f"'{AVERAGE_TEXT}') AS perfil FROM lab GROUP BY cluster")
    title = " UNION ALL ".join(f"SELECT CAST(NULL AS INTEGER) AS cluster, {i} AS line_no, '{t}' AS linea"
                               for i, t in enumerate(PROFILE_TITLE))
    q["cluster_profile_lines"] = (
        _with(SURVEY, EXT, _profile_cte(),
              "prof AS (SELECT cluster, coalesce(string_agg(etiqueta, ', ' ORDER BY position), "
              f"'{AVERAGE_TEXT}') AS perfil FROM lab GROUP BY cluster)")
        + title + "\nUNION ALL\n"
          "SELECT cluster, 0, printf('Cluster %d:', cluster) FROM prof UNION ALL "
          "SELECT cluster, 1, '  Perfil: ' || perfil FROM prof UNION ALL "
          "SELECT cluster, 2, '  Detalles:' FROM prof UNION ALL "
          "SELECT cluster, position + 3, printf('    - %s: %.2f (Global: %.2f)', feature, round(media_cluster, 2), "
          "round(media_global, 2)) FROM lab")
    q["string_index"] = (
        _with(SURVEY, EXT, "ix AS (SELECT Lengua, row_number() OVER (ORDER BY count(*) DESC, CAST(Lengua AS VARCHAR)) - 1 AS i "
                           "FROM ext WHERE Lengua IS NOT NULL GROUP BY Lengua)")
        + "SELECT ext.row_id, CAST(coalesce(ix.i, (SELECT count(*) FROM ix)) AS INT) AS lengua_idx FROM ext LEFT JOIN ix ON ix.Lengua = ext.Lengua")
    q["one_hot"] = (
        _with(SURVEY, EXT, "ix AS (SELECT Etnia, row_number() OVER (ORDER BY count(*) DESC, CAST(Etnia AS VARCHAR)) - 1 AS i "
                           "FROM ext WHERE Etnia IS NOT NULL GROUP BY Etnia)")
        + "SELECT ext.row_id, CAST(coalesce(ix.i, -1) AS INT) AS oh_pos, CAST((SELECT count(*) FROM ix) AS INT) AS oh_len "
          "FROM ext LEFT JOIN ix ON ix.Etnia = ext.Etnia")
    q["forest_planted"] = q["model_save_load"]
    # planted rule: the best model predicts y on every hold-out row, so the metrics of (y, y)
    # over the hold-out part are the expected answer
    holdout = (_with(SURVEY, EXT, PLANTED, "{test}")
               + "SELECT round(count_if(y = y) * 1.0 / count(*), 6) AS accuracy, "
                 "round(count_if(y = y) * 1.0 / count(*), 6) AS precision_weighted, "
                 "round(count_if(y = y) * 1.0 / count(*), 6) AS recall_weighted, "
                 "round(count_if(y = y) * 1.0 / count(*), 6) AS f1_weighted FROM test")
    q["grid_search_planted"] = holdout.replace(
        "{test}", f"test AS (SELECT * FROM planted WHERE {_hash()} >= 'cccccccc')")
    q["training_stratified_planted"] = holdout.replace(
        "{test}", "ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY "
                  f"{_hash()}, row_id) AS rn, count(*) OVER (PARTITION BY y) AS sz FROM planted),\n"
                  "test AS (SELECT * FROM ranked WHERE rn > floor(0.8 * sz + 0.5))")
    q["score_records"] = (_with(SURVEY, EXT, PLANTED)
                          + "SELECT row_id, y AS prediccion, CASE WHEN y = 'DESOCUPADO' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"p_DESOCUPADO\", "
                            "CASE WHEN y = 'OCUPADO' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"p_OCUPADO\" FROM planted")
    q["score_records_rejected"] = (
        _with(SURVEY, EXT, "bad AS (SELECT row_id, CASE WHEN row_id % 11 = 0 THEN '?' WHEN sexo = 1 THEN 'Hombre' ELSE 'Mujer' END AS sexo, "
                           "CASE WHEN row_id % 13 = 0 THEN 'x1' WHEN row_id % 17 = 0 THEN NULL ELSE CAST(edad AS VARCHAR) END AS edad, "
                           "row_id % 11 = 0 AS b1, row_id % 13 = 0 OR row_id % 17 = 0 AS b2 FROM ext WHERE edad IS NOT NULL)")
        + "SELECT row_id, sexo, edad, CASE WHEN b1 AND b2 THEN 'edad,sexo' WHEN b1 THEN 'sexo' ELSE 'edad' END AS errores FROM bad WHERE b1 OR b2")
    q["audit_job"] = (_with(SURVEY, EXT, _planted_audit_cte())
                      + "SELECT clase, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
                        "CAST(tn AS BIGINT) AS tn, CAST(1.0 AS DOUBLE) AS precision, CAST(1.0 AS DOUBLE) AS recall, "
                        "CAST(1.0 AS DOUBLE) AS f1_score, CAST(tp AS BIGINT) AS support, "
                        "CAST(tp AS BIGINT) AS real, CAST(tp AS BIGINT) AS predicho FROM cc")
    nbp_values = " UNION ALL ".join(
        f"SELECT '{t}' AS tabla, columna AS clave, '{lab}' AS columna, max(CASE WHEN cluster_edad = '{lab}' THEN CAST({v} AS DOUBLE) END) AS valor FROM nbp GROUP BY columna"
        for t, v in (("nulos_porcentaje", "porcentaje_nulos"), ("nulos_cantidad", "nulos")) for lab in labels)
    ages = (f"b AS (SELECT {AGE_BIN_CASE} AS rango_edad, condicion_ocupacion FROM ext WHERE condicion_ocupacion IN ('OCUPADO', 'DESOCUPADO'))",
            "bc AS (SELECT rango_edad, count(*) AS tot, count_if(condicion_ocupacion = 'DESOCUPADO') AS d, "
            "count_if(condicion_ocupacion = 'OCUPADO') AS o FROM b WHERE rango_edad IS NOT NULL GROUP BY rango_edad)")
    corr_m, corr_t = (q[k].removeprefix(_with(SURVEY, EXT, OCC_NUM)) for k in ("corr_matrix", "target_corr"))
    q["analysis_job"] = (
        _with(SURVEY, EXT, _null_by_cluster_cte(), OCC_NUM, *ages)
        + "SELECT tabla, clave, columna, round(valor, 6) AS valor FROM (" + nbp_values
        + " UNION ALL SELECT 'ocupacion_por_edad', rango_edad, 'DESOCUPADO', d * 100.0 / tot FROM bc"
          " UNION ALL SELECT 'ocupacion_por_edad', rango_edad, 'OCUPADO', o * 100.0 / tot FROM bc UNION ALL "
        + " UNION ALL ".join(f"SELECT 'cluster_nulos', '{c}', 'porcentaje_nulos', 100.0 * count_if({c} IS NULL) / count(*) FROM ext" for c in FEATS)
        + f" UNION ALL SELECT 'corr_matriz', var_a, var_b, r FROM ({corr_m}) UNION ALL SELECT 'corr_objetivo', variable, 'r', r FROM ({corr_t}))")
    flip = "substr(md5(CAST(row_id AS VARCHAR) || ':7'), 1, 8) < '33333333'"
    noisy = (f"noisy AS (SELECT row_id, y AS p, CASE WHEN {flip} THEN CASE WHEN y = 'OCUPADO' THEN 'DESOCUPADO' ELSE 'OCUPADO' END ELSE y END AS y, "
             f"{_hash()} AS h FROM planted)")
    share = "coalesce(count(*) FILTER (y = c AND p = c) * 1.0 / nullif({d}, 0), 0)"
    q["training_noisy_planted"] = (
        _with(SURVEY, EXT, PLANTED, noisy, "test AS (SELECT y, p FROM noisy WHERE h >= 'cccccccc')",
              "cl AS (SELECT DISTINCT y AS c FROM test)",
              f"pc AS (SELECT c, count(*) FILTER (y = c) AS s, {share.format(d='count(*) FILTER (p = c)')} AS pr, {share.format(d='count(*) FILTER (y = c)')} AS rc "
              "FROM cl, test GROUP BY c)",
              "folds AS (SELECT y, p, (row_number() OVER (ORDER BY h, row_id) - 1) % 5 AS f FROM noisy WHERE h < 'cccccccc')",
              "acc AS (SELECT f, count_if(y = p) * 1.0 / count(*) AS a FROM folds GROUP BY f)")
        + "SELECT 'metricas' AS tabla, 'accuracy' AS clave, round(count_if(y = p) * 1.0 / count(*), 6) AS valor FROM test "
          "UNION ALL SELECT 'metricas', 'precision_weighted', round(sum(s * pr) / sum(s), 6) FROM pc "
          "UNION ALL SELECT 'metricas', 'recall_weighted', round(sum(s * rc) / sum(s), 6) FROM pc "
          "UNION ALL SELECT 'metricas', 'f1_weighted', round(sum(s * coalesce(2 * pr * rc / nullif(pr + rc, 0), 0)) / sum(s), 6) FROM pc "
          "UNION ALL SELECT 'rejilla', k, round(avg(a), 6) FROM acc, (SELECT unnest(['numTrees=20,maxDepth=5', 'numTrees=20,maxDepth=10', "
          "'numTrees=50,maxDepth=5', 'numTrees=50,maxDepth=10']) AS k) GROUP BY k")
    q["stream_answers"] = (
        _with(SURVEY, EXT, PLANTED, "bad AS (SELECT row_id, y, row_id % 11 = 0 AS b1, row_id % 13 = 0 OR row_id % 17 = 0 AS b2 FROM planted)")
        + "SELECT row_id, CASE WHEN b1 OR b2 THEN NULL ELSE y END AS prediccion, "
          "CASE WHEN b1 AND b2 THEN 'edad,sexo' WHEN b1 THEN 'sexo' WHEN b2 THEN 'edad' ELSE '' END AS errores FROM bad")
    q["clustering_fixpoint"] = (
        _with(SURVEY, EXT) + "SELECT CAST(count(*) AS BIGINT) AS filas, CAST(0 AS BIGINT) AS mal_asignadas, TRUE AS centros_en_la_media FROM ext WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in FEATS))
    q["csv_common_types"] = (
        _with(SURVEY) + "SELECT CAST(row_id AS BIGINT) AS row_id, CASE src WHEN 0 THEN CAST(floor(INGTOT) AS DOUBLE) WHEN 1 THEN INGTOT END AS ingreso, "
        "CASE WHEN src = 1 AND row_id % 5 = 0 THEN 'alto' ELSE CAST(ESTRATO AS VARCHAR) END AS estrato, "
        "CAST(CASE src WHEN 0 THEN row_id WHEN 2 THEN row_id + 3000000000 END AS BIGINT) AS grande, 'int,double,string,bigint' AS tipos FROM survey")
    q["csv_single_file"] = "SELECT doc_id, md5('\"' || text) AS md5, lang FROM documents"
    q["stream_scoring"] = _with(SURVEY, EXT, PLANTED) + "SELECT row_id, y AS prediccion FROM planted"
    q.update(_cases_sql())
    return q


def _cases_sql() -> dict[str, str]:
    """NULL keys, NULL classes, groups without values, heaped values, NaN, report lines, label-free cluster facts."""
    q = {}
    h = "substr(md5(coalesce(CAST(nkey AS VARCHAR), '<null>:' || CAST(row_id AS VARCHAR)) || ':42'), 1, 8)"
    nk = ("nk AS (SELECT row_id, CASE WHEN row_id % 4 = 0 THEN NULL ELSE row_id END AS nkey, "
          "CASE WHEN row_id % 3 = 0 THEN NULL ELSE condicion_ocupacion END AS clase FROM ext)")
    order = f"ORDER BY {h}, nkey NULLS FIRST, row_id"
    q["split_zero_weight"] = _with(SURVEY, EXT, nk) + f"SELECT row_id, CASE WHEN {h} < 'cccccccc' THEN 0 ELSE 1 END AS part FROM nk"
    q["sample_n_null_keys"] = _with(SURVEY, EXT, nk) + f"SELECT row_id FROM nk {order} LIMIT 5000"
    q["stratified_split_null_class"] = (
        _with(SURVEY, EXT, nk, f"s AS (SELECT row_id, clase, row_number() OVER (PARTITION BY clase {order}) AS rn, "
                               "count(*) OVER (PARTITION BY clase) AS sz FROM nk)")
        + "SELECT row_id, clase, CASE WHEN rn <= floor(0.8 * sz + 0.5) THEN 0 ELSE 1 END AS part FROM s")
    q["folds_null_class"] = (_with(SURVEY, EXT, nk)
                             + f"SELECT row_id, clase, CAST((row_number() OVER (PARTITION BY clase {order}) - 1) % 5 AS INT) AS fold FROM nk")
    top = ("{c}c AS (SELECT g, {c}, row_number() OVER (PARTITION BY g ORDER BY count(*) DESC, {c}) AS rn FROM gm WHERE {c} IS NOT NULL GROUP BY g, {c})")
    q["group_mode_all_null_group"] = (
        _with(SURVEY, EXT, "gm AS (SELECT row_id % 7 AS g, CASE WHEN row_id % 7 = 3 THEN NULL ELSE Lengua END AS v, Etnia AS w FROM ext)",
              top.format(c="v"), top.format(c="w"))
        + "SELECT k.g, vc.v, wc.w FROM (SELECT DISTINCT g FROM gm) k LEFT JOIN vc ON vc.g = k.g AND vc.rn = 1 LEFT JOIN wc ON wc.g = k.g AND wc.rn = 1")
    q["group_median_heaped"] = ("SELECT l_returnflag, CAST(quantile_disc(CASE WHEN l_orderkey % 2 = 0 THEN 1000.0 ELSE l_extendedprice END, 0.5) AS DOUBLE) AS mediana "
                                "FROM lineitem GROUP BY l_returnflag")
    q["group_median_bigint"] = (
        "SELECT l_returnflag, quantile_disc(CAST(9007199254740993 + (l_orderkey * 7919 + l_partkey) % 1000003 - 500000 AS BIGINT), 0.5) AS mediana "
        "FROM lineitem GROUP BY l_returnflag")
    q["median_decimal"] = (
        "SELECT CAST(quantile_disc(CAST(12345678901234567800 + (o_orderkey * 31 + o_custkey) % 9973 AS HUGEINT), 0.5) AS VARCHAR) AS mediana FROM orders")
    q["group_median_date"] = "SELECT l_returnflag, CAST(quantile_disc(CAST(l_shipdate AS DATE), 0.5) AS VARCHAR) AS mediana FROM lineitem GROUP BY l_returnflag"
    hk = "hk AS (SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 1 WHEN row_id % 3 = 1 THEN NULL ELSE row_id END AS hkey FROM ext)"
    plain = "md5(CAST(hkey AS VARCHAR) || ':42')"
    by_row = "md5('<null>:' || coalesce(CAST(hkey AS VARCHAR), '') || ':' || CAST(row_id AS VARCHAR) || ':42')"
    cut = "lpad(lower(to_hex(CAST(floor(1000.0 / (SELECT count(*) FROM hk) * 4294967296.0) AS BIGINT))), 8, '0')"
    q["sample_cap_heavy_key"] = (
        _with(SURVEY, EXT, hk, "hv AS (SELECT hkey AS hv FROM hk WHERE hkey IS NOT NULL GROUP BY hkey HAVING count(*) > (SELECT count(*) FROM hk) / 1000.0)")
        + f"SELECT row_id FROM hk LEFT JOIN hv ON hkey = hv WHERE (SELECT count(*) FROM hk) <= 1000 "
          f"OR substr(CASE WHEN hkey IS NULL OR hv IS NOT NULL THEN {by_row} ELSE {plain} END, 1, 8) < {cut}")
    q["sample_n_heavy_key"] = (
        _with(SURVEY, EXT, hk) + "SELECT row_id FROM hk WHERE row_id % 3 = 0 OR row_id % 11 = 2 "
        "ORDER BY substr(md5(coalesce(CAST(hkey AS VARCHAR), '<null>:' || CAST(row_id AS VARCHAR)) || ':42'), 1, 8), hkey NULLS FIRST, row_id LIMIT 700")
    q["corr_matrix_nan"] = (
        _with(SURVEY, EXT, "cn AS (SELECT CASE WHEN row_id % 10 = 0 THEN NULL ELSE CAST(edad AS DOUBLE) END AS edad, nivel_educativo_cod, sexo FROM ext)")
        + _corr_matrix("cn", ["edad", "nivel_educativo_cod", "sexo"]))
    q["drop_incomplete_keep_null"] = (_with(SURVEY, EXT)
                                      + "SELECT row_id FROM ext WHERE edad IS NULL OR NOT (edad >= 0 AND edad <= 12 AND (Lengua IS NULL OR Etnia IS NULL))")
    count_lines = (("tp", "Verdaderos Positivos (TP):  "), ("fp", "Falsos Positivos (FP):      "),
                   ("fn", "Falsos Negativos (FN):      "), ("tn", "Verdaderos Negativos (TN):  "))
    metric_lines = (("Accuracy", "sum(tp) * 1.0"), ("Precision (weighted)", "sum(precision * support)"),
                    ("Recall (weighted)", "sum(recall * support)"), ("F1 (weighted)", "sum(f1_score * support)"))
    report = ("SELECT 3, {n}, 0, printf('%s: %s %s %s %d', {n}, {p}, {r}, {f}, CAST({s} AS BIGINT)) FROM pcf")
    four = "printf('%.4f', round({}, 4))"
    q["audit_text_lines"] = (
        _with(SURVEY, EXT, _confusion_cte())
        + " UNION ALL ".join(f"SELECT 0 AS section, '' AS item, {i} AS line_no, printf('{t}: %.4f', round({e} / sum(support), 4)) AS linea FROM pcf"
                             for i, (t, e) in enumerate(metric_lines))
        + " UNION ALL SELECT 1, y, 0, y || ': ' || string_agg(CAST(n AS VARCHAR), ' ' ORDER BY pred) FROM cm GROUP BY y"
          " UNION ALL SELECT 2, clase, 0, 'Clase: ' || clase FROM cc UNION ALL "
        + " UNION ALL ".join(f"SELECT 2, clase, {i + 1}, '  {t}' || CAST(CAST({c} AS BIGINT) AS VARCHAR) FROM cc" for i, (c, t) in enumerate(count_lines))
        + " UNION ALL " + report.format(n="clase", p=four.format("precision"), r=four.format("recall"), f=four.format("f1_score"), s="support")
        + " UNION ALL " + report.format(n="'accuracy'", p="'-'", r="'-'", f=four.format("sum(tp) * 1.0 / sum(support)"), s="sum(support)")
        + " UNION ALL " + report.format(n="'macro avg'", p=four.format("avg(precision)"), r=four.format("avg(recall)"), f=four.format("avg(f1_score)"), s="sum(support)")
        + " UNION ALL " + report.format(n="'weighted avg'", s="sum(support)", **{k: four.format(f"sum({c} * support) / sum(support)")
                                        for k, c in (("p", "precision"), ("r", "recall"), ("f", "f1_score"))})
        + " UNION ALL " + " UNION ALL ".join(
            f"SELECT {k}, {c}, 0, printf('%s: %.2f%%', {c}, round(count(*) * 100.0 / (SELECT count(*) FROM scored), 2)) FROM scored GROUP BY {c}"
            for k, c in ((4, "y"), (5, "pred"))))
    q["one_hot_keep"] = (
        _with(SURVEY, EXT, "ix AS (SELECT Etnia, row_number() OVER (ORDER BY count(*) DESC, CAST(Etnia AS VARCHAR)) - 1 AS i "
                           "FROM ext WHERE Etnia IS NOT NULL AND Etnia <> 5 GROUP BY Etnia)")
        + "SELECT ext.row_id, CAST(coalesce(ix.i, (SELECT count(*) FROM ix)) AS INT) AS oh_pos FROM ext LEFT JOIN ix ON ix.Etnia = ext.Etnia WHERE ext.Etnia IS NOT NULL")
    clean = " AND ".join(f"{c} IS NOT NULL" for c in FEATS)
    q["clustering_job"] = _with(SURVEY, EXT) + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(count(*) AS DOUBLE) AS filas, round(avg({c}), 6) AS media FROM ext WHERE {clean}" for c in FEATS)
    r = "abs(corr(edad, nivel_educativo_cod))"
    q["cluster_points"] = (_with(SURVEY, EXT) + f"SELECT CAST(count(*) AS DOUBLE) AS filas, round(1 + {r}, 6) AS var_x, round(1 - {r}, 6) AS var_y "
                           "FROM ext WHERE edad IS NOT NULL AND nivel_educativo_cod IS NOT NULL")
    return q


ORACLE_SQL = _sql()
