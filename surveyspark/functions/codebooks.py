"""Fixed values of the survey domain.

FIXED VALUES: everything below must equal the survey's own code books and labels for
results to match (column names, code dictionaries, band labels). They are listed as
plain data, in their natural order.
"""

# --- FIXED VALUES: raw survey column -> business name (10-column extract) ---
EXTRACT_RENAME = {
    "OCUP300": "condicion_ocupacion",
    "C207": "sexo",
    "C208": "edad",
    "C366": "nivel_educativo_cod",
    "C376": "Lengua",
    "C377": "Etnia",
    "C375_5": "Concentracion",
    "C375_6": "Socializar",
    "C375_1": "Movilidad",
    "C359": "Experiencia",
}
EXTRACT_COLUMNS = list(EXTRACT_RENAME)

# --- FIXED VALUES: raw survey column -> business name (wide 18-column variant) ---
WIDE_RENAME = {
    "ANIO": "anio",
    "MES": "mes",
    "CONGLOMERADO": "conglomerado",
    "MUESTRA": "muestra",
    "SELVIV": "selviv",
    "HOGAR": "hogar",
    "REGION": "region",
    "LLAVE_PANEL": "llave_panel",
    "ESTRATO": "estrato",
    "OCUP300": "ocupado",
    "INGTOT": "ingreso_total",
    "C207": "sexo",
    "C208": "edad",
    "C366": "nivel_educativo",
    "C366_1": "anios_educacion",
    "C331": "horas_trabajadas",
    "C308_COD": "ocupacion",
    "C309_COD": "sector",
}

# --- FIXED VALUES: employment recodes ---
EMPLOYED, NOT_EMPLOYED = "OCUPADO", "DESOCUPADO"
EMPLOYMENT_CODES = {EMPLOYED: [1], NOT_EMPLOYED: [0, 2, 3, 4]}
EMPLOYED_TITLE, NOT_EMPLOYED_TITLE = "Ocupado", "Desocupado"

# --- FIXED VALUES: 10 age clusters (upper bounds are exclusive; NULL -> "Sin Edad") ---
AGE_CLUSTER_EDGES = [5, 13, 18, 25, 35, 45, 55, 65]
AGE_CLUSTER_LABELS = ["0-4 años", "5-12 años", "13-17 años", "18-24 años", "25-34 años",
                      "35-44 años", "45-54 años", "55-64 años", "65+ años"]
AGE_CLUSTER_NULL = "Sin Edad"

# --- FIXED VALUES: 7 closed age ranges used for imputation (bounds inclusive, None = open) ---
AGE_RANGES = [(13, 17, "13-17"), (18, 24, "18-24"), (25, 34, "25-34"), (35, 44, "35-44"),
              (45, 54, "45-54"), (55, 64, "55-64"), (65, None, "65+")]

# --- FIXED VALUES: half-open age bins [lo, hi) for the employment cross table ---
AGE_BIN_EDGES = [0, 5, 13, 18, 25, 35, 45, 55, 65, 100]
AGE_BIN_LABELS = ["0-4", "5-12", "13-17", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]

# --- FIXED VALUES: analysis feature lists ---
CLUSTER_FEATURES = ["edad", "nivel_educativo_cod", "Lengua", "Etnia", "Concentracion",
                    "Socializar", "Experiencia", "Movilidad"]
CORRELATION_FEATURES = ["edad", "sexo", "nivel_educativo_cod", "Lengua", "Etnia", "Concentracion",
                        "Socializar", "Experiencia", "Movilidad", "condicion_ocupacion_num"]
MODEL_NUMERIC = ["edad"]
MODEL_CATEGORICAL = ["sexo", "nivel_educativo_cod", "lengua", "Etnia", "Concentracion",
                     "Socializar", "Experiencia", "Movilidad"]
TARGET = "condicion_ocupacion"

# --- FIXED VALUES: answer-form code dictionaries (label -> code) ---
SEXO = {"Hombre": 1, "Mujer": 2}
NIVEL_EDUCATIVO = {
    "Sin nivel": 1, "Educación Inicial": 2, "Primaria incompleta": 3, "Primaria completa": 4,
    "Secundaria incompleta": 5, "Secundaria completa": 6, "Básica especial": 7,
    "Superior no universitaria incompleta": 8, "Superior no universitaria completa": 9,
    "Superior universitaria incompleta": 10, "Superior universitaria completa": 11,
    "Maestría/Doctorado": 12,
}
LENGUA = {
    "Quechua": 1, "Aimara": 2, "Ashaninka": 3, "Awajún/Aguaruna": 4, "Shipibo - Konibo": 5,
    "Shawi / Chayahuita": 6, "Matigenka / Machiguenga": 7, "Achuar": 8, "Otra lengua nativa": 9,
    "Castellano": 10, "Portugués": 11, "Otra lengua extranjera": 12, "NO ESCUCHA/NO HABLA": 13,
    "LENGUA DE SEÑAS PERUANAS": 14,
}
ETNIA = {
    "Quechua": 1, "Aimara": 2, "Nativo o Indígena de la Amazonía": 3,
    "Otro Pueblo indígena originario": 4, "Afrodescendiente": 5, "Blanco": 6,
    "Mestizo": 7, "Otro": 8, "NO SABE/NO RESPONDE": 9,
}
SI_NO = {"Si": 1, "No": 2}

# field -> dictionary used by the answer encoder
ANSWER_DICTIONARIES = {
    "sexo": SEXO,
    "nivel_educativo_cod": NIVEL_EDUCATIVO,
    "Lengua": LENGUA,
    "Etnia": ETNIA,
    "Concentracion": SI_NO,
    "Socializar": SI_NO,
    "Experiencia": SI_NO,
    "Movilidad": SI_NO,
}

# --- FIXED VALUES: profile thresholds and texts ---
PROFILE_THRESHOLD_PCT = 10.0
PROFILE_HIGH, PROFILE_LOW = "ALTO", "BAJO"
PROFILE_AVERAGE_TEXT = "Valores promedio en todas las variables."

# --- FIXED VALUES: text report line formats ---
METRIC_LINES = [("accuracy", "Accuracy: %.4f"), ("precision_weighted", "Precision (weighted): %.4f"),
                ("recall_weighted", "Recall (weighted): %.4f"), ("f1_weighted", "F1 (weighted): %.4f")]
NULL_RATE_TITLE = ["PORCENTAJE DE NULOS POR VARIABLE SELECCIONADA", "============================================="]
NULL_RATE_LINE = "%s: %.2f%%"
AUDIT_MATRIX_LINE = "%s: %s"
AUDIT_CLASS_LINE = "Clase: %s"
AUDIT_COUNT_LINES = [("tp", "  Verdaderos Positivos (TP):  %d"), ("fp", "  Falsos Positivos (FP):      %d"),
                     ("fn", "  Falsos Negativos (FN):      %d"), ("tn", "  Verdaderos Negativos (TN):  %d")]
AUDIT_REPORT_LINE = "%s: %s %s %s %d"
AUDIT_SHARE_LINE = "%s: %.2f%%"
PROFILE_TITLE = ["INTERPRETACIÓN DE CLUSTERS (K-Means)", "====================================", ""]
PROFILE_CLUSTER_LINE = "Cluster %s:"
PROFILE_TEXT_LINE = "  Perfil: %s"
PROFILE_DETAILS_LINE = "  Detalles:"
PROFILE_FEATURE_LINE = "    - %s: %.2f (Global: %.2f)"
