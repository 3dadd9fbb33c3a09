"""Domain constants.

FIXED VALUES — these must equal the reference's values for identical results
(label maps, ordinal orders, column roles, clip range, defaults). They are
stated plainly, in natural order.
"""

from __future__ import annotations

# ---- FIXED VALUES: household label maps ------------------------------------
PERSONS_MAP: dict[str, int] = {
    "Uno": 1, "Dos": 2, "Tres": 3, "Cuatro": 4, "Cinco": 5, "Seis": 6,
    "Siete": 7, "Ocho": 8, "Nueve": 9, "Diez": 10, "Once": 11, "Doce o más": 12,
    "1 a 2": 1, "3 a 4": 3, "5 a 6": 5, "7 a 8": 7, "9 o más": 9,
}

ROOMS_MAP: dict[str, int] = {
    "Uno": 1, "Dos": 2, "Tres": 3, "Cuatro": 4, "Cinco": 5, "Seis": 6,
    "Seis o mas": 6, "Siete": 7, "Ocho": 8, "Nueve": 9, "Diez o más": 10,
}

# ---- FIXED VALUES: ordinal orders -------------------------------------------
STRATUM_ORDER: list[str] = [
    "Sin Estrato", "Estrato 1", "Estrato 2", "Estrato 3",
    "Estrato 4", "Estrato 5", "Estrato 6",
]

EDUCATION_ORDER: list[str] = [
    "Ninguno",
    "No sabe",
    "No Aplica",
    "Primaria incompleta",
    "Primaria completa",
    "Secundaria (Bachillerato) incompleta",
    "Secundaria (Bachillerato) completa",
    "Técnica o tecnológica incompleta",
    "Técnica o tecnológica completa",
    "Educación profesional incompleta",
    "Educación profesional completa",
    "Postgrado",
]

# ---- FIXED VALUES: numeric levels used by the deterministic features --------
EDUCATION_LEVEL: dict[str, int] = {
    "Ninguno": 0,
    "No sabe": 0,
    "No Aplica": 0,
    "Primaria incompleta": 1,
    "Primaria completa": 2,
    "Secundaria (Bachillerato) incompleta": 3,
    "Secundaria (Bachillerato) completa": 4,
    "Técnica o tecnológica incompleta": 5,
    "Técnica o tecnológica completa": 6,
    "Educación profesional incompleta": 7,
    "Educación profesional completa": 8,
    "Postgrado": 9,
}

STRATUM_LEVEL: dict[str, int] = {
    "Sin Estrato": 0, "Estrato 1": 1, "Estrato 2": 2, "Estrato 3": 3,
    "Estrato 4": 4, "Estrato 5": 5, "Estrato 6": 6,
}

# ---- FIXED VALUES: column roles ---------------------------------------------
ORDINAL_COLS: list[str] = ["fami_estratovivienda", "fami_educacionmadre", "fami_educacionpadre"]

BINARY_COLS: list[str] = [
    "fami_tieneinternet", "fami_tienecomputador", "fami_tieneautomovil",
    "fami_tienelavadora", "cole_bilingue", "cole_sede_principal", "estu_genero",
]

NOMINAL_LOW_COLS: list[str] = [
    "cole_naturaleza", "cole_area_ubicacion", "cole_calendario", "cole_jornada",
    "cole_genero", "cole_caracter", "estu_tipodocumento", "estu_depto_reside",
    "estu_depto_presentacion", "cole_depto_ubicacion", "periodo",
]

NOMINAL_HIGH_COLS: list[str] = []

DETERMINISTIC_NUMERIC_COLS: list[str] = [
    "edad_estudiante_aprox", "anio_periodo", "fami_personashogar_num", "fami_cuartos_num",
    "capital_tecnologico", "hacinamiento", "max_educacion_padres", "min_educacion_padres",
    "brecha_educativa_padres", "padres_universitarios", "padres_sin_educacion", "extra_edad",
    "presenta_donde_reside_mcpio", "presenta_donde_reside_depto", "proxy_riqueza_total",
    "indice_socioeconomico",
]

GROUP_NUMERIC_COLS: list[str] = [
    "n_estudiantes_mcpio", "pct_estrato_alto_mcpio", "pct_internet_mcpio",
    "pct_oficial_mcpio", "pct_calendario_b_depto",
]

NUMERIC_COLS: list[str] = DETERMINISTIC_NUMERIC_COLS + GROUP_NUMERIC_COLS

AGE_CLIP: tuple[int, int] = (15, 60)
EXPECTED_AGE: int = 16
UNIVERSITY_LEVEL: int = 7
NO_EDUCATION_LEVEL: int = 1
HIGH_STRATA: list[str] = ["Estrato 4", "Estrato 5", "Estrato 6"]
MIN_N_LOO: int = 2
MISSING_GROUP: str = "__missing__"
TARGET: str = "punt_global"
SEED: int = 42

# ---- FIXED VALUES: columns dropped by the cleaning step (leakage/ids/codes) --
CLEAN_DROP_COLS: list[str] = [
    "punt_ingles",
    "punt_matematicas",
    "punt_lectura_critica",
    "punt_sociales_ciudadanas",
    "punt_c_naturales",
    "desemp_ingles",
    "estu_consecutivo",
    "cole_cod_dane_establecimiento",
    "cole_cod_dane_sede",
    "cole_codigo_icfes",
    "cole_nombre_establecimiento",
    "cole_nombre_sede",
    "estu_cod_depto_presentacion",
    "estu_cod_mcpio_presentacion",
    "estu_cod_reside_depto",
    "estu_cod_reside_mcpio",
    "cole_cod_depto_ubicacion",
    "cole_cod_mcpio_ubicacion",
    "estu_estudiante",
    "estu_privado_libertad",
    "estu_estadoinvestigacion",
    "estu_nacionalidad",
    "estu_pais_reside",
]

# ---- FIXED VALUES: fairness dimensions and dashboard orders -----------------
FAIRNESS_COLS: list[str] = [
    "fami_estratovivienda", "estu_genero", "cole_area_ubicacion",
    "cole_naturaleza", "estu_depto_reside",
]
DASHBOARD_STRATUM_ORDER: list[str] = [
    "Estrato 1", "Estrato 2", "Estrato 3", "Estrato 4", "Estrato 5", "Estrato 6",
]
SCORE_MIN: float = 0.0
SCORE_MAX: float = 500.0
NATIONAL_MEAN: float = 250.0
DEFAULT_BAND: float = 36.5

# ---- FIXED VALUES: heuristic scorer (label maps, defaults, weights) ---------
HEURISTIC_STRATUM: dict[str, int] = {
    "Sin Estrato": 0, "Estrato 1": 1, "Estrato 2": 2, "Estrato 3": 3,
    "Estrato 4": 4, "Estrato 5": 5, "Estrato 6": 6,
}
HEURISTIC_EDUCATION: dict[str, int] = {
    "Ninguno": 0,
    "Primaria incompleta": 1,
    "Primaria completa": 2,
    "Secundaria (Bachillerato) incompleta": 3,
    "Secundaria (Bachillerato) completa": 4,
    "Técnica o tecnológica incompleta": 5,
    "Técnica o tecnológica completa": 6,
    "Educación profesional incompleta": 7,
    "Educación profesional completa": 8,
    "Postgrado": 9,
}
HEURISTIC_DEFAULT_STRATUM: int = 2
HEURISTIC_DEFAULT_EDUCATION: int = 3
HEURISTIC_BASE: float = 220.0
HEURISTIC_WEIGHTS: dict[str, float] = {
    "estrato": 9, "edu_madre": 4, "edu_padre": 3, "internet": 8, "computador": 5,
    "bilingue": 12, "oficial": -6, "urbano": 4,
}

# Cohen's d magnitude bands.
COHEN_SMALL: float = 0.2
COHEN_LARGE: float = 0.8
