"""Role map: driver tables -> student-record columns.

These are OUR mapping choices (not reference values): they relabel TPC-H-like
values into the student-record domain so every operator runs with its default
column names and the reference's fixed label maps. The same dictionaries feed
the Spark plan (``cohort.py``) and the DuckDB oracle SQL (``oracle.py``).
"""

from __future__ import annotations

PRIORITY_TO_STRATUM: dict[str, str] = {
    "1-URGENT": "Estrato 5",
    "2-HIGH": "Estrato 4",
    "3-MEDIUM": "Estrato 3",
    "4-NOT SPECIFIED": "Estrato 2",
    "5-LOW": "Estrato 1",
}
# (priority, segment) pairs overriding the stratum label above.
STRATUM_OVERRIDES: list[tuple[str, str, str | None]] = [
    ("1-URGENT", "HOUSEHOLD", "Estrato 6"),
    ("5-LOW", "AUTOMOBILE", "Sin Estrato"),
    ("4-NOT SPECIFIED", "FURNITURE", None),
]

SEGMENT_TO_MOTHER_EDU: dict[str, str] = {
    "AUTOMOBILE": "Primaria completa",
    "BUILDING": "Secundaria (Bachillerato) completa",
    "FURNITURE": "Educación profesional incompleta",
    "HOUSEHOLD": "Postgrado",
    "MACHINERY": "No registra",          # deliberately absent from the level map
}
STATUS_TO_FATHER_EDU: dict[str, str] = {
    "F": "Educación profesional completa",
    "O": "Primaria incompleta",
    # "P" -> null
}

# label = PERSONS_LABELS[o_custkey % 6]; "Una" is deliberately unmapped (trap T8)
PERSONS_LABELS: list[str] = ["Uno", "Dos", "3 a 4", "5 a 6", "9 o más", "Una"]
# label = ROOMS_LABELS[o_orderkey % 5]
ROOMS_LABELS: list[str] = ["Uno", "Dos", "Tres", "Seis o mas", "Diez o más"]

CAR_BALANCE: float = 5000.0        # c_acctbal above -> has car
WASHER_PRICE: float = 200000.0     # o_totalprice above -> has washer
MALFORMED_BIRTH: str = "15/06/19x8"
ABSURD_BIRTH_YEAR: int = 1850

# Raw (lineitem-grain) records: duplicated ids on (l_orderkey, l_linenumber).
RAW_ORDER_COLS: list[str] = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
PARTIAL_SCORES: list[str] = [
    "punt_matematicas", "punt_lectura_critica", "punt_c_naturales",
    "punt_sociales_ciudadanas", "punt_ingles",
]

# Temporal cut on the cohort's periods (YYYYq).
TRAIN_UNTIL: str = "19984"

# Two fixed-order dimensions for the dashboard queries.
MOTHER_EDU_DISPLAY_ORDER: list[str] = [
    "Ninguno", "Primaria incompleta", "Primaria completa",
    "Secundaria (Bachillerato) incompleta", "Secundaria (Bachillerato) completa",
    "Técnica o tecnológica incompleta", "Técnica o tecnológica completa",
    "Educación profesional incompleta", "Educación profesional completa", "Postgrado",
]

RAW_COLUMNS: list[str] = [
    "estu_consecutivo", "periodo", *RAW_ORDER_COLS, "estu_estudiante", "cole_codigo_icfes",
    "punt_global", *PARTIAL_SCORES,
]
RAW_STRING_COLS: list[str] = [
    "periodo", "l_returnflag", "l_linestatus", "estu_estudiante", "cole_codigo_icfes",
    "punt_global", *PARTIAL_SCORES,
]
COHORT_DTYPES: dict[str, str] = {
    "estu_consecutivo": "bigint", "cole_codigo_icfes": "bigint", "punt_global": "double",
}
COHORT_COLUMNS: list[str] = [
    "estu_consecutivo", "cole_codigo_icfes", "periodo", "estu_fechanacimiento", "estu_genero",
    "estu_mcpio_reside", "estu_depto_reside", "estu_mcpio_presentacion",
    "estu_depto_presentacion", "fami_estratovivienda", "fami_educacionmadre",
    "fami_educacionpadre", "fami_personashogar", "fami_cuartoshogar", "fami_tieneinternet",
    "fami_tienecomputador", "fami_tieneautomovil", "fami_tienelavadora", "cole_naturaleza",
    "cole_calendario", "cole_area_ubicacion", "cole_bilingue", "punt_global",
]
# Categorical inputs of the association statistics (reference lists restricted to
# the columns the role map provides).
ASSOC_CATS: list[str] = [
    "fami_estratovivienda", "fami_educacionmadre", "fami_educacionpadre", "fami_tieneinternet",
    "fami_tienecomputador", "fami_tieneautomovil", "fami_tienelavadora", "fami_personashogar",
    "fami_cuartoshogar", "cole_naturaleza", "cole_area_ubicacion", "cole_calendario",
    "cole_bilingue", "estu_genero",
]
CRAMER_CATS: list[str] = [
    "fami_estratovivienda", "fami_educacionmadre", "fami_educacionpadre", "fami_tieneinternet",
    "fami_tienecomputador", "fami_tieneautomovil", "cole_naturaleza", "cole_area_ubicacion",
    "cole_calendario", "cole_bilingue", "estu_genero",
]
