"""DuckDB-runnable SQL for the role-mapped views (oracle side of the check).

Generated from the same role dictionaries as the Spark plan; every oracle query
is ``WITH <views> SELECT ...`` over the driver's pre-registered tables.
"""

from __future__ import annotations

from cohortlens import constants as K
from cohortlens.plans import roles as R


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}"
                     for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def case_pick(expr: str, labels: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(labels))
    return f"CASE {expr} {whens} END"


def period_sql(ts: str) -> str:
    return f"concat(cast(year({ts}) AS string), cast(quarter({ts}) AS string))"


def _stratum_sql() -> str:
    whens = " ".join(f"WHEN o_orderpriority = {q(p)} AND c_mktsegment = {q(s)} THEN {q(lab)}"
                     for p, s, lab in R.STRATUM_OVERRIDES)
    return f"CASE {whens} ELSE {case_map('o_orderpriority', R.PRIORITY_TO_STRATUM)} END"


def cohort_sql() -> str:
    birth_year = ("CASE WHEN o_custkey % 97 = 0 THEN " + str(R.ABSURD_BIRTH_YEAR)
                  + " ELSE year(o_orderdate) - 14 - o_custkey % 9 END")
    birth = ("CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN NULL "
             f"WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN {q(R.MALFORMED_BIRTH)} "
             "ELSE concat(lpad(cast(day(o_orderdate) AS string), 2, '0'), '/', "
             "lpad(cast(month(o_orderdate) AS string), 2, '0'), '/', "
             f"cast({birth_year} AS string)) END")
    yes = lambda cond: f"CASE WHEN {cond} THEN 'Si' ELSE 'No' END"
    return f"""
    SELECT o_orderkey AS estu_consecutivo,
      o_custkey AS cole_codigo_icfes,
      {period_sql('o_orderdate')} AS periodo,
      {birth} AS estu_fechanacimiento,
      CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS estu_genero,
      n_name AS estu_mcpio_reside,
      r_name AS estu_depto_reside,
      CASE WHEN o_orderstatus = 'F' THEN n_name WHEN o_orderstatus = 'O' THEN concat(n_name, '_B') END
        AS estu_mcpio_presentacion,
      CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'OTRO' ELSE r_name END AS estu_depto_presentacion,
      {_stratum_sql()} AS fami_estratovivienda,
      {case_map('c_mktsegment', R.SEGMENT_TO_MOTHER_EDU)} AS fami_educacionmadre,
      {case_map('o_orderstatus', R.STATUS_TO_FATHER_EDU)} AS fami_educacionpadre,
      {case_pick(f'o_custkey % {len(R.PERSONS_LABELS)}', R.PERSONS_LABELS)} AS fami_personashogar,
      {case_pick(f'o_orderkey % {len(R.ROOMS_LABELS)}', R.ROOMS_LABELS)} AS fami_cuartoshogar,
      {yes("o_orderstatus = 'F'")} AS fami_tieneinternet,
      {yes("o_orderstatus <> 'P'")} AS fami_tienecomputador,
      {yes(f"c_acctbal > {R.CAR_BALANCE}")} AS fami_tieneautomovil,
      {yes(f"o_totalprice > {R.WASHER_PRICE}")} AS fami_tienelavadora,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'OFICIAL' ELSE 'NO OFICIAL' END AS cole_naturaleza,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'B' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'OTRO'
           ELSE 'A' END AS cole_calendario,
      CASE WHEN c_nationkey % 3 = 0 THEN 'RURAL' ELSE 'URBANO' END AS cole_area_ubicacion,
      CASE WHEN c_custkey % 10 = 0 THEN 'S' ELSE 'N' END AS cole_bilingue,
      100.0 + 15 * (6 - cast(substring(o_orderpriority, 1, 1) AS int))
        + 20 * cast(o_orderstatus = 'F' AS int) + 10 * (c_nationkey % 5)
        + o_totalprice / 5000 AS punt_global
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""


def raw_sql() -> str:
    order_cols = ", ".join(R.RAW_ORDER_COLS)
    math_ = ("CASE WHEN l_quantity = 1 THEN 'ABS' "
             "ELSE cast(cast(l_quantity AS bigint) AS string) END")
    total = ("coalesce(try_cast(" + math_ + " AS bigint), 0) + floor(l_discount * 100) "
             "+ floor(l_tax * 100) + l_linenumber + floor(l_extendedprice / 1000) + l_partkey % 3")
    return f"""
    SELECT l_orderkey * 10 + l_linenumber AS estu_consecutivo,
      {period_sql('l_shipdate')} AS periodo,
      {order_cols},
      'ESTUDIANTE' AS estu_estudiante,
      cast(l_suppkey AS string) AS cole_codigo_icfes,
      CASE WHEN l_returnflag = 'R' THEN NULL ELSE cast(cast({total} AS bigint) AS string) END
        AS punt_global,
      {math_} AS punt_matematicas,
      cast(cast(floor(l_discount * 100) AS bigint) AS string) AS punt_lectura_critica,
      cast(cast(floor(l_tax * 100) AS bigint) AS string) AS punt_c_naturales,
      cast(cast(l_linenumber AS bigint) AS string) AS punt_sociales_ciudadanas,
      CASE WHEN l_linestatus = 'O' THEN NULL
           ELSE cast(cast(floor(l_extendedprice / 1000) AS bigint) AS string) END AS punt_ingles
    FROM lineitem"""


def features_sql(src: str = "cohort") -> str:
    """F1-F16 over a cohort-shaped relation (oracle of ``add_deterministic_features``)."""
    mom = case_map("fami_educacionmadre", K.EDUCATION_LEVEL)
    dad = case_map("fami_educacionpadre", K.EDUCATION_LEVEL)
    persons = case_map("fami_personashogar", K.PERSONS_MAP)
    rooms = case_map("fami_cuartoshogar", K.ROOMS_MAP)
    age_raw = ("cast(substring(periodo, 1, 4) AS int) "
               "- try_cast(substring(estu_fechanacimiento, 7, 4) AS int)")
    lo, hi = K.AGE_CLIP
    age = f"CASE WHEN ({age_raw}) IS NOT NULL THEN least(greatest({age_raw}, {lo}), {hi}) END"
    eq = lambda c, v: f"cast(coalesce({c} = {q(v)}, false) AS int)"
    tech = f"({eq('fami_tieneinternet', 'Si')} + {eq('fami_tienecomputador', 'Si')})"
    car, washer = eq("fami_tieneautomovil", "Si"), eq("fami_tienelavadora", "Si")
    stratum = f"coalesce({case_map('fami_estratovivienda', K.STRATUM_LEVEL)}, 0)"
    return f"""
    SELECT * EXCLUDE (estu_fechanacimiento, fami_personashogar, fami_cuartoshogar),
      {age} AS edad_estudiante_aprox,
      cast(substring(periodo, 1, 4) AS int) AS anio_periodo,
      {persons} AS fami_personashogar_num,
      {rooms} AS fami_cuartos_num,
      cast(cast({persons} AS float) / nullif(cast({rooms} AS float), 0) AS float) AS hacinamiento,
      {tech} AS capital_tecnologico,
      {tech} + {car} + {washer} AS proxy_riqueza_total,
      greatest({mom}, {dad}) AS max_educacion_padres,
      least({mom}, {dad}) AS min_educacion_padres,
      abs({mom} - {dad}) AS brecha_educativa_padres,
      cast(coalesce({mom} >= {K.UNIVERSITY_LEVEL}, false) OR coalesce({dad} >= {K.UNIVERSITY_LEVEL}, false) AS int)
        AS padres_universitarios,
      cast(coalesce({mom} <= {K.NO_EDUCATION_LEVEL}, false) AND coalesce({dad} <= {K.NO_EDUCATION_LEVEL}, false) AS int)
        AS padres_sin_educacion,
      {age} - {K.EXPECTED_AGE} AS extra_edad,
      cast(coalesce(estu_mcpio_reside = estu_mcpio_presentacion, false) AS int)
        AS presenta_donde_reside_mcpio,
      cast(coalesce(estu_depto_reside = estu_depto_presentacion, false) AS int)
        AS presenta_donde_reside_depto,
      3 * {stratum} + 2 * {tech} + {car} + {washer} AS indice_socioeconomico
    FROM {src}"""


def with_views(body: str, *, raw: bool = False, features: bool = False) -> str:
    views = [f"cohort AS ({cohort_sql()})"]
    if raw:
        views.append(f"raw AS ({raw_sql()})")
    if features:
        views.append(f"feat AS ({features_sql()})")
    return "WITH " + ",\n".join(views) + "\n" + body
