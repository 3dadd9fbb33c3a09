"""Registered queries: loader, feature variants, simple group statistics."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import features as FX
from cohortlens.operators import clean
from cohortlens.operators import diagnostics as D
from cohortlens.operators.vocab import VocabIndexer
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort
from cohortlens.plans.oracle import case_map, features_sql, q, with_views
from cohortlens.plans.registry import register
from cohortlens.session import scratch_path

ID = "estu_consecutivo"
Y = K.TARGET
DASH_COLS = ["punt_global", "fami_estratovivienda", "fami_educacionmadre", "fami_tieneinternet",
             "cole_naturaleza", "cole_area_ubicacion", "estu_genero", "estu_depto_reside",
             "periodo"]


@register("load_aggregates", sql=with_views(f"""
    SELECT {", ".join(DASH_COLS)} FROM cohort WHERE punt_global IS NOT NULL"""))
def load_aggregates(spark, sf_dir):
    """S3 + P6 + P4: 9-column pruned scan, coerced target, rows without target dropped."""
    df = cohort(spark, sf_dir).select(*DASH_COLS)
    df = df.withColumn(Y, F.col(Y).cast("string").try_cast("double"))
    return df.na.drop(subset=[Y])


@register("features_eda_age", sql=with_views(f"""
    SELECT {ID}, cast(cast(substring(periodo, 1, 4) AS int)
      - year(try_strptime(estu_fechanacimiento, '%d/%m/%Y')) AS int) AS edad_aprox FROM cohort"""))
def features_eda_age(spark, sf_dir):
    """full-date parse (invalid -> null), year difference, no clip."""
    return cohort(spark, sf_dir).select(ID, FX.eda_age().alias("edad_aprox"))


@register("replace_then_cast", sql=with_views(f"""
    SELECT {ID},
      try_cast(coalesce(cast({case_map('fami_personashogar', K.PERSONS_MAP)} AS string), fami_personashogar) AS int)
        AS fami_personashogar,
      try_cast(coalesce(cast({case_map('fami_cuartoshogar', K.ROOMS_MAP)} AS string), fami_cuartoshogar) AS int)
        AS fami_cuartoshogar
    FROM cohort"""))
def replace_then_cast(spark, sf_dir):
    """mapped value, else the original string, then a lenient int cast."""
    return cohort(spark, sf_dir).select(
        ID, FX.replace_then_cast(K.PERSONS_MAP, "fami_personashogar").alias("fami_personashogar"),
        FX.replace_then_cast(K.ROOMS_MAP, "fami_cuartoshogar").alias("fami_cuartoshogar"))


def _early_sql() -> str:
    age_raw = ("cast(substring(periodo, 1, 4) AS int) "
               "- try_cast(substring(estu_fechanacimiento, 7, 4) AS int)")
    lo, hi = K.AGE_CLIP
    return with_views(f"""
    SELECT {ID},
      CASE WHEN ({age_raw}) IS NOT NULL THEN least(greatest({age_raw}, {lo}), {hi}) END AS edad_estudiante_aprox,
      try_cast(coalesce(cast({case_map('fami_personashogar', K.PERSONS_MAP)} AS string), fami_personashogar) AS int)
        AS fami_personashogar_num,
      try_cast(coalesce(cast({case_map('fami_cuartoshogar', K.ROOMS_MAP)} AS string), fami_cuartoshogar) AS int)
        AS fami_cuartos_num,
      cast(coalesce(fami_tieneinternet = 'Si', false) AS int)
        + cast(coalesce(fami_tienecomputador = 'Si', false) AS int) AS capital_tecnologico
    FROM cohort""")


@register("features_early_variant", sql=_early_sql())
def features_early_variant(spark, sf_dir):
    """the earlier four-feature composition (age, F19 x2, F6; sources dropped)."""
    c = cohort(spark, sf_dir)
    return c.select(ID, FX.approx_age().alias("edad_estudiante_aprox"),
                    FX.replace_then_cast(K.PERSONS_MAP, "fami_personashogar")
                    .alias("fami_personashogar_num"),
                    FX.replace_then_cast(K.ROOMS_MAP, "fami_cuartoshogar").alias("fami_cuartos_num"),
                    (FX.is_eq("fami_tieneinternet", "Si") + FX.is_eq("fami_tienecomputador", "Si"))
                    .alias("capital_tecnologico"))


FEATURE_GROUPS = {
    "features_age": ["edad_estudiante_aprox", "anio_periodo", "extra_edad"],
    "features_household": ["fami_personashogar_num", "fami_cuartos_num", "hacinamiento",
                           "capital_tecnologico", "proxy_riqueza_total"],
    "features_parents": ["max_educacion_padres", "min_educacion_padres",
                         "brecha_educativa_padres", "padres_universitarios",
                         "padres_sin_educacion"],
    "features_index": ["presenta_donde_reside_mcpio", "presenta_donde_reside_depto",
                       "indice_socioeconomico"],
}


def _feature_group(cols):
    def run(spark, sf_dir):
        return FX.add_deterministic_features(cohort(spark, sf_dir)).select(ID, *cols)
    return run


for _name, _cols in FEATURE_GROUPS.items():
    register(_name, sql=with_views(f"SELECT {ID}, {', '.join(_cols)} FROM ({features_sql()})"))(
        _feature_group(_cols))


@register("regex_extract_level", sql=with_views(f"""
    SELECT {ID}, fami_estratovivienda,
      coalesce(nullif(regexp_extract(fami_estratovivienda, '(\\d)', 1), ''), '0') AS nivel FROM cohort"""))
def regex_extract_level(spark, sf_dir):
    """first digit of the stratum label, '0' when none."""
    return cohort(spark, sf_dir).select(ID, "fami_estratovivienda",
                                        FX.regex_digit("fami_estratovivienda").alias("nivel"))


@register("indicator_columns", sql=with_views(f"""
    SELECT {ID},
      cast(coalesce(fami_estratovivienda IN ({", ".join(q(s) for s in K.HIGH_STRATA)}), false) AS double) AS estrato_alto,
      cast(coalesce(fami_tieneinternet = 'Si', false) AS double) AS internet_si,
      cast(coalesce(cole_naturaleza = 'OFICIAL', false) AS double) AS oficial,
      cast(coalesce(cole_calendario = 'B', false) AS double) AS calendario_b FROM cohort"""))
def indicator_columns(spark, sf_dir):
    """the four group-aggregate indicators as double."""
    ind = FX.indicator_cols()
    return cohort(spark, sf_dir).select(ID, *[v.alias(k) for k, v in ind.items()])


@register("group_count", sql=with_views("""
    SELECT periodo, count(*) AS n FROM cohort GROUP BY periodo"""))
def group_count(spark, sf_dir):
    """A1: rows per period."""
    return cohort(spark, sf_dir).groupBy("periodo").agg(F.count(F.lit(1)).alias("n"))


@register("group_mean", sql=with_views(f"""
    SELECT estu_depto_reside, avg({Y}) AS mean_score FROM cohort GROUP BY 1"""),
          floats=["mean_score"])
def group_mean(spark, sf_dir):
    """A2: mean target per department."""
    return cohort(spark, sf_dir).groupBy("estu_depto_reside").agg(F.avg(Y).alias("mean_score"))


@register("distinct_sorted", sql=with_views("""
    SELECT list_sort(list(DISTINCT periodo)) AS periods FROM cohort"""))
def distinct_sorted(spark, sf_dir):
    """A10: sorted distinct periods (one array; bounded by the period domain)."""
    return cohort(spark, sf_dir).select("periodo").distinct() \
        .agg(F.sort_array(F.collect_list("periodo")).alias("periods"))


@register("distinct_count", sql=with_views("""
    SELECT count(DISTINCT estu_mcpio_reside) AS n_mcpio, count(DISTINCT cole_codigo_icfes) AS n_schools
    FROM cohort"""))
def distinct_count(spark, sf_dir):
    """Exact distinct counts (partial aggregation on the distinct keys)."""
    return cohort(spark, sf_dir).agg(F.count_distinct("estu_mcpio_reside").alias("n_mcpio"),
                                     F.count_distinct("cole_codigo_icfes").alias("n_schools"))


@register("strict_cast_scores", sql=with_views(f"""
    SELECT {ID}, cast(cast(floor(punt_global) AS bigint) AS string) AS punt_text,
      cast(cast(cast(floor(punt_global) AS bigint) AS string) AS int) AS punt_int FROM cohort"""))
def strict_cast_scores(spark, sf_dir):
    """Strict cast of clean numeric strings (would raise on bad input under ANSI)."""
    c = cohort(spark, sf_dir).select(ID, F.floor(Y).cast("string").alias("punt_text"))
    return clean.cast_numeric(c, []).select(ID, "punt_text", F.col("punt_text").cast("int")
                                            .alias("punt_int"))


# ---------------------------------------------------------------- F21, D7, M7
_DROPPED = {"estu_fechanacimiento", "fami_personashogar", "fami_cuartoshogar"}


@register("features_early_eight", sql=with_views("SELECT " + ", ".join(
    [c for c in R.COHORT_COLUMNS if c not in _DROPPED] + FX.EARLY_EIGHT) + " FROM feat", features=True))
def features_early_eight(spark, sf_dir):
    """the earlier composition of eight features."""
    return FX.add_early_features(cohort(spark, sf_dir))


@register("kernel_density", sql=with_views("""
    , v AS (SELECT estu_genero AS g, punt_global AS v FROM cohort WHERE punt_global IS NOT NULL),
    s AS (SELECT min(v) AS lo, max(v) - min(v) AS w FROM v),
    c AS (SELECT g, cast(least(floor((v - lo) / w * 512), 511) AS int) AS cell, count(*) AS n FROM v, s GROUP BY 1, 2),
    b AS (SELECT g, count(*) AS n_group, 1.06 * least(stddev_samp(v), (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34)
            * power(count(*), -0.2) AS bandwidth FROM v GROUP BY g),
    p AS (SELECT c.g, n, n_group, bandwidth, step, lo + step / 100.0 * w AS x, lo + (cell + 0.5) / 512 * w AS mid
          FROM c JOIN b ON c.g = b.g, s, (SELECT unnest(range(101)) AS step))
    SELECT g AS estu_genero, cast(step AS int) AS step, x, n_group, bandwidth,
      sum(n * exp(-((x - mid) / bandwidth) * ((x - mid) / bandwidth) / 2)) / (n_group * bandwidth * sqrt(2 * 3.141592653589793)) AS density
    FROM p GROUP BY g, step, x, n_group, bandwidth"""), floats=["x", "bandwidth", "density"])
def kernel_density(spark, sf_dir):
    """Kernel density of the score by gender, over all rows."""
    return D.kernel_density(cohort(spark, sf_dir), "estu_genero", "punt_global")


_CODED = ["cole_codigo_icfes", "estu_mcpio_presentacion"]


@register("vocabulary_stage", sql=with_views(f"""
    , tr AS (SELECT * FROM cohort WHERE periodo <= '{R.TRAIN_UNTIL}'),
    """ + ", ".join(f"""v{k} AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (SELECT DISTINCT cast({c} AS string) AS value FROM tr WHERE {c} IS NOT NULL))"""
                    for k, c in enumerate(_CODED)) + """
    SELECT estu_consecutivo, """ + ", ".join(f"cast(coalesce(v{k}.idx, -1) AS double) AS {c}__code" for k, c in enumerate(_CODED)) + """
    FROM cohort """ + " ".join(f"LEFT JOIN v{k} ON cast(cohort.{c} AS string) = v{k}.value" for k, c in enumerate(_CODED))))
def vocabulary_stage(spark, sf_dir):
    """M7: vocabularies learned by a pipeline stage on the training periods, saved, loaded and applied."""
    c = cohort(spark, sf_dir)
    path = scratch_path(spark, f"vocabulary-stage-{uuid.uuid4().hex}")
    stage = VocabIndexer(inputCols=_CODED)
    Pipeline(stages=[stage]).fit(c.where(F.col("periodo") <= R.TRAIN_UNTIL)).write().save(path)
    return PipelineModel.load(path).transform(c).select("estu_consecutivo", *[f"{x}__code" for x in _CODED])
