"""Registered queries: imputers and encoders fitted on the temporal train part."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions.features import add_deterministic_features
from cohortlens.operators import encode as E
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort
from cohortlens.plans.oracle import q, with_views
from cohortlens.plans.registry import register

ID = "estu_consecutivo"
CUT = R.TRAIN_UNTIL
MODE_COLS = ["fami_estratovivienda", "fami_educacionmadre", "fami_educacionpadre"]
MEDIAN_COLS = ["edad_estudiante_aprox", "fami_personashogar_num", "fami_cuartos_num",
               "hacinamiento", "max_educacion_padres", "brecha_educativa_padres"]
LEARNED_COLS = ["fami_tieneinternet", "fami_tienecomputador", "fami_tieneautomovil",
                "fami_tienelavadora", "cole_bilingue", "estu_genero"]
ONE_HOT_COLS = ["cole_naturaleza", "cole_area_ubicacion", "cole_calendario",
                "estu_depto_reside", "estu_depto_presentacion", "periodo"]
SCALE_COLS = ["indice_socioeconomico", "proxy_riqueza_total", "capital_tecnologico",
              "anio_periodo", "presenta_donde_reside_depto"]


def _mode_cte(cols: list[str], src: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS value, count(*) AS cnt FROM {src} WHERE {c} IS NOT NULL GROUP BY 2"
        for c in cols)
    return f"""modes AS (SELECT col, value FROM (
      SELECT *, row_number() OVER (PARTITION BY col ORDER BY cnt DESC, value) AS rk FROM ({parts}))
      WHERE rk = 1)"""


@register("mode_impute", sql=with_views(f"""
    , tr AS (SELECT * FROM cohort WHERE periodo <= '{CUT}'), {_mode_cte(MODE_COLS, 'tr')}
    SELECT {ID}, {", ".join(f"coalesce({c}, (SELECT value FROM modes WHERE col = '{c}')) AS {c}"
                            for c in MODE_COLS)} FROM cohort"""))
def mode_impute(spark, sf_dir):
    c = cohort(spark, sf_dir).select(ID, "periodo", *MODE_COLS)
    return E.impute_modes(c, MODE_COLS, fit_on=c.where(F.col("periodo") <= CUT)) \
        .select(ID, *MODE_COLS)


@register("median_impute", sql=with_views(f"""
    , tr AS (SELECT * FROM feat WHERE periodo <= '{CUT}'),
    med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in MEDIAN_COLS)} FROM tr)
    SELECT {ID}, {", ".join(f"coalesce(cast({c} AS double), m_{c}) AS {c}" for c in MEDIAN_COLS)}
    FROM feat, med""", features=True), floats=MEDIAN_COLS)
def median_impute(spark, sf_dir):
    f = add_deterministic_features(cohort(spark, sf_dir)).select(ID, "periodo", *MEDIAN_COLS)
    return E.impute_medians(f, MEDIAN_COLS, fit_on=f.where(F.col("periodo") <= CUT)) \
        .select(ID, *MEDIAN_COLS)


def _pos_minus_one(col: str, order: list[str]) -> str:
    whens = " ".join(f"WHEN {q(v)} THEN {i}" for i, v in enumerate(order))
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE coalesce(CASE {col} {whens} END, -1) END"


@register("ordinal_explicit", sql=with_views(f"""
    SELECT {ID},
      cast({_pos_minus_one('fami_estratovivienda', K.STRATUM_ORDER)} AS int) AS fami_estratovivienda,
      cast({_pos_minus_one('fami_educacionmadre', K.EDUCATION_ORDER)} AS int) AS fami_educacionmadre,
      cast({_pos_minus_one('fami_educacionpadre', K.EDUCATION_ORDER)} AS int) AS fami_educacionpadre
    FROM cohort"""))
def ordinal_explicit(spark, sf_dir):
    c = cohort(spark, sf_dir)
    return c.select(ID, E.ordinal_explicit("fami_estratovivienda", K.STRATUM_ORDER)
                    .alias("fami_estratovivienda"),
                    E.ordinal_explicit("fami_educacionmadre", K.EDUCATION_ORDER)
                    .alias("fami_educacionmadre"),
                    E.ordinal_explicit("fami_educacionpadre", K.EDUCATION_ORDER)
                    .alias("fami_educacionpadre"))


def _vocab_cte(cols: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS col, cast({c} AS string) AS value FROM cohort "
        f"WHERE periodo <= '{CUT}' AND {c} IS NOT NULL" for c in cols)
    return f"""vocab AS (SELECT col, value,
      cast(row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS int) AS idx FROM ({parts}))"""


@register("ordinal_learned", sql=with_views(f"""
    , {_vocab_cte(LEARNED_COLS)}
    SELECT {ID}, {", ".join(
        f"coalesce((SELECT idx FROM vocab WHERE col = '{c}' AND value = cohort.{c}), -1) AS {c}"
        for c in LEARNED_COLS)} FROM cohort"""))
def ordinal_learned(spark, sf_dir):
    c = cohort(spark, sf_dir)
    vocab = E.fit_vocab(c.where(F.col("periodo") <= CUT), LEARNED_COLS)
    return E.ordinal_learned(c, LEARNED_COLS, vocab, ID)


@register("one_hot_long", sql=with_views(f"""
    , {_vocab_cte(ONE_HOT_COLS)},
    long AS ({" UNION ALL ".join(f"SELECT {ID}, '{c}' AS feature, cast({c} AS string) AS category FROM cohort" for c in ONE_HOT_COLS)})
    SELECT {ID}, feature, category, coalesce(idx, -1) AS slot
    FROM long LEFT JOIN vocab ON long.feature = vocab.col AND long.category = vocab.value"""))
def one_hot_long(spark, sf_dir):
    c = cohort(spark, sf_dir)
    vocab = E.fit_vocab(c.where(F.col("periodo") <= CUT), ONE_HOT_COLS)
    return E.one_hot_long(c, ONE_HOT_COLS, vocab, ID)


@register("standard_scale", sql=with_views(f"""
    , st AS (SELECT {", ".join(f"avg(cast({c} AS double)) AS m_{c}, stddev_pop(cast({c} AS double)) AS s_{c}"
                              for c in SCALE_COLS)} FROM feat WHERE periodo <= '{CUT}')
    SELECT {ID}, {", ".join(f"(cast({c} AS double) - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END AS {c}"
                            for c in SCALE_COLS)} FROM feat, st""", features=True), floats=SCALE_COLS)
def standard_scale(spark, sf_dir):
    f = add_deterministic_features(cohort(spark, sf_dir)).select(ID, "periodo", *SCALE_COLS)
    return E.standard_scale(f, SCALE_COLS, fit_on=f.where(F.col("periodo") <= CUT)) \
        .select(ID, *SCALE_COLS)
