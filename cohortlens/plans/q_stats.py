"""Registered queries: association statistics and dashboard aggregates (cohort view)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators import assoc, gaps
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort, raw_records
from cohortlens.plans.oracle import case_map, q, with_views
from cohortlens.plans.registry import register

Y = K.TARGET
SCHOOL = "cole_codigo_icfes"


def _order_pos_sql(col: str, order: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {q(v)} THEN {i + 1}" for i, v in enumerate(order)) \
        + " ELSE 0 END"


@register("category_vs_target", sql=with_views(f"""
    SELECT CASE WHEN length(fami_educacionmadre) > 20 THEN substring(fami_educacionmadre, 1, 19) || '…'
                ELSE fami_educacionmadre END AS label,
      fami_educacionmadre, count(*) AS n, avg({Y}) AS mean_score, stddev_samp({Y}) AS std_score,
      quantile_cont({Y}, 0.25) AS p25, quantile_cont({Y}, 0.5) AS p50, quantile_cont({Y}, 0.75) AS p75,
      cast({_order_pos_sql('fami_educacionmadre', K.EDUCATION_ORDER)} AS bigint) AS order_pos
    FROM cohort WHERE fami_educacionmadre IS NOT NULL AND {Y} IS NOT NULL
    GROUP BY fami_educacionmadre"""),
          floats=["mean_score", "std_score", "p25", "p50", "p75"])
def category_vs_target(spark, sf_dir):
    return assoc.category_vs_target(cohort(spark, sf_dir), "fami_educacionmadre", Y,
                                    order=K.EDUCATION_ORDER, max_label_len=20)


def _eta_sql() -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, cast({c} AS string) AS category, count(*) AS n, sum({Y}) AS s, "
        f"sum({Y} * {Y}) AS q FROM cohort WHERE {c} IS NOT NULL AND {Y} IS NOT NULL GROUP BY 2"
        for c in R.ASSOC_CATS)
    return with_views(f"""
    , cell AS ({cells}),
    feat AS (SELECT feature, sum(n) AS n, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b,
                    count(*) AS n_categories FROM cell GROUP BY feature)
    SELECT feature, cast(n AS bigint) AS n, n_categories,
      (b - s * s / n) / nullif(q - s * s / n, 0) AS eta_sq,
      sqrt(greatest((b - s * s / n) / nullif(q - s * s / n, 0), 0)) AS eta
    FROM feat""")


@register("correlation_ratio", sql=_eta_sql(), floats=["eta_sq", "eta"])
def correlation_ratio(spark, sf_dir):
    return assoc.correlation_ratio(cohort(spark, sf_dir), R.ASSOC_CATS, Y)


@register("temporal_trend", sql=with_views(f"""
    SELECT periodo, count(*) AS n, avg({Y}) AS mean_score, stddev_samp({Y}) AS std_score
    FROM cohort GROUP BY periodo"""), floats=["mean_score", "std_score"])
def temporal_trend(spark, sf_dir):
    return assoc.temporal_trend(cohort(spark, sf_dir), Y)


def _cramer_sql() -> str:
    pairs = list(combinations(R.CRAMER_CATS, 2))
    obs = " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, cast({a} AS string) AS a, "
        f"cast({b} AS string) AS b, count(*) AS o FROM cohort "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 3, 4" for a, b in pairs)
    return with_views(f"""
    , obs AS ({obs}),
    j AS (SELECT *, sum(o) OVER (PARTITION BY feature_a, feature_b, a) AS row_tot,
                    sum(o) OVER (PARTITION BY feature_a, feature_b, b) AS col_tot FROM obs),
    per AS (SELECT feature_a, feature_b, sum(o) AS n, sum(o * o / (row_tot * col_tot)) AS ratio,
                   count(DISTINCT a) AS r, count(DISTINCT b) AS c FROM j GROUP BY 1, 2)
    SELECT feature_a, feature_b, cast(n AS bigint) AS n, n * (ratio - 1) AS chi2,
      sqrt(n * (ratio - 1) / nullif(n * (least(r, c) - 1), 0)) AS cramers_v
    FROM per""")


@register("cramers_v", sql=_cramer_sql(), floats=["chi2", "cramers_v"])
def cramers_v(spark, sf_dir):
    return assoc.cramers_v(cohort(spark, sf_dir), R.CRAMER_CATS)


@register("icc_by_group", sql=with_views(f"""
    , g AS (SELECT {SCHOOL}, count(*) AS n, sum({Y}) AS s, sum({Y} * {Y}) AS q
            FROM cohort WHERE {Y} IS NOT NULL GROUP BY 1),
    t AS (SELECT count(*) AS k, sum(n) AS nn, sum(s) AS ss, sum(q) AS qq, sum(s * s / n) AS bb,
                 sum(n * n) AS n2 FROM g),
    m AS (SELECT k, nn, (bb - ss * ss / nn) AS ssb, (qq - bb) AS ssw,
                 (bb - ss * ss / nn) / (k - 1) AS msb, (qq - bb) / (nn - k) AS msw,
                 (nn - n2 / nn) / (k - 1) AS n0 FROM t)
    SELECT k AS n_groups, cast(nn AS bigint) AS n, msb, msw, n0,
      (msb - msw) / nullif(msb + (n0 - 1) * msw, 0) AS icc, ssb / nullif(ssb + ssw, 0) AS eta_sq
    FROM m"""), floats=["msb", "msw", "n0", "icc", "eta_sq"])
def icc_by_group(spark, sf_dir):
    return assoc.icc(cohort(spark, sf_dir), Y, SCHOOL)


@register("pivot_two_keys", sql=with_views(f"""
    SELECT fami_estratovivienda, cole_naturaleza, round(avg({Y}), 1) AS mean_score
    FROM cohort WHERE {Y} IS NOT NULL GROUP BY 1, 2"""))
def pivot_two_keys(spark, sf_dir):
    df = cohort(spark, sf_dir).where(F.col(Y).isNotNull())
    return df.groupBy("fami_estratovivienda", "cole_naturaleza").agg(
        F.round(F.avg(Y), 1).alias("mean_score"))


def _school_sql(desc: bool) -> str:
    d = "DESC" if desc else "ASC"
    return with_views(f"""
    SELECT {SCHOOL}, round(avg({Y}), 1) AS mean_score, round(stddev_samp({Y}), 1) AS std_score,
      count(*) AS n_students
    FROM cohort WHERE {Y} IS NOT NULL GROUP BY {SCHOOL}
    ORDER BY avg({Y}) {d}, {SCHOOL} LIMIT 10""")


def _school_topk(spark, sf_dir, desc: bool):
    df = cohort(spark, sf_dir).where(F.col(Y).isNotNull())
    g = df.groupBy(SCHOOL).agg(F.avg(Y).alias("__m"), F.stddev_samp(Y).alias("__s"),
                               F.count(F.lit(1)).alias("n_students"))
    o = F.col("__m").desc() if desc else F.col("__m").asc()
    return g.orderBy(o, F.col(SCHOOL)).limit(10).select(
        SCHOOL, F.round("__m", 1).alias("mean_score"), F.round("__s", 1).alias("std_score"),
        "n_students")


@register("group_stats_topk", sql=_school_sql(True))
def group_stats_topk(spark, sf_dir):
    return _school_topk(spark, sf_dir, True)


@register("group_stats_bottomk", sql=_school_sql(False))
def group_stats_bottomk(spark, sf_dir):
    return _school_topk(spark, sf_dir, False)


@register("department_ranking_min_n", sql=with_views(f"""
    SELECT estu_mcpio_reside, avg({Y}) AS mean_score, count(*) AS n
    FROM cohort WHERE {Y} IS NOT NULL GROUP BY 1 HAVING count(*) >= 100"""),
          floats=["mean_score"])
def department_ranking_min_n(spark, sf_dir):
    df = cohort(spark, sf_dir).where(F.col(Y).isNotNull())
    return assoc.group_stats(df, Y, ["estu_mcpio_reside"], min_n=100, std=False) \
        .orderBy("mean_score")


@register("component_sum_corr", sql=with_views(f"""
    , c AS (SELECT {", ".join(f"cast(try_cast({c} AS bigint) AS double) AS {c}"
                               for c in [Y, *R.PARTIAL_SCORES])} FROM raw),
    d AS (SELECT {Y} AS t, {" + ".join(R.PARTIAL_SCORES)} AS s FROM c
          WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [Y, *R.PARTIAL_SCORES])})
    SELECT count(*) AS n, corr(t, s) AS corr, avg(t - s) AS diff_mean, stddev_samp(t - s) AS diff_std
    FROM d""", raw=True), floats=["corr", "diff_mean", "diff_std"])
def component_sum_corr(spark, sf_dir):
    return assoc.component_check(raw_records(spark, sf_dir), Y, R.PARTIAL_SCORES)


# ---------------------------------------------------------------- dashboards
@register("kpi_gaps", sql=with_views(f"""
    SELECT avg({Y}) AS mean_global, count(*) AS n_total,
      avg(CASE WHEN fami_estratovivienda = 'Estrato 6' THEN {Y} END)
        - avg(CASE WHEN fami_estratovivienda = 'Estrato 1' THEN {Y} END) AS gap_stratum,
      coalesce(avg(CASE WHEN fami_tieneinternet = 'Si' THEN {Y} END), 0)
        - coalesce(avg(CASE WHEN fami_tieneinternet = 'No' THEN {Y} END), 0) AS gap_internet,
      coalesce(avg(CASE WHEN cole_area_ubicacion = 'URBANO' THEN {Y} END), 0)
        - coalesce(avg(CASE WHEN cole_area_ubicacion = 'RURAL' THEN {Y} END), 0) AS gap_urban_rural
    FROM cohort"""), floats=["mean_global", "gap_stratum", "gap_internet", "gap_urban_rural"])
def kpi_gaps(spark, sf_dir):
    return gaps.kpi_gaps(cohort(spark, sf_dir))


def _dim_sql(col: str, order: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT {i + 1} AS pos, {q(v)} AS {col}" for i, v in enumerate(order))


@register("mean_by_fixed_order", sql=with_views(f"""
    , dim AS ({_dim_sql('fami_estratovivienda', K.DASHBOARD_STRATUM_ORDER)}),
    agg AS (SELECT fami_estratovivienda, avg({Y}) AS mean_score, count(*) AS n FROM cohort GROUP BY 1)
    SELECT pos, dim.fami_estratovivienda, mean_score, n
    FROM dim LEFT JOIN agg ON dim.fami_estratovivienda = agg.fami_estratovivienda"""),
          floats=["mean_score"])
def mean_by_fixed_order(spark, sf_dir):
    return gaps.mean_by_fixed_order(cohort(spark, sf_dir), "fami_estratovivienda",
                                    K.DASHBOARD_STRATUM_ORDER)


@register("mean_by_mother_education", sql=with_views(f"""
    , dim AS ({_dim_sql('fami_educacionmadre', R.MOTHER_EDU_DISPLAY_ORDER)}),
    agg AS (SELECT fami_educacionmadre, avg({Y}) AS mean_score, count(*) AS n FROM cohort GROUP BY 1)
    SELECT pos, dim.fami_educacionmadre, mean_score, n
    FROM dim JOIN agg ON dim.fami_educacionmadre = agg.fami_educacionmadre"""),
          floats=["mean_score"])
def mean_by_mother_education(spark, sf_dir):
    return gaps.mean_by_fixed_order(cohort(spark, sf_dir), "fami_educacionmadre",
                                    R.MOTHER_EDU_DISPLAY_ORDER, keep_absent=False)


@register("mean_by_nature_area", sql=with_views(f"""
    SELECT cole_naturaleza, cole_area_ubicacion, avg({Y}) AS mean_score
    FROM cohort GROUP BY 1, 2"""), floats=["mean_score"])
def mean_by_nature_area(spark, sf_dir):
    return cohort(spark, sf_dir).groupBy("cole_naturaleza", "cole_area_ubicacion") \
        .agg(F.avg(Y).alias("mean_score"))


def _heuristic_sql() -> str:
    w = K.HEURISTIC_WEIGHTS
    eq = lambda c, v: f"cast(coalesce({c} = {q(v)}, false) AS int)"
    stratum = f"coalesce({case_map('fami_estratovivienda', K.HEURISTIC_STRATUM)}, {K.HEURISTIC_DEFAULT_STRATUM})"
    mom = f"coalesce({case_map('fami_educacionmadre', K.HEURISTIC_EDUCATION)}, {K.HEURISTIC_DEFAULT_EDUCATION})"
    dad = f"coalesce({case_map('fami_educacionpadre', K.HEURISTIC_EDUCATION)}, {K.HEURISTIC_DEFAULT_EDUCATION})"
    base = (f"{K.HEURISTIC_BASE} + {w['estrato']} * {stratum} + {w['edu_madre']} * {mom} "
            f"+ {w['edu_padre']} * {dad} + {w['internet']} * {eq('fami_tieneinternet', 'Si')} "
            f"+ {w['computador']} * {eq('fami_tienecomputador', 'Si')} "
            f"+ {w['bilingue']} * {eq('cole_bilingue', 'S')} "
            f"+ ({w['oficial']}) * {eq('cole_naturaleza', 'OFICIAL')} "
            f"+ {w['urbano']} * {eq('cole_area_ubicacion', 'URBANO')}")
    est = f"greatest({K.SCORE_MIN}, least({K.SCORE_MAX}, cast({base} AS double)))"
    return f"""SELECT estu_consecutivo, {est} AS estimate,
      greatest({K.SCORE_MIN}, {est} - {K.DEFAULT_BAND}) AS lower,
      least({K.SCORE_MAX}, {est} + {K.DEFAULT_BAND}) AS upper FROM cohort"""


@register("heuristic_score_band", sql=with_views(_heuristic_sql()))
def heuristic_score_band(spark, sf_dir):
    return gaps.heuristic_score(cohort(spark, sf_dir))


@register("score_vs_reference_mean", sql=with_views(
    f"SELECT *, estimate - {K.NATIONAL_MEAN} AS delta_vs_mean FROM ({_heuristic_sql()})"))
def score_vs_reference_mean(spark, sf_dir):
    return gaps.versus_reference_mean(gaps.heuristic_score(cohort(spark, sf_dir)))
