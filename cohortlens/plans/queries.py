"""Registered queries over the driver tables (role map in ``roles.py``).

Each entry runs over whole tables; its oracle is equivalent DuckDB SQL.
"""

from __future__ import annotations

from cohortlens import constants as K
from cohortlens.functions import features as FX
from cohortlens.operators import assoc
from cohortlens.plans.cohort import cohort
from cohortlens.plans.oracle import q, with_views
from cohortlens.plans.registry import register
from cohortlens.plans import q_encode, q_linear, q_ml, q_model, q_more, q_quality, q_serving, q_stats, q_storage, q_trees  # noqa: F401

Y = K.TARGET


def _gap_sql(col: str, a: str, b: str, by: list[str]) -> str:
    keys = ", ".join(by)
    sel = (keys + ", ") if by else ""
    grp = f"GROUP BY {keys}" if by else ""
    return with_views(f"""
    , g AS (
      SELECT {sel}
        count(CASE WHEN {col} = {q(a)} THEN {Y} END) AS n_a,
        avg(CASE WHEN {col} = {q(a)} THEN {Y} END) AS mean_a,
        stddev_samp(CASE WHEN {col} = {q(a)} THEN {Y} END) AS sd_a,
        count(CASE WHEN {col} = {q(b)} THEN {Y} END) AS n_b,
        avg(CASE WHEN {col} = {q(b)} THEN {Y} END) AS mean_b,
        stddev_samp(CASE WHEN {col} = {q(b)} THEN {Y} END) AS sd_b
      FROM cohort {grp}),
    d AS (
      SELECT *, (mean_a - mean_b) / nullif(sqrt(((n_a - 1) * coalesce(sd_a * sd_a, 0)
                 + (n_b - 1) * coalesce(sd_b * sd_b, 0)) / nullif(n_a + n_b - 2, 0)), 0) AS cohens_d
      FROM g WHERE n_a > 0 AND n_b > 0)
    SELECT {sel} '{col}' AS variable, {q(a)} AS group_a, {q(b)} AS group_b,
      n_a, mean_a, sd_a, n_b, mean_b, sd_b, mean_a - mean_b AS gap, cohens_d,
      CASE WHEN cohens_d IS NULL THEN NULL WHEN abs(cohens_d) < {K.COHEN_SMALL} THEN 'small'
           WHEN abs(cohens_d) <= {K.COHEN_LARGE} THEN 'medium' ELSE 'large' END AS magnitude
    FROM d""")


# ---------------------------------------------------------------- flagship (Q12)
@register("equity_gap_by_period",
          sql=_gap_sql("fami_estratovivienda", "Estrato 6", "Estrato 1", ["periodo"]),
          floats=["mean_a", "sd_a", "mean_b", "sd_b", "gap", "cohens_d"])
def equity_gap_by_period(spark, sf_dir):
    return assoc.equity_gap(cohort(spark, sf_dir), Y, "fami_estratovivienda",
                            "Estrato 6", "Estrato 1", by=["periodo"])


@register("equity_gap",
          sql=_gap_sql("cole_naturaleza", "NO OFICIAL", "OFICIAL", []),
          floats=["mean_a", "sd_a", "mean_b", "sd_b", "gap", "cohens_d"])
def equity_gap(spark, sf_dir):
    return assoc.equity_gap(cohort(spark, sf_dir), Y, "cole_naturaleza", "NO OFICIAL", "OFICIAL")


# ---------------------------------------------------------------- features


@register("features_all",
          sql=with_views("SELECT * FROM feat", features=True))
def features_all(spark, sf_dir):
    return FX.add_deterministic_features(cohort(spark, sf_dir))
