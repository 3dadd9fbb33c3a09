"""Dashboard aggregates and request scoring.

Each dashboard panel is one aggregate over a pruned scan; fixed label orders
are literal dimensions joined to the (tiny) aggregated result, never to rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions.features import clamp_band, is_eq, map_label


def _mean_when(cond: Column, target: str) -> Column:
    return F.avg(F.when(cond, F.col(target).cast("double")))


def kpi_gaps(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    """B8 (A8 + A16): global mean and n, and three conditional gaps, in one pass.

    Stratum gap = highest minus lowest label of the fixed order (null if either
    is absent); binary gaps treat an absent side as 0, as the dashboard does.
    """
    order = K.DASHBOARD_STRATUM_ORDER
    s = F.col("fami_estratovivienda")
    return df.agg(
        F.avg(F.col(target).cast("double")).alias("mean_global"),
        F.count(F.lit(1)).alias("n_total"),
        (_mean_when(s == order[-1], target) - _mean_when(s == order[0], target)).alias("gap_stratum"),
        (F.coalesce(_mean_when(F.col("fami_tieneinternet") == "Si", target), F.lit(0.0))
         - F.coalesce(_mean_when(F.col("fami_tieneinternet") == "No", target), F.lit(0.0))
         ).alias("gap_internet"),
        (F.coalesce(_mean_when(F.col("cole_area_ubicacion") == "URBANO", target), F.lit(0.0))
         - F.coalesce(_mean_when(F.col("cole_area_ubicacion") == "RURAL", target), F.lit(0.0))
         ).alias("gap_urban_rural"))


def mean_by_fixed_order(df: DataFrame, col: str, order: list[str], target: str = K.TARGET,
                        keep_absent: bool = True) -> DataFrame:
    """B9/B10 (L4): mean per label in a fixed order; absent labels -> null row or dropped."""
    agg = df.groupBy(col).agg(F.avg(F.col(target).cast("double")).alias("mean_score"),
                              F.count(F.lit(1)).alias("n"))
    dim = df.sparkSession.createDataFrame([(i + 1, v) for i, v in enumerate(order)],
                                          f"pos int, {col} string")
    how = "left" if keep_absent else "inner"
    return dim.join(agg, col, how).select("pos", col, "mean_score", "n")


def heuristic_score(df: DataFrame, band: float = K.DEFAULT_BAND) -> DataFrame:
    """Linear heuristic score with label maps, defaults for unknowns, clamp and band."""
    w = K.HEURISTIC_WEIGHTS
    stratum = F.coalesce(map_label(K.HEURISTIC_STRATUM, "fami_estratovivienda"),
                         F.lit(K.HEURISTIC_DEFAULT_STRATUM))
    mom = F.coalesce(map_label(K.HEURISTIC_EDUCATION, "fami_educacionmadre"),
                     F.lit(K.HEURISTIC_DEFAULT_EDUCATION))
    dad = F.coalesce(map_label(K.HEURISTIC_EDUCATION, "fami_educacionpadre"),
                     F.lit(K.HEURISTIC_DEFAULT_EDUCATION))
    base = (F.lit(K.HEURISTIC_BASE) + w["estrato"] * stratum + w["edu_madre"] * mom
            + w["edu_padre"] * dad + w["internet"] * is_eq("fami_tieneinternet", "Si")
            + w["computador"] * is_eq("fami_tienecomputador", "Si")
            + w["bilingue"] * is_eq("cole_bilingue", "S")
            + w["oficial"] * is_eq("cole_naturaleza", "OFICIAL")
            + w["urbano"] * is_eq("cole_area_ubicacion", "URBANO"))
    est = F.greatest(F.lit(K.SCORE_MIN), F.least(F.lit(K.SCORE_MAX), base.cast("double")))
    lower, upper = clamp_band(est, band)
    return df.select("estu_consecutivo", est.alias("estimate"), lower.alias("lower"),
                     upper.alias("upper"))


def versus_reference_mean(scores: DataFrame, col: str = "estimate",
                          reference: float = K.NATIONAL_MEAN) -> DataFrame:
    """Difference of each estimate to the national reference mean."""
    return scores.withColumn("delta_vs_mean", F.col(col) - F.lit(reference))


def score_requests(model, requests: DataFrame, rmse: float | Column = K.DEFAULT_BAND,
                   pred_col: str = "prediction") -> DataFrame:
    """Batch scoring of a request table with a fitted pipeline, +-1 RMSE band clamped."""
    out = model.transform(requests)
    lower, upper = clamp_band(F.col(pred_col), rmse)
    return out.withColumn("lower", lower).withColumn("upper", upper)
