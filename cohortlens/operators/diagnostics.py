"""Regression metrics and diagnostics (E6, D1-D7, E4, E7/E9 summaries).

All metrics are single aggregates over (y, y_hat) rows; per-group variants are
one ``groupBy`` (fairness dimensions unpivoted so five dimensions cost one scan).
Percentiles and calibration edges come from the exact distributed quantiles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators.profile import histogram
from cohortlens.operators.quantiles import exact_quantiles, quantile_columns
from cohortlens.operators.split import seeded_sample


def metric_exprs(y: str = "y_true", p: str = "y_pred") -> dict[str, Column]:
    """RMSE, MAE, R^2 (= 1 - SSres/SStot; null when y is constant), n."""
    e = F.col(y) - F.col(p)
    ss_tot = F.var_pop(F.col(y)) * F.count(F.col(y))
    return {
        "n": F.count(F.lit(1)),
        "rmse": F.sqrt(F.avg(e * e)),
        "mae": F.avg(F.abs(e)),
        "r2": 1 - F.try_divide(F.sum(e * e), F.nullif(ss_tot, F.lit(0.0))),
    }


def regression_report(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """One-row metrics."""
    m = metric_exprs(y, p)
    return df.agg(*[v.alias(k) for k, v in m.items()])


def residual_summary(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Metrics + residual mean, population std, abs-error percentiles (linear)."""
    m = metric_exprs(y, p)
    e = F.col(y) - F.col(p)
    base = df.agg(*[v.alias(k) for k, v in m.items()], F.avg(e).alias("residual_mean"),
                  F.stddev_pop(e).alias("residual_std"))
    probs = {"abs_error_p50": 0.5, "abs_error_p75": 0.75, "abs_error_p90": 0.9,
             "abs_error_p95": 0.95, "abs_error_p99": 0.99}
    qs = quantile_columns(df.select(F.abs(e).alias("ae")), "ae", probs) \
        .select(F.struct(*probs).alias("s")).scalar()
    return base.select("*", *[qs.getField(k).alias(k) for k in probs])


def calibration_by_bucket(df: DataFrame, y: str = "y_true", p: str = "y_pred",
                          n_buckets: int = 10) -> DataFrame:
    """Quantile buckets of y (duplicate edges dropped, right-closed, lowest included).

    bucket = max(#edges strictly below y, 1) - 1, with distinct exact quantile edges.
    """
    probs = [i / n_buckets for i in range(n_buckets + 1)]
    edges = exact_quantiles(df, y, probs).agg(
        F.array_distinct(F.array_sort(F.collect_list("quantile"))).alias("e")).scalar()
    yc = F.col(y)
    bucket = F.greatest(F.size(F.filter(F.col("__edges"), lambda x: x < yc)), F.lit(1)) - 1
    e = F.col(y) - F.col(p)
    return df.withColumn("__edges", edges).withColumn("bucket", bucket) \
        .groupBy("bucket", "__edges").agg(
            F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_true"), F.avg(p).alias("mean_pred"),
            F.avg(e).alias("bias"), F.sqrt(F.avg(e * e)).alias("rmse"),
        ).select("bucket",
                 F.try_element_at("__edges", (F.col("bucket") + 1).cast("int")).alias("lower_edge"),
                 F.try_element_at("__edges", (F.col("bucket") + 2).cast("int")).alias("upper_edge"),
                 "n", "mean_true", "mean_pred", "bias", "rmse")


def _group_metrics(g: DataFrame, keys: list[str], y: str, p: str, min_n: int) -> DataFrame:
    m = metric_exprs(y, p)
    e = F.col(y) - F.col(p)
    out = g.groupBy(*keys).agg(
        *[v.alias(k) for k, v in m.items()], F.min(y).alias("__ymin"), F.max(y).alias("__ymax"),
        F.avg(y).alias("mean_true"), F.avg(p).alias("mean_pred"), F.avg(e).alias("bias"))
    r2 = F.when(F.col("__ymin") < F.col("__ymax"), F.col("r2"))
    return out.where(F.col("n") >= min_n).select(
        *keys, "n", "rmse", "mae", r2.alias("r2"), "mean_true", "mean_pred", "bias")


def metrics_by_group(df: DataFrame, group: str, y: str = "y_true", p: str = "y_pred",
                     min_n: int = 30) -> DataFrame:
    """D3: per group (null kept) n, rmse, mae, r2 (null if y constant), means, bias; by rmse."""
    return _group_metrics(df.withColumn("group", F.col(group).cast("string")), ["group"],
                          y, p, min_n).orderBy("rmse")


def fairness_report(df: DataFrame, cols: list[str] | None = None, y: str = "y_true",
                    p: str = "y_pred", min_n: int = 100) -> DataFrame:
    """D3 for several dimensions in ONE scan (dimensions unpivoted)."""
    cols = [c for c in (cols or K.FAIRNESS_COLS) if c in df.columns]
    sub = df.select(y, p, *[F.col(c).cast("string").alias(c) for c in cols])
    long = sub.unpivot([y, p], cols, "dimension", "group")
    return _group_metrics(long, ["dimension", "group"], y, p, min_n)


def residual_histogram(df: DataFrame, y: str = "y_true", p: str = "y_pred",
                       bins: int = 80) -> DataFrame:
    """Density histogram of residuals (80 equal-width bins)."""
    return histogram(df.select((F.col(y) - F.col(p)).alias("residual")), "residual", bins)


def scatter_sample(df: DataFrame, id_col: str, y: str = "y_true", p: str = "y_pred",
                   n: int = 20_000) -> DataFrame:
    """Reproducible sample (all rows when fewer than n) of (y, y_hat, residual)."""
    s = seeded_sample(df.select(id_col, y, p), id_col, n)
    return s.withColumn("residual", F.col(y) - F.col(p))


def density_by_group(df: DataFrame, id_col: str, group: str, value: str, n: int = 20_000,
                     bins: int = 40) -> DataFrame:
    """Per-group density of ``value`` on a common fixed-width grid over a sample."""
    s = seeded_sample(df.select(id_col, group, value), id_col, n)
    mm = s.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("m")).scalar()
    lo, hi = mm.getField("lo"), mm.getField("hi")
    width = (hi - lo) / bins
    b = F.coalesce(F.least(F.floor(F.try_divide(F.col(value) - lo, F.nullif(width, F.lit(0.0)))),
                           F.lit(bins - 1)), F.lit(0)).cast("int")
    cnt = s.groupBy(group, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    tot = s.groupBy(group).agg(F.count(F.lit(1)).alias("n_group"))
    return cnt.join(tot, group).select(
        group, "bin", (lo + F.col("bin") * width).alias("bin_start"), "n",
        F.try_divide(F.col("n").cast("double"), F.col("n_group") * width).alias("density"))


def kernel_density(df: DataFrame, group: str, value: str, cells: int = 512, steps: int = 100) -> DataFrame:
    """Gaussian kernel density of ``value`` by group at ``steps`` + 1 points of the common range,
    over all rows: (group, step, x, n_group, bandwidth, density).

    Values are counted in ``cells`` equal cells of the range first (one partial aggregate); each cell then
    contributes to every point, cells x steps rows a group whatever the rows. The bandwidth is
    1.06 min(standard deviation, interquartile range / 1.34) n^-0.2, from the values themselves; a group
    without spread has none and no density."""
    v = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    span = v.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    lo, width = span.getField("lo"), span.getField("hi") - span.getField("lo")
    cell = F.coalesce(F.least(F.floor(F.try_divide(F.col("v") - lo, F.nullif(width, F.lit(0.0))) * cells), F.lit(cells - 1)), F.lit(0))
    counts = v.groupBy("g", cell.cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    spread = quantile_columns(v, "v", {"q1": 0.25, "q3": 0.75}, ["g"]).select(F.col("g").alias("qg"), "q1", "q3")
    by = v.groupBy("g").agg(F.count(F.lit(1)).alias("n_group"), F.stddev_samp("v").alias("sd"))
    h = 1.06 * F.least(F.col("sd"), F.when(F.col("q3") > F.col("q1"), (F.col("q3") - F.col("q1")) / 1.34)) * F.pow("n_group", F.lit(-0.2))
    by = by.join(spread, F.col("g").eqNullSafe(F.col("qg"))).select(F.col("g").alias("hg"), "n_group", F.when(h > 0, h).alias("bandwidth"))
    x = lo + F.col("step") / steps * width
    z = (x - (lo + (F.col("cell") + 0.5) / cells * width)) / F.col("bandwidth")
    points = (counts.join(by, F.col("g").eqNullSafe(F.col("hg")))
              .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps)))))
    return (points.groupBy("g", "step", "n_group", "bandwidth").agg(F.sum(F.col("n") * F.exp(-z * z / 2)).alias("s"))
            .select(F.col("g").alias(group), "step", x.alias("x"), "n_group", "bandwidth",
                    (F.col("s") / (F.col("n_group") * F.col("bandwidth") * (2 * math.pi) ** 0.5)).alias("density")))


def fold_summary(folds: DataFrame) -> DataFrame:
    """E7 summary: mean and sample std of fold RMSE, mean MAE and R^2."""
    return folds.agg(F.count(F.lit(1)).alias("n_splits"), F.avg("rmse").alias("rmse_mean"),
                     F.stddev_samp("rmse").alias("rmse_std"), F.avg("mae").alias("mae_mean"),
                     F.avg("r2").alias("r2_mean"))


def comparison_table(trials: DataFrame) -> DataFrame:
    """Per model best CV RMSE, number of trials and the best trial's params."""
    return trials.groupBy("model").agg(
        F.min("rmse").alias("best_cv_rmse"), F.count(F.lit(1)).alias("n_trials"),
        F.min_by("params", F.struct("rmse", "trial")).alias("best_params"),
    ).orderBy("best_cv_rmse")
