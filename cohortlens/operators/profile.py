"""Data-quality audit.

Column-wise statistics unpivot the table once (``Expand``) and aggregate all
columns together, instead of one scan per column. Distinct counts and modal
values aggregate on (column, value) with map-side combine, so a dominant value
collapses before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.quantiles import exact_quantiles, quantile_columns


def _long_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    sub = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return sub.unpivot([], cols, "column", "value")


def missing_summary(df: DataFrame) -> DataFrame:
    """Q2: per column null count and percentage, most missing first (one aggregate pass)."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot(["__n"], cols, "column", "missing")
    return long.select("column", F.col("missing").cast("bigint").alias("missing"),
                       (100.0 * F.col("missing") / F.col("__n")).alias("pct"))


def top_missing(df: DataFrame, k: int = 15) -> DataFrame:
    """Q4: the k most-missing columns (ties by name); top-k is the feature."""
    return missing_summary(df).orderBy(F.col("missing").desc(), F.col("column")).limit(k)


def schema_summary(df: DataFrame, target: str | None = None) -> DataFrame:
    """Q1: dtype, nulls, pct nulls, distinct non-null values, is_target per column."""
    cols = df.columns
    n = df.agg(F.count(F.lit(1))).scalar()
    stats = _long_strings(df, cols).groupBy("column").agg(
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.count_distinct("value").alias("n_unique"))
    dtypes = df.sparkSession.createDataFrame(
        [(c, t) for c, t in df.dtypes], "column string, dtype string")
    return stats.join(dtypes, "column").select(
        "column", "dtype", F.col("n_null").cast("bigint").alias("n_null"),
        (100.0 * F.col("n_null") / n).alias("pct_null"), "n_unique",
        (F.col("column") == F.lit(target or "")).alias("is_target"))


def nulls_by_period(df: DataFrame, col: str, period: str = "periodo") -> DataFrame:
    """Q3: per period n, nulls of ``col`` and their share."""
    return df.groupBy(period).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(col).isNull()).alias("nulls")
    ).select(period, "n", F.col("nulls").cast("bigint").alias("nulls"),
             (100.0 * F.col("nulls") / F.col("n")).alias("pct_null"))


def low_variance(df: DataFrame, threshold: float = 99.0, cols: list[str] | None = None) -> DataFrame:
    """Q6: modal non-null value per column and its share of ALL rows; drop flag.

    Ties between equally frequent values go to the smallest value.
    """
    cols = cols or df.columns
    n = df.agg(F.count(F.lit(1))).scalar()
    cnt = _long_strings(df, cols).where(F.col("value").isNotNull()) \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    top = cnt.groupBy("column").agg(
        F.min_by(F.struct("value", "cnt"), F.struct(-F.col("cnt"), F.col("value"))).alias("t"))
    pct = 100.0 * F.col("t.cnt") / n
    return top.select("column", F.col("t.value").alias("top_value"), pct.alias("pct"),
                      (pct >= threshold).alias("drop"))


def numeric_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long table per column: n, nulls, mean, std, min, p25, p50, p75, max, skew.

    ``skew`` is the population (biased) skewness; quantiles are exact and linear.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "column", "x")
    x = F.col("x")
    base = long.groupBy("column").agg(
        F.count(x).alias("n"), F.count_if(x.isNull()).alias("nulls"), F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.skewness(x).alias("skew"))
    q = quantile_columns(long, "x", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["column"])
    return base.join(q, "column", "left").select(
        "column", "n", F.col("nulls").cast("bigint").alias("nulls"), "mean", "std", "min",
        "p25", "p50", "p75", "max", "skew")


def describe(df: DataFrame, cols: list[str], quartiles: bool = False) -> DataFrame:
    """Count, mean, std, min, max per numeric column (typed, long form), with ``quartiles``
    also p25, p50, p75 (exact, interpolated)."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "column", "x")
    x = F.col("x")
    out = long.groupBy("column").agg(F.count(x).alias("count"), F.avg(x).alias("mean"),
                                     F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                                     F.max(x).alias("max"))
    if not quartiles:
        return out
    q = quantile_columns(long, "x", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["column"])
    return out.join(q, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Fixed-width bins over [min, max]; the max lands in the last bin.

    Bin edges come from scalar min/max; ``density = n / (N * width)``.
    """
    x = F.col(col).cast("double")
    sub = df.select(x.alias("x")).where(F.col("x").isNotNull())
    mm = sub.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"),
                          F.count(F.lit(1)).alias("N")).alias("s")).scalar()
    lo, hi, total = mm.getField("lo"), mm.getField("hi"), mm.getField("N")
    width = (hi - lo) / bins
    b = F.least(F.floor(F.try_divide(F.col("x") - lo, F.nullif(width, F.lit(0.0)))),
                F.lit(bins - 1))
    b = F.coalesce(b, F.lit(0)).cast("int")
    return sub.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        "bin", (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"), "n",
        F.try_divide(F.col("n").cast("double"), F.nullif(total * width, F.lit(0.0))).alias("density"))


def group_size_summary(df: DataFrame, group: str) -> DataFrame:
    """Median and mean number of rows per group."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    med = exact_quantiles(sizes, "n", [0.5]).select("quantile").scalar()
    return sizes.agg(F.count(F.lit(1)).alias("n_groups"), F.avg("n").alias("mean_size"),
                     med.alias("median_size"))
