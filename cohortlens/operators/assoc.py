"""Group gaps and association statistics.

Every statistic is a one- or two-level aggregate: the first ``groupBy`` runs a
partial (map-side) aggregate, so a hot category never sends its rows through one
task; the second level works on the tiny per-group table. Multi-column
statistics unpivot the columns (``Expand``) and aggregate all of them in a
single scan instead of one pass per column.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators.quantiles import quantile_columns


def _y(target: str) -> Column:
    return F.col(target).cast("double")


def cohen_label(d: Column) -> Column:
    ad = F.abs(d)
    return (F.when(ad.isNull(), F.lit(None).cast("string"))
            .when(ad < K.COHEN_SMALL, "small")
            .when(ad <= K.COHEN_LARGE, "medium")
            .otherwise("large"))


def equity_gap(df: DataFrame, target: str, col: str, group_a: str, group_b: str,
               by: list[str] | None = None) -> DataFrame:
    """Q11/Q12: n/mean/sd per side, gap and pooled-sd Cohen's d, one pass.

    With ``by`` (e.g. the period) the gap is computed per group in the same pass
    instead of a driver loop; groups where either side is empty are dropped.
    """
    by = list(by or [])
    y = _y(target)
    ya = F.when(F.col(col) == group_a, y)
    yb = F.when(F.col(col) == group_b, y)
    agg = (df.groupBy(*by) if by else df.groupBy()).agg(
        F.count(ya).alias("n_a"), F.avg(ya).alias("mean_a"), F.stddev_samp(ya).alias("sd_a"),
        F.count(yb).alias("n_b"), F.avg(yb).alias("mean_b"), F.stddev_samp(yb).alias("sd_b"))
    pooled = F.sqrt(F.try_divide(
        (F.col("n_a") - 1) * F.coalesce(F.col("sd_a") ** 2, F.lit(0.0))
        + (F.col("n_b") - 1) * F.coalesce(F.col("sd_b") ** 2, F.lit(0.0)),
        (F.col("n_a") + F.col("n_b") - 2).cast("double")))
    d = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.nullif(pooled, F.lit(0.0)))
    return (agg.where((F.col("n_a") > 0) & (F.col("n_b") > 0))
            .select(*by, F.lit(col).alias("variable"), F.lit(group_a).alias("group_a"),
                    F.lit(group_b).alias("group_b"), "n_a", "mean_a", "sd_a", "n_b", "mean_b",
                    "sd_b", (F.col("mean_a") - F.col("mean_b")).alias("gap"),
                    d.alias("cohens_d"), cohen_label(d).alias("magnitude")))


def group_stats(df: DataFrame, target: str, keys: list[str], min_n: int = 0,
                std: bool = True) -> DataFrame:
    """N, mean (and sample std) per key(s), HAVING n >= min_n."""
    y = _y(target)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_score")]
    if std:
        aggs.append(F.stddev_samp(y).alias("std_score"))
    out = df.groupBy(*keys).agg(*aggs)
    return out.where(F.col("n") >= min_n) if min_n else out


def temporal_trend(df: DataFrame, target: str, period: str = "periodo") -> DataFrame:
    """Q10: mean, sample std and n per period, ordered."""
    return group_stats(df, target, [period]).orderBy(period)


def category_vs_target(df: DataFrame, cat: str, target: str, order: list[str] | None = None,
                       max_label_len: int | None = None) -> DataFrame:
    """Q8: per category n, mean, std and exact quartiles; explicit order and label cut."""
    df = df.where(F.col(cat).isNotNull() & F.col(target).isNotNull())
    stats = group_stats(df, target, [cat])
    q = quantile_columns(df, target, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, [cat])
    out = stats.join(q, cat)
    label = F.col(cat)
    if max_label_len:
        label = F.when(F.length(label) > max_label_len,
                       F.concat(F.substring(label, 1, max_label_len - 1), F.lit("…"))
                       ).otherwise(label)
    pos = (F.array_position(F.array(*[F.lit(x) for x in order]), F.col(cat)) if order
           else F.lit(0).cast("bigint"))
    return out.select(label.alias("label"), cat, "n", "mean_score", "std_score", "p25", "p50",
                      "p75", pos.alias("order_pos"))


def _unpivot_cats(df: DataFrame, cats: list[str], target: str | None) -> DataFrame:
    ids = [target] if target else []
    sub = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cats])
    return sub.unpivot(ids, cats, "feature", "category")


def correlation_ratio(df: DataFrame, cats: list[str], target: str) -> DataFrame:
    """Q9: eta^2 = SSB/SST (one-way ANOVA R^2) and eta per feature, sorted desc.

    Rows with null target or null category are left out of that feature.
    """
    y = _y(target)
    # reduce first: one row per combination of categories, then fan out that table
    combos = (df.where(y.isNotNull()).groupBy(*[F.col(c).cast("string").alias(c) for c in cats])
              .agg(F.count(F.lit(1)).alias("__n"), F.sum(y).alias("__s"), F.sum(y * y).alias("__q")))
    cell = (combos.unpivot(["__n", "__s", "__q"], cats, "feature", "category")
            .where(F.col("category").isNotNull()).groupBy("feature", "category")
            .agg(F.sum("__n").alias("n"), F.sum("__s").alias("s"), F.sum("__q").alias("q")))
    feat = cell.groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"),
        F.count(F.lit(1)).alias("n_categories"))
    corr = F.col("s") * F.col("s") / F.col("n")
    eta_sq = F.try_divide(F.col("between_raw") - corr, F.nullif(F.col("q") - corr, F.lit(0.0)))
    return (feat.select("feature", "n", "n_categories", eta_sq.alias("eta_sq"))
            .withColumn("eta", F.sqrt(F.greatest(F.col("eta_sq"), F.lit(0.0))))
            .orderBy(F.col("eta_sq").desc()))


def cramers_v(df: DataFrame, cats: list[str]) -> DataFrame:
    """Q13: Cramér's V for every pair (no bias correction).

    Rows are first counted per combination of all categories; each combination then
    emits one (pair, a, b) cell per pair with its count. chi^2 = n * (sum O^2 / (row * col) - 1)
    uses only non-empty cells.
    """
    pairs = list(combinations(cats, 2))
    sub = df.groupBy(*[F.col(c).cast("string").alias(c) for c in cats]).agg(F.count(F.lit(1)).alias("__n"))
    cells = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                               F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs])
    long = sub.select("__n", F.inline(cells)).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    obs = long.groupBy("feature_a", "feature_b", "a", "b").agg(F.sum("__n").alias("o"))
    rows = obs.groupBy("feature_a", "feature_b", "a").agg(F.sum("o").alias("row_tot"))
    cols = obs.groupBy("feature_a", "feature_b", "b").agg(F.sum("o").alias("col_tot"))
    j = obs.join(rows, ["feature_a", "feature_b", "a"]).join(cols, ["feature_a", "feature_b", "b"])
    per = j.groupBy("feature_a", "feature_b").agg(
        F.sum("o").alias("n"),
        F.sum(F.col("o") * F.col("o") / (F.col("row_tot") * F.col("col_tot"))).alias("ratio"),
        F.count_distinct("a").alias("r"), F.count_distinct("b").alias("c"))
    chi2 = F.col("n") * (F.col("ratio") - 1)
    k = F.least(F.col("r"), F.col("c")) - 1
    v = F.sqrt(F.try_divide(chi2, F.nullif(F.col("n") * k, F.lit(0)).cast("double")))
    return per.select("feature_a", "feature_b", "n", chi2.alias("chi2"), v.alias("cramers_v"))


def icc(df: DataFrame, target: str, group: str) -> DataFrame:
    """Q14: ANOVA ICC(1) and between-group share of variance (one row)."""
    y = _y(target)
    g = df.where(y.isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))
    t = g.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("N"), F.sum("s").alias("S"),
              F.sum("q").alias("Q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("B"),
              F.sum(F.col("n") * F.col("n")).alias("n2"))
    ssb = F.col("B") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("Q") - F.col("B")
    msb = F.try_divide(ssb, (F.col("k") - 1).cast("double"))
    msw = F.try_divide(ssw, (F.col("N") - F.col("k")).cast("double"))
    n0 = F.try_divide(F.col("N") - F.col("n2") / F.col("N"), (F.col("k") - 1).cast("double"))
    icc1 = F.try_divide(msb - msw, F.nullif(msb + (n0 - 1) * msw, F.lit(0.0)))
    return t.select(F.col("k").alias("n_groups"), F.col("N").alias("n"), msb.alias("msb"),
                    msw.alias("msw"), n0.alias("n0"), icc1.alias("icc"),
                    F.try_divide(ssb, F.nullif(ssb + ssw, F.lit(0.0))).alias("eta_sq"))


def component_check(df: DataFrame, total: str, parts: list[str]) -> DataFrame:
    """Complete rows only; corr(total, sum parts), mean/std of the difference."""
    sub = df.select(*[F.col(c).try_cast("double").alias(c) for c in [total, *parts]]).na.drop()
    s = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    diff = F.col(total) - s
    return sub.agg(F.count(F.lit(1)).alias("n"), F.corr(F.col(total), s).alias("corr"),
                   F.avg(diff).alias("diff_mean"), F.stddev_samp(diff).alias("diff_std"))
