"""Preprocessing (M1-M8) as fitted state + column expressions.

Fitted state is tiny (one mode / median / mean / std per column, or a
vocabulary per column) and is computed with partial aggregates; applying it is
a projection or a join with a small vocabulary table, never a per-row UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.quantiles import quantile_columns, row_number_in_groups, select_folded


def _long(df: DataFrame, cols: list[str], as_type: str = "string") -> DataFrame:
    sub = df.select(*[F.col(c).cast(as_type).alias(c) for c in cols])
    return sub.unpivot([], cols, "column", "value")


def fit_modes(df: DataFrame, cols: list[str]) -> Column:
    """M1: most frequent non-null value per column (ties -> smallest), as ONE scalar struct.

    (column, value) counts are a partial aggregate, so a dominant value never
    lands whole in one task (unlike a per-column value->count map)."""
    cnt = _long(df, cols).where(F.col("value").isNotNull()).groupBy("column", "value") \
        .agg(F.count(F.lit(1)).alias("cnt"))
    top = cnt.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("mode"))
    wide = top.agg(*[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(c) for c in cols])
    return wide.select(F.struct(*cols).alias("m")).scalar()


def impute_modes(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    m = fit_modes(fit_on if fit_on is not None else df, cols)
    return df.select(*[(F.coalesce(F.col(c).cast("string"), m.getField(c)).alias(c) if c in cols
                        else F.col(c)) for c in df.columns])


def fit_medians(df: DataFrame, cols: list[str]) -> Column:
    """M2: exact median per numeric column (linear interpolation), as one scalar struct.

    One exact selection for all columns (see quantiles.select_ranks)."""
    long = _long(df, cols, "double").where(F.col("value").isNotNull())
    med = quantile_columns(long, "value", {"median": 0.5}, ["column"])
    return _medians_wide(med, cols).select(F.struct(*cols).alias("m")).scalar()


def _medians_wide(med: DataFrame, cols: list[str]) -> DataFrame:
    return med.agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in cols])


def collect_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact medians as Python floats (one value per column) for fitted models.

    Model inputs are mostly codes, flags and shares of a group, which repeat: (column, value) is folded first."""
    long = _long(df, cols, "double").where(F.col("value").isNotNull())
    rows = quantile_columns(long, "value", {"median": 0.5}, ["column"], select_folded).collect()
    got = {r["column"]: r["median"] for r in rows}
    return {c: got.get(c) for c in cols}


def impute_medians(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    m = fit_medians(fit_on if fit_on is not None else df, cols)
    return df.select(*[(F.coalesce(F.col(c).cast("double"), m.getField(c)).alias(c) if c in cols
                        else F.col(c)) for c in df.columns])


def ordinal_explicit(col: str, order: list[str]) -> Column:
    """M3: index in an explicit order; unknown -> -1; null stays null."""
    return (F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)) - 1).cast("int")


def fit_vocab(df: DataFrame, cols: list[str]) -> DataFrame:
    """M4/M5: learned sorted categories per column: (column, value, idx 0-based)."""
    distinct = _long(df, cols).where(F.col("value").isNotNull()).select("column", "value").distinct()
    ranked = row_number_in_groups(distinct, ["column"], ["value"], name="idx")
    return ranked.withColumn("idx", (F.col("idx") - 1).cast("int"))


def ordinal_learned(df: DataFrame, cols: list[str], vocab: DataFrame, id_col: str) -> DataFrame:
    """M4: per column learned index; unknown or null -> -1. Each column meets its own
    vocabulary in one equi-join on the row (broadcast by Spark's size check when small)."""
    out = df.select(id_col, *cols)
    for c in cols:
        v = vocab.where(F.col("column") == c).select(F.col("value").alias("__v"), F.col("idx").alias("__i"))
        rest = [out[x] for x in out.columns if x != c]
        out = out.join(v, out[c].cast("string") == v["__v"], "left") \
            .select(*rest, F.coalesce("__i", F.lit(-1)).alias(c))
    return out.select(id_col, *cols)


def one_hot_long(df: DataFrame, cols: list[str], vocab: DataFrame, id_col: str) -> DataFrame:
    """M6: one-hot in long form: (id, feature, category, slot); slot -1 = all-zero vector
    (unknown or null category, like ``handle_unknown='ignore'``)."""
    long = df.select(id_col, *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([id_col], cols, "feature", "category")
    v = vocab.select(F.col("column").alias("feature"), F.col("value").alias("category"),
                     F.col("idx").alias("slot"))
    return long.join(v, ["feature", "category"], "left") \
        .select(id_col, "feature", "category", F.coalesce("slot", F.lit(-1)).alias("slot"))


def fit_scaler(df: DataFrame, cols: list[str]) -> Column:
    """M8: mean and POPULATION std per column (sklearn parity), one scalar struct."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    s = df.agg(*aggs)
    return s.select(F.struct(*s.columns).alias("s")).scalar()


def standard_scale(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """M8: (x - mean) / std; a zero std scales by 1 (as sklearn does)."""
    s = fit_scaler(fit_on if fit_on is not None else df, cols)
    out = []
    for c in df.columns:
        if c in cols:
            std = s.getField(f"{c}__std")
            scale = F.when(std == 0, F.lit(1.0)).otherwise(std)
            out.append(((F.col(c).cast("double") - s.getField(f"{c}__mean")) / scale).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
