"""Cleaning batch (LC1): dedupe, drop, filter, sink; duplicate audit.

Keep-first dedupe is an aggregate, not a window: ``min(struct(order..., rest...))``
per id runs a partial (map-side) aggregate, so an id repeated in a third of all
rows collapses inside each map task instead of landing in one window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators.quantiles import row_number_in_groups


def _payload(df: DataFrame, key: str, order: list[str]) -> list[str]:
    return order + [c for c in df.columns if c != key and c not in order]


def dedupe_keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the first by ``order`` (a total order over the other columns).

    Rows with a null key are dropped, mirroring a non-null running count.
    """
    cols = _payload(df, key, order)
    first = F.min(F.struct(*[F.col(c) for c in cols])).alias("__r")
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(first)
    return out.select(*[(F.col(key) if c == key else F.col(f"__r.{c}").alias(c)) for c in df.columns])


def duplicate_rank(df: DataFrame, key: str, order: list[str],
                   name: str = "duplicate_count") -> DataFrame:
    """Running count per id in ``order`` (= row_number), skew-safe; null ids dropped.

    Rows are numbered where they lie, so k identical rows are k rows numbered 1..k."""
    return row_number_in_groups(df.where(F.col(key).isNotNull()), [key], order, name=name)


def duplicate_report(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Q5: total rows, distinct rows over ``subset`` (default all columns), surplus, pct."""
    cols = subset or df.columns
    n_distinct = df.select(*cols).distinct().agg(F.count(F.lit(1))).scalar()
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(",".join(subset) if subset else "*").alias("subset"), "n_rows",
        n_distinct.alias("n_distinct"),
        (F.col("n_rows") - n_distinct).alias("n_duplicates"),
        F.try_divide(100.0 * (F.col("n_rows") - n_distinct),
                     F.col("n_rows").cast("double")).alias("pct_duplicates"))


def most_repeated(df: DataFrame, key: str, order: list[str],
                  name: str = "duplicate_count") -> DataFrame:
    """Q15: for the ids with the most copies, the copy whose running count is that maximum.

    Per-id count and last copy come from one partial aggregate; the maximum is a
    scalar subquery; no window over a hot id.
    """
    cols = _payload(df, key, order)
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(name), F.max(F.struct(*[F.col(c) for c in cols])).alias("__r"))
    top = per.agg(F.max(name)).scalar()
    return per.where(F.col(name) == top).select(
        *[(F.col(key) if c == key else F.col(f"__r.{c}").alias(c)) for c in df.columns], name)


def rows_of_duplicated_ids(df: DataFrame, key: str) -> DataFrame:
    """All rows whose id occurs more than once (left-semi join, never a driver list).

    The ids, one narrow row each, are hashed; the wide rows stream past them. A merge join would
    sort the wide rows, which spills them."""
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select(key)
    return df.join(dup.hint("shuffle_hash"), key, "left_semi")


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop a column list (missing names are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def cast_numeric(df: DataFrame, cols: list[str], to: str = "bigint") -> DataFrame:
    """Lenient bulk cast (bad values -> null, like ``errors='coerce'``)."""
    return df.select(*[(F.col(c).try_cast(to).alias(c) if c in cols else F.col(c))
                       for c in df.columns])


def clean_records(df: DataFrame, key: str = "estu_consecutivo", order: list[str] | None = None,
                  target: str = K.TARGET, drop: list[str] | None = None) -> DataFrame:
    """LC1 canonical order: keep-first dedupe, drop columns, then target not-null."""
    order = order or [c for c in df.columns if c != key]
    out = dedupe_keep_first(df, key, order)
    out = drop_columns(out, K.CLEAN_DROP_COLS if drop is None else drop)
    return out.where(F.col(target).isNotNull())
