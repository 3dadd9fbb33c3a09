"""Target-free group aggregates with leave-one-out.

``fit`` is one partial+final aggregate per key (sum and n per indicator), so the
fitted state is a small per-group table, not a per-row window: a municipality
holding a third of all rows is summed map-side. ``transform`` joins that table
back on the key (AQE broadcasts it when its runtime size is small, otherwise a
shuffled join whose hot key is split by AQE's skew handling) and derives

* plain lookups: ``pct = sum / n``; unseen or null key -> global fallback;
* leave-one-out: ``(sum - own) / (n - 1)``; ``n < 2`` or unseen -> global.

Fallbacks are the unweighted mean over groups (null key excluded), delivered
as scalar subqueries. The pipeline stage wrapping this is
``cohortlens.operators.ml.GroupAggregatesStage``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions.features import indicator_cols

MCPIO = "estu_mcpio_reside"
DEPTO = "estu_depto_reside"
TRAIN_FLAG = "__train_row"
PCT = {"pct_estrato_alto_mcpio": "estrato_alto", "pct_internet_mcpio": "internet_si",
       "pct_oficial_mcpio": "oficial"}


def fit_lookups(df: DataFrame, mcpio: str = MCPIO, depto: str = DEPTO
                ) -> tuple[DataFrame, DataFrame]:
    """Per-municipality n and indicator sums/shares; per-department share."""
    ind = indicator_cols()
    m = df.select(F.col(mcpio).alias("key"), *[ind[v].alias(v) for v in PCT.values()]) \
        .where(F.col("key").isNotNull())
    aggs = [F.count(F.lit(1)).cast("double").alias("n")]
    for out, src in PCT.items():
        aggs += [F.sum(src).alias(f"sum_{src}"), (F.sum(src) / F.count(src)).alias(out)]
    mcpio_lookup = m.groupBy("key").agg(*aggs)
    depto_lookup = df.select(F.col(depto).alias("key"), ind["calendario_b"].alias("calendario_b")) \
        .where(F.col("key").isNotNull()).groupBy("key") \
        .agg(F.avg("calendario_b").alias("pct_calendario_b_depto"))
    return mcpio_lookup, depto_lookup


def global_fallbacks(mcpio_lookup: DataFrame, depto_lookup: DataFrame) -> dict[str, object]:
    """Unweighted mean over groups, as scalar-subquery columns."""
    m = mcpio_lookup.agg(F.struct(F.avg("n").alias("n_estudiantes_mcpio"),
                                  *[F.avg(o).alias(o) for o in PCT]).alias("s")).scalar()
    d = depto_lookup.agg(F.avg("pct_calendario_b_depto")).scalar()
    g = {k: m.getField(k) for k in ["n_estudiantes_mcpio", *PCT]}
    g["pct_calendario_b_depto"] = d
    return g


def collect_fallbacks(mcpio_lookup: DataFrame, depto_lookup: DataFrame) -> dict[str, float]:
    """The five fallbacks as Python floats, read from the (small) lookup tables."""
    m = mcpio_lookup.agg(F.avg("n").alias("n_estudiantes_mcpio"),
                         *[F.avg(o).alias(o) for o in PCT]).first().asDict()
    m["pct_calendario_b_depto"] = depto_lookup.agg(F.avg("pct_calendario_b_depto")).first()[0]
    return m


def apply_lookups(df: DataFrame, mcpio_lookup: DataFrame, depto_lookup: DataFrame,
                  leave_one_out: bool | str = False, mcpio: str = MCPIO,
                  depto: str = DEPTO, fallbacks: dict[str, float] | None = None,
                  salt: str | None = None) -> DataFrame:
    """Add the five group columns (float). ``leave_one_out`` may be a bool or the
    name of a boolean column selecting LOO per row (train rows only). ``fallbacks``
    (literals from ``collect_fallbacks``) replaces the scalar subqueries. ``salt`` names a column that
    rows and a replicated municipality lookup share (see ``sources.buckets``): both are then joined
    on (key, salt)."""
    if fallbacks is not None:
        g = {k: F.lit(v).cast("double") for k, v in fallbacks.items()}
    else:
        once = mcpio_lookup.where(F.col(salt) == 0) if salt else mcpio_lookup
        g = global_fallbacks(once, depto_lookup)
    ind = indicator_cols()
    ml = mcpio_lookup.select(F.col("key").alias("__mk"), F.col("n").alias("__n"),
                             *[F.col(f"sum_{s}").alias(f"__s_{s}") for s in PCT.values()],
                             *[F.col(o).alias(f"__p_{o}") for o in PCT],
                             *([F.col(salt).alias("__ms")] if salt else []))
    on = F.col(mcpio) == F.col("__mk")
    if salt:
        on = on & (F.col(salt) == F.col("__ms"))
    dl = depto_lookup.select(F.col("key").alias("__dk"),
                             F.col("pct_calendario_b_depto").alias("__p_cal"))
    j = df.join(ml, on, "left") \
          .join(dl, F.col(depto) == F.col("__dk"), "left")
    if isinstance(leave_one_out, str):
        loo_flag = F.coalesce(F.col(leave_one_out), F.lit(False))
    else:
        loo_flag = F.lit(bool(leave_one_out))
    out = {}
    for o, src in PCT.items():
        plain = F.coalesce(F.col(f"__p_{o}"), g[o])
        loo = F.when(F.col("__n") >= K.MIN_N_LOO,
                     (F.col(f"__s_{src}") - ind[src]) / (F.col("__n") - 1)).otherwise(g[o])
        out[o] = F.when(loo_flag, loo).otherwise(plain).cast("float")
    out["n_estudiantes_mcpio"] = F.coalesce(F.col("__n"), g["n_estudiantes_mcpio"]).cast("float")
    out["pct_calendario_b_depto"] = F.coalesce(F.col("__p_cal"),
                                               g["pct_calendario_b_depto"]).cast("float")
    keep = [c for c in df.columns if c not in out]
    return j.select(*keep, *[out[k].alias(k) for k in K.GROUP_NUMERIC_COLS])
