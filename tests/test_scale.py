"""Scale properties: hot keys, plan shape, leave-one-out only on training rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators import clean, ml
from cohortlens.operators import groupagg as G
from cohortlens.operators.quantiles import quantile_columns, row_number_in_groups
from cohortlens.plans.registry import REGISTRY
from cohortlens.plans import queries  # noqa: F401
from tests.conftest import SF001


def _skewed(spark, n=6000):
    """Key 'HOT' holds 40% of all rows."""
    rows = [(i, "HOT" if i % 5 < 2 else f"k{i % 50}", float((i * 7919) % 1000) / 10.0)
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, key string, v double").repartition(4)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_rank_matches_window_and_spreads(spark):
    df = _skewed(spark)
    w = Window.partitionBy("key").orderBy("v", "id")
    exp = {r["id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    got = {r["id"]: r["rn"] for r in row_number_in_groups(df, ["key"], ["v", "id"]).collect()}
    assert got == exp
    spread = df.repartitionByRange(8, "key", "v", "id").where("key = 'HOT'") \
        .select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread >= 2                                   # the hot key is split across tasks


def test_hot_key_quantiles(spark):
    df = _skewed(spark)
    pdf = df.toPandas()
    hot = np.sort(pdf[pdf.key == "HOT"].v.to_numpy())
    q = quantile_columns(df, "v", {"p50": 0.5, "p90": 0.9}, ["key"]).where("key = 'HOT'").first()
    assert np.allclose([q["p50"], q["p90"]], np.percentile(hot, [50, 90]))


def test_dedupe_is_an_aggregate_not_a_window(spark):
    df = _skewed(spark)
    out = clean.dedupe_keep_first(df, "key", ["v", "id"])
    rows = out.collect()
    plan = _plan(out)
    assert "Window" not in plan
    assert any(a in plan for a in ("HashAggregate", "ObjectHashAggregate", "SortAggregate"))
    first = df.groupBy("key").agg(F.min(F.struct("v", "id")).alias("s")).collect()
    assert {(r["key"], r["v"], r["id"]) for r in rows} == \
        {(r["key"], r["s"]["v"], r["s"]["id"]) for r in first}


def test_flagship_scan_is_pruned_and_partially_aggregated(spark):
    df = REGISTRY["equity_gap_by_period"].build(spark, SF001)
    df.collect()
    plan = _plan(df)
    read = [ln for ln in df._jdf.queryExecution().executedPlan().toString().split("\n")
            if "FileScan parquet" in ln or "Scan parquet" in ln]
    orders_scan = [ln for ln in read if "o_orderpriority" in ln]
    assert orders_scan and all("o_orderkey" not in ln for ln in orders_scan)
    assert "c_acctbal" not in plan and "c_name" not in plan
    assert "partial_" in plan                            # map-side partial aggregation


def test_loo_only_for_flagged_training_rows(students):
    stage = ml.GroupAggregatesStage().fit(students)
    flagged = stage.transform(students.withColumn(G.TRAIN_FLAG, F.lit(True))).collect()
    plain = stage.transform(students).collect()
    m, d = G.fit_lookups(students)
    exp_loo = {r["estu_consecutivo"]: r["pct_internet_mcpio"]
               for r in G.apply_lookups(students, m, d, True).collect()}
    exp_plain = {r["estu_consecutivo"]: r["pct_internet_mcpio"]
                 for r in G.apply_lookups(students, m, d, False).collect()}
    assert all(abs(r["pct_internet_mcpio"] - exp_loo[r["estu_consecutivo"]]) < 1e-6 for r in flagged)
    assert all(abs(r["pct_internet_mcpio"] - exp_plain[r["estu_consecutivo"]]) < 1e-6 for r in plain)


def test_group_lookups_and_cuts_do_not_shuffle_wide_rows(spark, students):
    """Fitted tables have a size the planner knows (before: checkpoints of unknown size, so the wide rows
    were shuffled and sorted by keys of few values)."""
    from cohortlens.operators import ml, split
    from cohortlens.session import cut_lineage

    df = cut_lineage(students)
    looked_up = ml.GroupAggregatesStage().fit(df).transform(df)
    cut = split.stratified_split(df, "estu_consecutivo")
    folds = split.group_kfold_assign(df, "estu_mcpio_reside", 3)
    for got in (looked_up, cut, folds):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan, plan
        assert got.count() == df.count()


def test_rows_dealt_to_a_task_stay_bounded(spark, tmp_path, monkeypatch):
    """Wide rows of the fits are dealt to as many tasks as the orders need, not to a fixed number."""
    from cohortlens.plans import q_ml
    spark.range(900).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    rows = spark.range(900).select(F.col("id").alias("estu_consecutivo"))
    assert q_ml._dealt(rows, str(tmp_path)).rdd.getNumPartitions() == 8  # few rows: the session's number
    monkeypatch.setattr(q_ml, "TASK_ROWS", 50)
    dealt = q_ml._dealt(rows, str(tmp_path))
    assert dealt.rdd.getNumPartitions() == 18
    assert max(dealt.rdd.glom().map(len).collect()) < 200 and dealt.count() == 900
