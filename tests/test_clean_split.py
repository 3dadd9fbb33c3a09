"""Cleaning (W1, W2, Q5, Q15, J3) and splits."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators import clean, split
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort, raw_records
from tests.conftest import SF001

KEY = "estu_consecutivo"


def test_keep_first_equals_window_version(spark):
    raw = raw_records(spark, SF001)
    w = Window.partitionBy(KEY).orderBy(*R.RAW_ORDER_COLS)
    exp = raw.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    got = clean.dedupe_keep_first(raw, KEY, R.RAW_ORDER_COLS)
    assert got.count() == exp.count()
    assert got.exceptAll(exp.select(*got.columns)).count() == 0


def test_clean_order_dedupe_then_filter(spark):
    raw = raw_records(spark, SF001)
    out = clean.clean_records(raw, KEY, R.RAW_ORDER_COLS)
    assert KEY not in out.columns
    assert out.where(F.col("punt_global").isNull()).count() == 0
    firsts = clean.dedupe_keep_first(raw, KEY, R.RAW_ORDER_COLS)
    assert out.count() == firsts.where(F.col("punt_global").isNotNull()).count()


def test_duplicate_report_and_drilldown(spark):
    raw = raw_records(spark, SF001)
    rep = clean.duplicate_report(raw, [KEY]).first()
    assert rep["n_rows"] - rep["n_distinct"] == rep["n_duplicates"] > 0
    top = clean.most_repeated(raw, KEY, R.RAW_ORDER_COLS)
    mx = raw.groupBy(KEY).count().agg(F.max("count")).first()[0]
    assert top.count() > 0 and {r["duplicate_count"] for r in top.collect()} == {mx}
    semi = clean.rows_of_duplicated_ids(raw, KEY)
    assert semi.count() == raw.groupBy(KEY).count().where("count > 1") \
        .agg(F.sum("count")).first()[0]


def test_stratified_split_exact_per_stratum(spark):
    c = cohort(spark, SF001).select(KEY, "periodo")
    s = split.stratified_split(c, KEY, "periodo", 0.2)
    per = s.groupBy("periodo").agg(F.count("*").alias("n"),
                                   F.count_if(F.col("role") == "test").alias("t")).collect()
    for r in per:
        assert r["t"] == int(round(0.2 * r["n"] + 1e-9)) or abs(r["t"] - 0.2 * r["n"]) <= 0.5
    again = split.stratified_split(c, KEY, "periodo", 0.2)
    assert s.exceptAll(again).count() == 0                      # reproducible


def test_kfold_and_group_kfold(spark):
    c = cohort(spark, SF001)
    f = split.kfold_assign(c.select(KEY), KEY, 5).groupBy("fold").count().collect()
    sizes = sorted(r["count"] for r in f)
    assert len(sizes) == 5 and sizes[-1] - sizes[0] <= 1
    g = split.group_kfold_assign(c.select(KEY, "estu_mcpio_reside"), "estu_mcpio_reside", 5)
    per_group = g.groupBy("group_key").agg(F.count_distinct("fold").alias("k")).collect()
    assert all(r["k"] == 1 for r in per_group)                  # groups never split
    cf = split.contiguous_kfold(c.select(KEY), KEY, 3).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in cf)[-1] - sorted(r["count"] for r in cf)[0] <= 1


def test_temporal_split_raises_on_empty_side(spark):
    c = cohort(spark, SF001)
    with pytest.raises(ValueError):
        split.temporal_split(c, "periodo", "99999", check=True)
    ok = split.temporal_split(c, "periodo", R.TRAIN_UNTIL, check=True)
    assert ok.where("role = 'test'").count() > 0


def test_seeded_sample_is_reproducible(spark):
    c = cohort(spark, SF001).select(KEY)
    a = split.seeded_sample(c, KEY, 50).collect()
    b = split.seeded_sample(c, KEY, 50).collect()
    assert a == b and len(a) == 50


def test_duplicated_rows_are_not_sorted(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, "d"), (3, "e")]
    out = clean.rows_of_duplicated_ids(spark.createDataFrame(rows, f"{KEY} long, x string"), KEY)
    assert sorted((r[KEY], r["x"]) for r in out.collect()) == [(1, "a"), (1, "a"), (3, "d"), (3, "e")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = clean.rows_of_duplicated_ids(raw_records(spark, SF001), KEY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
