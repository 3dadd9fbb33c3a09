"""Metrics and diagnostics against NumPy/pandas brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd

from cohortlens.operators import diagnostics as D


def _pred(spark, n=2000, seed=7):
    rng = np.random.default_rng(seed)
    y = np.round(rng.normal(250, 40, size=n))
    p = y + rng.normal(0, 20, size=n)
    g = rng.choice(["a", "b", "c"], size=n)
    pdf = pd.DataFrame({"y_true": y, "y_pred": p, "grp": g, "id": np.arange(n)})
    return pdf, spark.createDataFrame(pdf)


def test_regression_report_and_residuals(spark):
    pdf, df = _pred(spark)
    e = pdf.y_true - pdf.y_pred
    r = D.residual_summary(df).first()
    assert abs(r["rmse"] - np.sqrt(np.mean(e ** 2))) < 1e-9
    assert abs(r["mae"] - np.mean(np.abs(e))) < 1e-9
    r2 = 1 - np.sum(e ** 2) / np.sum((pdf.y_true - pdf.y_true.mean()) ** 2)
    assert abs(r["r2"] - r2) < 1e-9
    assert abs(r["residual_std"] - e.to_numpy().std()) < 1e-9   # NumPy population std
    assert abs(r["abs_error_p90"] - np.percentile(np.abs(e), 90)) < 1e-9


def test_calibration_matches_qcut(spark):
    pdf, df = _pred(spark)
    got = D.calibration_by_bucket(df).orderBy("bucket").toPandas()
    b = pd.qcut(pdf.y_true, q=10, duplicates="drop")
    exp = pdf.groupby(b, observed=True).agg(n=("y_true", "size"), mean_true=("y_true", "mean"))
    assert list(got.n) == list(exp.n)
    assert np.allclose(got.mean_true, exp.mean_true)


def test_metrics_by_group_constant_target_and_min_n(spark):
    df = spark.createDataFrame([(1.0, 1.5, "k")] * 40 + [(2.0, 2.0, "s")] * 3,
                               "y_true double, y_pred double, grp string")
    out = D.metrics_by_group(df, "grp", min_n=30).collect()
    assert len(out) == 1 and out[0]["group"] == "k" and out[0]["r2"] is None
    empty = D.metrics_by_group(df, "grp", min_n=1000)
    assert empty.count() == 0 and "rmse" in empty.columns     # typed empty frame


def test_fairness_one_scan(spark):
    pdf, df = _pred(spark)
    df = df.withColumn("other", df.grp)
    out = D.fairness_report(df, ["grp", "other"], min_n=10).collect()
    assert {r["dimension"] for r in out} == {"grp", "other"}


def test_residual_histogram_density_integrates_to_one(spark):
    _, df = _pred(spark)
    h = D.residual_histogram(df, bins=80).toPandas()
    width = (h.bin_end - h.bin_start).iloc[0]
    assert abs((h.density * width).sum() - 1.0) < 1e-9 and h.n.sum() == 2000


def test_fold_summary_golden_numbers(spark):
    """Published group 5-fold RMSEs -> mean 40.064 and sample std 0.800 (FIXTURES §5)."""
    folds = spark.createDataFrame(
        [(i + 1, r, 0.0, 0.0) for i, r in enumerate([41.226, 39.446, 39.293, 40.5, 39.854])],
        "fold int, rmse double, mae double, r2 double")
    s = D.fold_summary(folds).first()
    assert round(s["rmse_mean"], 3) == 40.064 and round(s["rmse_std"], 3) == 0.800
    assert s["n_splits"] == 5


def test_comparison_table_picks_best_trial(spark):
    trials = spark.createDataFrame(
        [("ridge", 0, 40.1, "complete", {"alpha": 1.0}), ("ridge", 1, 39.9, "complete", {"alpha": 5.0}),
         ("lasso", 0, 41.0, "pruned", {"alpha": 2.0})],
        "model string, trial int, rmse double, state string, params map<string,double>")
    rows = D.comparison_table(trials).collect()
    assert [r["model"] for r in rows] == ["ridge", "lasso"]
    assert rows[0]["best_params"] == {"alpha": 5.0} and rows[0]["n_trials"] == 2


def test_median_pruning_rule_and_draws():
    from cohortlens.operators import tune as T
    earlier = [40.0, 41.0, 39.0, 42.0, 38.0, 40.5, 39.5, 41.5, 38.5, 40.2]
    assert not T.should_prune(99.0, earlier[:3])               # still in start-up
    assert T.should_prune(41.0, earlier)                       # worse than median 40.1
    assert not T.should_prune(39.0, earlier)
    a, b = T.draw("xgboost", 4), T.draw("xgboost", 4)
    assert a == b and 200 <= a["n_estimators"] <= 1000 and 0.01 <= a["learning_rate"] <= 0.3
    mp = T.to_mllib("xgboost", a)
    assert mp["maxIter"] == int(a["n_estimators"]) and "reg_alpha" not in mp
    assert T.to_mllib("ridge", {"alpha": 10.0}) == {"alpha": 10.0} == T.to_mllib("lasso", {"alpha": 10.0})
    forest = T.to_mllib("randomForest", T.draw("randomForest", 1))
    assert set(forest) == {"numTrees", "maxDepth", "featureSubsetStrategy", "minInstancesPerNode"}


def test_model_defaults_are_the_references(spark):
    from cohortlens.operators import ml
    ridge, lasso, forest = (ml.make_model(n) for n in ("ridge", "lasso", "forest"))
    assert ml.set_penalty(ridge, 1000, 30.0).getRegParam() == 50 * 30.0 / 1000
    assert lasso.getRegParam() == 50 and lasso.getElasticNetParam() == 1
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (400, 12, "all")
    assert all(ml.make_model(n).getMaxIter() == 400 for n in ml.GBT_PROFILES)


def test_pruning_ignores_pruned_and_running_trials():
    from cohortlens.operators import tune as T
    p = T.MedianPruner(n_startup=10)
    for k in range(10):
        assert not p.prune([90.0])          # nothing is complete enough to compare with
        p.complete([40.0 + k, 41.0 + k, 42.0 + k])
    assert p.prune([60.0]) and p.prune([44.0, 46.0]) and not p.prune([44.0]) and not p.prune([90.0 - 50])
    for _ in range(20):
        p.prune([10.0])                     # asking changes nothing
    assert p.prune([60.0])
