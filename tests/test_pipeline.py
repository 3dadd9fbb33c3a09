"""End-to-end pipeline: predictions, save/load round trip, attributions (R*, S8, I1)."""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortlens.operators import explain as X
from cohortlens.operators import ml
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort
from tests.conftest import SF001


def _parts(spark):
    c = cohort(spark, SF001)
    return c.where(F.col("periodo") <= R.TRAIN_UNTIL), c.where(F.col("periodo") > R.TRAIN_UNTIL)


def test_predictions_finite_and_complete(spark):
    tr, te = _parts(spark)
    model = ml.fit_train(ml.build_pipeline("tree", {"maxDepth": 4}, tr.columns), tr)
    p = ml.predict(model, te).toPandas()
    assert len(p) == te.count() and np.isfinite(p.y_pred).all()
    naive = np.sqrt(np.mean((p.y_true - tr.agg(F.avg("punt_global")).first()[0]) ** 2))
    rmse = np.sqrt(np.mean((p.y_true - p.y_pred) ** 2))
    assert rmse < naive                                          # beats the mean


def test_save_load_roundtrip(spark):
    tr, te = _parts(spark)
    model = ml.fit_train(ml.build_pipeline("ridge", {"regParam": 0.1}, tr.columns), tr)
    path = os.path.join(tempfile.mkdtemp(prefix="cl-model-"), "m")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = ml.predict(model, te).orderBy("estu_consecutivo").toPandas()
    b = ml.predict(back, te).orderBy("estu_consecutivo").toPandas()
    assert np.allclose(a.y_pred, b.y_pred, rtol=1e-6)


def test_path_contributions_sum_to_prediction(spark):
    tr, te = _parts(spark)
    model = ml.fit_train(ml.build_pipeline("gbt_profile_a", {"maxIter": 5, "maxDepth": 3},
                                           tr.columns), tr)
    contrib = X.path_contributions(model, te)
    total = contrib.groupBy("estu_consecutivo").agg(F.sum("contribution").alias("s"))
    pred = ml.predict(model, te)
    j = total.join(pred, "estu_consecutivo").toPandas()
    assert len(j) == te.count() and np.allclose(j.s, j.y_pred, atol=1e-6)


def test_categorical_prep_unknown_handling(spark):
    from pyspark.ml.feature import OneHotEncoder
    train = spark.createDataFrame([("Si", "A"), ("No", "B"), ("Si", "A"), (None, "A")],
                                  "flag string, cal string")
    prep = ml.CategoricalPrep(imputeCols=["flag", "cal"], indexCols=["flag", "cal"],
                              ordinalCols=["flag"]).fit(train)
    test = spark.createDataFrame([("Quizas", "OTRO"), (None, "B")], "flag string, cal string")
    out = prep.transform(test)
    oh = OneHotEncoder(inputCols=["cal__idx"], outputCols=["cal__oh"], dropLast=True).fit(out)
    rows = oh.transform(out).collect()
    assert rows[0]["flag__idx"] == -1.0                      # unseen binary label -> -1
    assert rows[0]["cal__oh"].numNonzeros() == 0             # unseen nominal -> zero vector
    assert rows[1]["flag"] == "Si" and rows[1]["flag__idx"] == 1.0   # null -> mode "Si"
    assert rows[1]["cal__oh"].toArray().tolist() == [0.0, 1.0]


def test_search_prunes_without_touching_finished_trials(spark):
    """Twelve concurrent trials: each is complete or pruned, with its parameters as fitted."""
    from cohortlens.operators import tune as T
    tr, _ = _parts(spark)
    rows = T.random_search_cv(tr, ["lasso"], n_trials=6, k=2, parallelism=3, n_startup=2).collect()
    assert sorted(r.trial for r in rows) == list(range(6))
    assert all(r.state in ("complete", "pruned") and r.params == T.draw("lasso", r.trial) for r in rows)
    assert sum(r.state == "complete" for r in rows) >= 2


def test_nothing_stays_cached_after_a_fit(spark):
    tr, _ = _parts(spark)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    ml.fit_train(ml.build_pipeline("tree", {"maxDepth": 3}, tr.columns), tr)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_a_column_without_values_is_an_error(spark):
    import pytest
    df = spark.createDataFrame([(None,), (None,)], "v double")
    with pytest.raises(ValueError, match="median"):
        ml.MedianImputer(["v"]).fit(df)


def test_searches_share_the_folds_of_one_preprocessing(spark, monkeypatch):
    from cohortlens.operators import tune as T

    fits, keep = [], ml.fit_stages
    monkeypatch.setattr(ml, "fit_stages", lambda *a: fits.append(1) or keep(*a))
    tr, _ = _parts(spark)
    folds = T.search_folds(tr, k=2)
    both = T.random_search_cv(tr, ["ridge", "catboost"], n_trials=1, k=2, fixed={"iterations": 1, "depth": 2}, folds=folds).collect()
    assert len(fits) == 2  # a fold once; before: once a fold for linear and once for boosted spaces
    alone = T.random_search_cv(tr, ["ridge"], n_trials=1, k=2).collect()
    assert np.isclose(both[0]["rmse"], alone[0]["rmse"]) and both[1]["rmse"] > 0


def test_a_fit_on_written_rows_copies_none(spark, monkeypatch):
    """Before: each fit checkpointed its training rows again, seven copies in robustness_summary."""
    from cohortlens.operators import tune as T
    from cohortlens.session import cut_lineage

    copies, real = [], ml.cut_lineage
    monkeypatch.setattr(ml, "cut_lineage", lambda df: copies.append(1) or real(df))
    c = cut_lineage(cohort(spark, SF001))
    build = lambda: ml.build_pipeline("tree", {"maxDepth": 3}, c.columns)
    T.group_kfold_cv(build, c, "estu_mcpio_reside", 2)
    here = T.temporal_holdout_cv(build, c, "periodo", R.TRAIN_UNTIL, cut=False).first()
    assert not copies
    assert T.temporal_holdout_cv(build, c, "periodo", R.TRAIN_UNTIL).first() == here and len(copies) == 1


def test_the_learner_reads_its_features_alone(spark):
    """Before: the rows behind the features stayed cached while the learner ran."""
    tr, _ = _parts(spark)
    pipeline = ml.build_pipeline("tree", {"maxDepth": 3}, tr.columns)
    learner, held = pipeline.getStages()[-1], []
    cached = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before, fit = cached(), learner.fit
    learner.fit = lambda df: held.append(cached()) or fit(df)
    ml.fit_train(pipeline, tr)
    assert held == [before + 1]


class _Stop(Exception):
    pass


def test_profile_c_trains_all_rounds(spark, monkeypatch):
    """Before: 20 rounds of 400."""
    from cohortlens.plans import queries  # noqa: F401
    from cohortlens.plans.registry import REGISTRY

    seen = []

    def stop(pipeline, *a, **k):
        seen.append(pipeline.getStages()[-1])
        raise _Stop
    monkeypatch.setattr(ml, "fit_train", stop)
    with pytest.raises(_Stop):
        REGISTRY["gbt_fit_profile_c"].build(spark, SF001)
    assert (seen[0].getMaxIter(), seen[0].getMaxDepth()) == (ml.BOOSTED_ROUNDS, ml.BOOSTED_DEPTH)


def test_comparison_table_fits_what_its_spaces_draw(spark, monkeypatch):
    """Before: 5 rounds of depth 4, where the space starts at 200 rounds."""
    from cohortlens.operators import tune as T
    from cohortlens.plans import queries  # noqa: F401
    from cohortlens.plans.registry import REGISTRY

    learners, make = [], ml.make_model

    def record(name, params=None, *a):
        if name == "gbt_profile_c":
            learners.append(make(name, params, *a))
            params = {**params, "maxIter": 1, "maxDepth": 1}
        return make(name, params, *a)
    monkeypatch.setattr(ml, "make_model", record)
    rows = {r.model: r for r in REGISTRY["comparison_table"].build(spark, SF001).collect()}
    drawn = T.to_mllib("catboost", T.draw("catboost", 0))
    assert len(rows) == 3 and len(learners) == 3
    assert all((m.getMaxIter(), m.getMaxDepth()) == (drawn["maxIter"], drawn["maxDepth"]) for m in learners)
