"""Sufficient statistics against dense least squares; balanced group folds against plain greedy dealing."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cohortlens.operators import gram, ml
from cohortlens.operators import split as SP
from cohortlens.operators import tune as T


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = rng.normal(1e4, 3, (240, 4))
    x[:, 3] = 2 * x[:, 0] - x[:, 1]                       # no spread of its own
    y = x[:, 0] - 0.5 * x[:, 2] + rng.normal(0, 1, 240)
    return x, y, np.arange(240) % 3


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y, f = rows
    data = [(i, *map(float, r), float(t), int(k)) for i, (r, t, k) in enumerate(zip(x, y, f))]
    data += [(900, None, 1.0, 1.0, 1.0, 5.0, 0), (901, 1.0, 1.0, 1.0, 1.0, None, 1), (902, 1.0, 1.0, 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, y double, fold int").repartition(5)


XS = ["a", "b", "c", "d"]


def dense(x, y, penalty):
    c, t = x - x.mean(0), y - y.mean()
    w = np.linalg.pinv(c.T @ c + penalty * np.eye(x.shape[1]), rcond=1e-9, hermitian=True) @ c.T @ t
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("penalty", [0.0, 1.0, 1e4])
def test_folds_by_subtraction_equal_dense_fits(frame, rows, penalty):
    x, y, f = rows
    grams = gram.collect_grams(frame, XS, "y", F.col("fold"))
    assert sorted(grams) == [0, 1, 2] and [grams[k].n for k in range(3)] == [80] * 3
    whole = gram.total(grams)
    for k in range(3):
        w, b = gram.solve(whole - grams[k], "ridge", penalty)
        want_w, want_b = dense(x[f != k], y[f != k], penalty)
        p, q = x[f == k] @ w + b, x[f == k] @ want_w + want_b
        assert np.allclose(p, q, atol=1e-5)
        rmse, r2 = grams[k].scores(w, b)
        e = y[f == k] - p
        assert rmse == pytest.approx(np.sqrt((e ** 2).mean()), abs=1e-6)
        assert r2 == pytest.approx(1 - (e ** 2).sum() / ((y[f == k] - y[f == k].mean()) ** 2).sum(), abs=1e-6)


def test_lasso_meets_its_conditions(frame, rows):
    x, y, _ = rows
    g = gram.total(gram.collect_grams(frame.where("fold is not null"), XS, "y"))
    for penalty in (0.1, 1.0, 1e6):
        w, b = gram.solve(g, "lasso", penalty)
        slope = (x - x.mean(0)).T @ (y - x @ w - b) / len(y)
        on = w != 0
        assert np.allclose(slope[on], penalty * np.sign(w[on]), atol=1e-4) and (np.abs(slope[~on]) <= penalty + 1e-4).all()
    assert not w.any()


def test_vectors_and_columns_give_the_same_matrix(frame):
    whole = frame.where("fold is not null").na.drop()
    v = VectorAssembler(inputCols=XS, outputCol="features").transform(whole)
    a, b = gram.total(gram.collect_grams(whole, XS, "y")), gram.total(gram.collect_grams(v, "features", "y"))
    assert np.allclose(a.centred()[0], b.centred()[0], rtol=1e-9) and np.allclose(a.ridge([2.0]), b.ridge([2.0]))


def test_ridge_equals_the_mllib_fit(frame):
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(frame.where("fold is not null").na.drop())
    learner = ml.make_model("ridge", {"alpha": 30.0}, label="y")
    learner.setTol(1e-12)
    model = ml.set_penalty(learner, *ml.label_stats(v, "y")).fit(v)
    w, b = gram.solve(gram.total(gram.collect_grams(v, "features", "y")), "ridge", 30.0)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-5) and model.intercept == pytest.approx(b, abs=0.1)


def test_no_rows(spark, frame):
    assert gram.collect_grams(frame.limit(0), XS, "y") == {}
    with pytest.raises(ValueError):
        gram.total({})


def test_predictions_of_all_parts_in_one_plan(frame, rows):
    x, _, f = rows
    models = {0: (np.ones(4), 1.0), 1: (np.zeros(4), 2.0), 2: (-np.ones(4), 0.0)}
    got = {r.id: r.y_pred for r in gram.predictions(frame, XS, models, "y", F.col("fold"), ["id"]).collect()}
    assert got == pytest.approx({i: float(x[i] @ models[k][0] + models[k][1]) for i, k in enumerate(f)})


def test_search_prunes_as_trial_after_trial_would(frame, rows, monkeypatch):
    monkeypatch.setattr(T, "draw", lambda space, t, seed=0: {"alpha": [1.0, 2.0, 1e7, 0.5, 1e8, 3.0][t]})
    got = {r.trial: r for r in T.penalty_search(frame, XS, 6, k=3, id_col="id", target="y", n_startup=2).collect()}
    x, y, _ = rows
    d = frame.na.drop(subset=[*XS, "y"]).select("id", *XS, "y")
    folds = {r.id: r.fold for r in SP.kfold_assign(d, "id", 3).collect()}
    data = {r.id: r for r in d.collect()}
    done, want = [], {}
    for t, a in enumerate([1.0, 2.0, 1e7, 0.5, 1e8, 3.0]):
        running, state = [], "complete"
        scores = []
        for k in range(3):
            tr, va = ([r for i, r in data.items() if (folds[i] == k) == inside] for inside in (False, True))
            w, b = dense(np.array([[r[c] for c in XS] for r in tr]), np.array([r.y for r in tr]), a)
            e = np.array([r.y for r in va]) - np.array([[r[c] for c in XS] for r in va]) @ w - b
            scores.append(np.sqrt((e ** 2).mean()))
            running.append(np.mean(scores))
            if k < 2 and len(done) >= 2 and running[-1] > np.median([q[k] for q in done]):
                state = "pruned"
                break
        if state == "complete":
            done.append(running)
        want[t] = (state, running[-1])
    assert {t: r.state for t, r in got.items()} == {t: s for t, (s, _) in want.items()}
    assert "pruned" in {s for s, _ in want.values()}
    assert all(got[t].rmse == pytest.approx(m, rel=1e-4) for t, (_, m) in want.items())


# ------------------------------------------------------------------ balanced group folds
@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1, max_size=8), st.integers(1, 6))
def test_segments_equal_greedy_dealing(sizes, k):
    runs = sorted(sizes.items(), reverse=True)
    loads, want = [0] * k, {}
    for size, n in runs:
        for rank in range(n):
            f = min(range(k), key=lambda j: (loads[j], j))
            loads[f] += size
            want[size, rank] = f
    got, per = {}, {}
    for size, first, after, turn in SP.lightest_first(runs, k):
        per[size] = per.get(size, 0) + 1
        got |= {(size, r): turn[(r - first) % len(turn)] for r in range(first, after)}
    assert got == want and max(per.values()) <= k + 1


def test_one_group_with_a_third_of_the_rows(spark):
    df = spark.range(900).withColumn("g", F.when(F.col("id") < 300, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id").cast("string"))))
    by = {r.fold: r["count"] for r in SP.group_kfold_assign(df, "g", 3).groupBy("fold").count().collect()}
    assert by == {0: 300, 1: 300, 2: 300}
