"""Split search against exhaustive search and MLlib; Shapley values against all subsets."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from cohortlens.operators import histree, shapley

NUM = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = np.stack([rng.integers(0, 8, 500), rng.integers(0, 20, 500) / 4, rng.integers(0, 3, 500)], axis=1).astype(float)
    cat = rng.choice(["u", "v", "w", "z"], 500)
    y = np.where(x[:, 0] > 3, 10, 0) + np.where(x[:, 1] > 2, 4, 0) * (x[:, 2] > 0) + 6 * np.isin(cat, ["u", "w"]) + rng.normal(0, 1, 500)
    return x, cat, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, cat, y = data
    rows = [(i, *map(float, r), str(k), float(t)) for i, (r, k, t) in enumerate(zip(x, cat, y))]
    rows += [(900, None, 1.0, 1.0, "u", 5.0), (901, 1.0, 1.0, 1.0, "u", None)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, k string, y double").repartition(4)


def gain(y, left):
    return sum(s.sum() ** 2 / len(s) for s in (y[left], y[~left])) - y.sum() ** 2 / len(y)


def best(x, cat, y):
    """Greatest gain over all thresholds and all divisions of the categories."""
    found = [(gain(y, x[:, j] <= t)) for j in range(3) for t in np.unique(x[:, j])[:-1]]
    kinds = sorted(set(cat))
    found += [gain(y, np.isin(cat, s)) for r in range(1, len(kinds)) for s in itertools.combinations(kinds, r)]
    return max(found)


def test_cuts_are_the_best_of_all(frame, data):
    x, cat, y = data
    tree = histree.fit_tree(frame, NUM, ["k"], "y", depth=2)
    assert tree.nodes[1].n == 500 and tree.nodes[1].gain == pytest.approx(best(x, cat, y))
    t = tree.nodes[1]
    left = np.isin(cat, t.categories) if t.categories else x[:, NUM.index(t.feature)] <= t.threshold
    for k, own in ((2, left), (3, ~left)):
        assert tree.nodes[k].n == own.sum() and tree.nodes[k].mean == pytest.approx(y[own].mean())
        assert tree.nodes[k].gain == pytest.approx(best(x[own], cat[own], y[own]))
    assert sum(tree.importance().values()) == pytest.approx(1)


def test_tree_equals_mllib(frame, data):
    whole = frame.na.drop()
    v = VectorAssembler(inputCols=NUM, outputCol="features").transform(whole)
    model = DecisionTreeRegressor(labelCol="y", maxDepth=3, maxBins=64).fit(v)
    tree = histree.fit_tree(frame, NUM, None, "y", depth=3)
    rows = model.transform(v).withColumn("own", tree.predict()).collect()
    assert max(abs(r.prediction - r.own) for r in rows) < 1e-6
    root = model._java_obj.rootNode().split()
    assert NUM[root.featureIndex()] == tree.nodes[1].feature and root.threshold() == pytest.approx(tree.nodes[1].threshold)


def test_every_boosting_round_fits_the_residuals_left(frame, data):
    x, cat, y = data
    model = histree.fit_boosted(frame, NUM, ["k"], "y", rounds=12, depth=2, step=0.3)
    columns = [t.predict().alias(f"t{k}") for k, t in enumerate(model.trees)]
    got = {r.id: r for r in frame.na.drop().select("id", model.predict().alias("p"), *columns).collect()}
    left = y - y.mean()
    for k, tree in enumerate(model.trees):
        assert tree.nodes[1].gain == pytest.approx(best(x, cat, left), rel=1e-6)
        leaf = np.array([got[i][f"t{k}"] for i in range(500)])
        for v in np.unique(leaf):
            assert v == pytest.approx(left[leaf == v].mean(), abs=1e-9)
        left = left - 0.3 * leaf
    assert np.allclose([got[i].p for i in range(500)], y - left) and np.mean(left ** 2) < 0.2 * y.var()


def test_many_values_are_binned_and_small_leaves_refused(spark):
    df = spark.range(4000).select("id", (F.col("id") / 7.0).alias("a"), F.when(F.col("id") < 1000, 0.0).otherwise(1.0).alias("y"))
    tree = histree.fit_tree(df, ["a"], None, "y", depth=1, bins=16)
    assert abs(tree.nodes[2].n - 1000) <= 20 and tree.nodes[1].threshold == pytest.approx(1000 / 7, rel=0.02)
    assert histree.fit_tree(df, ["a"], None, "y", depth=1, min_rows=2001).nodes[1].feature is None
    assert histree.fit_tree(df.withColumn("y", F.lit(3.0)), ["a"], None, "y", depth=2).nodes.keys() == {1}


# ------------------------------------------------------------------ Shapley values
def known(tree, k, x, s):
    f = tree["feat"][k]
    if f < 0:
        return tree["value"][k]
    left, right = tree["left"][k], tree["right"][k]
    if f in s:
        cats = tree["cats"][k]
        ok = x[f] in cats if cats is not None else x[f] <= tree["thr"][k]
        return known(tree, left if ok else right, x, s)
    c = tree["cover"]
    return (c[left] * known(tree, left, x, s) + c[right] * known(tree, right, x, s)) / c[k]


def brute(tree, x, p):
    out = np.zeros(p)
    for i in range(p):
        rest = [j for j in range(p) if j != i]
        for r in range(p):
            for s in itertools.combinations(rest, r):
                w = math.factorial(r) * math.factorial(p - r - 1) / math.factorial(p)
                out[i] += w * (known(tree, 0, x, {*s, i}) - known(tree, 0, x, set(s)))
    return out


def random_tree(rng, depth, p):
    t = {k: [] for k in ("feat", "thr", "cats", "left", "right", "value", "cover")}

    def grow(level, cover):
        k = len(t["feat"])
        for name, v in (("feat", -1), ("thr", np.nan), ("cats", None), ("left", -1), ("right", -1), ("value", rng.normal()), ("cover", cover)):
            t[name].append(v)
        if level and rng.random() < 0.85:
            t["feat"][k], n = int(rng.integers(p)), cover * rng.uniform(0.1, 0.9)
            if rng.random() < 0.3:
                t["cats"][k] = {0.0, float(rng.integers(1, 4))}
            else:
                t["thr"][k] = float(rng.integers(0, 4))
            t["left"][k] = grow(level - 1, n)
            t["right"][k] = grow(level - 1, cover - n)
        return k
    grow(depth, 100.0)
    return t


@pytest.mark.parametrize("seed", range(8))
def test_values_equal_all_subsets(seed):
    rng = np.random.default_rng(seed)
    p = 5
    trees = [random_tree(rng, d, p) for d in (0, 2, 4, 6)]
    x = rng.integers(0, 5, (25, p)).astype(float)
    weights = [1.0, 0.5, 2.0, -1.0]
    got, base = shapley.ensemble_shapley(trees, weights, x)
    want = np.array([sum(w * brute(t, r, p) for t, w in zip(trees, weights)) for r in x])
    assert np.allclose(got, want, atol=1e-9)
    whole = [sum(w * known(t, 0, r, set(range(p))) for t, w in zip(trees, weights)) for r in x]
    assert np.allclose(got.sum(axis=1) + base, whole)


@pytest.mark.parametrize("learner", [lambda: DecisionTreeRegressor(labelCol="y", maxDepth=4), lambda: GBTRegressor(labelCol="y", maxIter=4, maxDepth=3, seed=1)])
def test_values_of_mllib_models_add_up(frame, data, learner):
    v = VectorAssembler(inputCols=NUM, outputCol="features").transform(frame.na.drop())
    model = learner().fit(v)
    trees, weights = shapley.model_trees(model)
    assert trees[0]["cover"][0] == 500
    x, _, y = data
    values, base = shapley.ensemble_shapley(trees, weights, x)
    pred = {r.id: r.prediction for r in model.transform(v).collect()}
    assert np.allclose(values.sum(axis=1) + base, [pred[i] for i in range(500)])
    assert base == pytest.approx(y.mean(), abs=1e-6) if len(trees) == 1 else True
    rows = frame.na.drop().select("id", F.array(*NUM).alias("x"))
    got = {r.id: (r.base, r.phi) for r in shapley.shapley_rows(rows, trees, weights, "id").collect()}
    assert np.allclose([got[i][1] for i in range(500)], values)
    rank = {r.feature: r.mean_abs for r in shapley.shapley_ranking(rows, trees, weights, NUM).collect()}
    assert rank == pytest.approx(dict(zip(NUM, np.abs(values).mean(axis=0))))


def test_a_tree_of_prefix_sums_has_the_same_values_as_its_arrays(frame, data):
    tree = histree.fit_tree(frame, NUM, None, "y", depth=3)
    flat = histree.as_arrays(tree, NUM)
    values, base = shapley.tree_shapley(flat, data[0])
    pred = {r.id: r.p for r in frame.na.drop().select("id", tree.predict().alias("p")).collect()}
    assert np.allclose(values.sum(axis=1) + base, [pred[i] for i in range(500)])


def test_values_of_many_rows_do_not_sort_them_at_every_leaf():
    """Before: the rows' agreements were sorted as rows at every leaf, 12 to 50 times the seconds here."""
    import time

    rng = np.random.default_rng(3)
    trees, x = [random_tree(rng, 4, 40) for _ in range(10)], rng.integers(0, 5, (20_000, 40)).astype(float)
    start = time.process_time()
    got, _ = shapley.ensemble_shapley(trees, [1.0] * len(trees), x)
    assert time.process_time() - start < 3
    few, _ = shapley.ensemble_shapley(trees, [1.0] * len(trees), x[:50])
    assert np.allclose(got[:50], few)
    # a path of more features than a byte holds
    wide = random_tree(np.random.default_rng(5), 11, 40)
    values, base = shapley.tree_shapley(wide, x[:50])
    assert np.allclose(values.sum(axis=1) + base, [known(wide, 0, r, set(range(40))) for r in x[:50]])
