"""Shapley values of tree ensembles (I1-I4), path-dependent: absent features follow the training rows.

For a leaf, a row matters only through which of the path's features it agrees with. With d features on
the path, agreement o_j in {0, 1} and z_j the share of training rows that go the leaf's way at j's
splits, the leaf's value with a known set S is v * prod(o_j, S) * prod(z_j, not S), so a feature's Shapley
value is v (o_i - z_i) times the weighted coefficients of prod over the others of (z_j + o_j t). A batch
of rows has few distinct agreements, at most 2^d, and the polynomial is worked out once for each: rows
only look theirs up. Trees are arrays of bounded size (checked) and are broadcast; the ranking is summed
inside the batches, one row a feature and batch leaves them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.explain import MAX_BROADCAST_NODES, _extract_trees, feature_names


def leaf_values(agree: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Shapley values (rows x features of the path) of one leaf: ``agree`` rows x d, ``share`` d."""
    rows, d = agree.shape
    out = np.zeros((rows, d))
    weight = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
    for i in range(d):
        coef = np.zeros((rows, d))
        coef[:, 0] = 1.0
        for j in range(d):
            if j != i:
                up = coef[:, :-1] * agree[:, j:j + 1]
                coef = coef * share[j]
                coef[:, 1:] += up
        out[:, i] = value * (agree[:, i] - share[i]) * (coef @ weight)
    return out


def _paths(tree: dict):
    """(leaf, [(node, goes left)]) of every leaf."""
    stack = [(0, [])]
    while stack:
        k, path = stack.pop()
        if tree["feat"][k] < 0:
            yield k, path
        else:
            stack += [(tree["left"][k], [*path, (k, True)]), (tree["right"][k], [*path, (k, False)])]


def tree_shapley(tree: dict, x: np.ndarray) -> tuple[np.ndarray, float]:
    """(rows x features values, expected value) of one tree."""
    out, cover = np.zeros(x.shape[::-1]), tree["cover"]
    base, left_of = 0.0, {}
    for k, f in enumerate(tree["feat"]):
        if f >= 0:
            cats = tree["cats"][k]
            left_of[k] = np.isin(x[:, f], sorted(cats)) if cats is not None else x[:, f] <= tree["thr"][k]
    right_of = {k: ~left for k, left in left_of.items()}
    for leaf, path in _paths(tree):
        base += tree["value"][leaf] * cover[leaf] / cover[0]
        feats: dict[int, tuple[np.ndarray, float]] = {}
        for k, left in path:
            f = tree["feat"][k]
            ok, share = feats.get(f, (None, 1.0))
            child = tree["left" if left else "right"][k]
            side = (left_of if left else right_of)[k]
            feats[f] = (side if ok is None else ok & side, share * cover[child] / cover[k])
        if not feats:
            continue
        names, bits = list(feats), np.arange(len(feats))
        code = np.zeros(len(x), np.uint8 if len(names) <= 8 else np.int64)  # a row's agreements as one number
        for j, f in enumerate(names):
            code |= feats[f][0].astype(code.dtype) << code.dtype.type(j)
        if len(names) <= 8:
            held, which = np.arange(1 << len(names)), code
        else:
            held, which = np.unique(code, return_inverse=True)
        kinds = (held[:, None] >> bits & 1).astype(float)
        values = leaf_values(kinds, np.array([feats[f][1] for f in names]), tree["value"][leaf])
        for j, f in enumerate(names):
            out[f] += values[which, j]
    return out.T, base


def ensemble_shapley(trees: list[dict], weights: list[float], x: np.ndarray) -> tuple[np.ndarray, float]:
    x = np.asfortranarray(x)  # read by columns
    total, base = np.zeros(x.shape, order="F"), 0.0
    for t, w in zip(trees, weights):
        values, b = tree_shapley(t, x)
        total += w * values
        base += w * b
    return total, base


def model_trees(model) -> tuple[list[dict], list[float]]:
    """The trees of an MLlib tree, forest or boosted model, with the training rows of every node."""
    flat, weights = _extract_trees(model)
    for t, own in zip(flat, model.trees if hasattr(model, "trees") else [model]):
        cover, stack = [], [own._java_obj.rootNode()]
        while stack:  # the order of _extract_trees
            node = stack.pop()
            cover.append(float(node.impurityStats().count()))
            if node.getClass().getSimpleName() == "InternalNode":
                stack += [node.rightChild(), node.leftChild()]
        t["cover"] = cover
    return flat, weights


def _shared(df: DataFrame, trees: list[dict], weights: list[float]):
    n = sum(len(t["feat"]) for t in trees)
    if n > MAX_BROADCAST_NODES:
        raise ValueError(f"{n} tree nodes exceed the broadcast bound {MAX_BROADCAST_NODES}")
    return df.sparkSession.sparkContext.broadcast((trees, weights))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equally long arrays as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def shapley_rows(rows: DataFrame, trees: list[dict], weights: list[float], id_col: str, x_col: str = "x",
                 keep: list[str] | None = None) -> DataFrame:
    """One row a row: id, base, phi (a value a feature); base + the values are the prediction."""
    shared, keep = _shared(rows, trees, weights), [id_col, *(keep or [])]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                values, base = ensemble_shapley(*shared.value, _matrix(batch.column(len(keep))))
                n, d = values.shape
                phi = pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d), pa.int32()), pa.array(np.ascontiguousarray(values).ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.full(n, base)), phi], names=[*keep, "base", "phi"])
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, F.col(x_col).alias("x")).mapInArrow(run, f"{kinds}, base double, phi array<double>")


def shapley_ranking(rows: DataFrame, trees: list[dict], weights: list[float], names: list[str], x_col: str = "x") -> DataFrame:
    """(feature, mean_abs) over all rows, greatest first; sums leave a batch, not rows."""
    shared = _shared(rows, trees, weights)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                values, _ = ensemble_shapley(*shared.value, _matrix(batch.column(0)))
                s = np.abs(np.ascontiguousarray(values)).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(s), pa.array(np.full(len(names), batch.num_rows))], names=["feature", "s", "n"])
    parts = rows.select(F.col(x_col).alias("x")).mapInArrow(run, "feature string, s double, n long")
    return parts.groupBy("feature").agg((F.sum("s") / F.sum("n")).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature")


def scored_rows(pipeline_model, df: DataFrame, keep: list, features_col: str = "raw_features") -> DataFrame:
    """The feature arrays of a fitted pipeline's rows."""
    return pipeline_model.transform(df).select(*keep, vector_to_array(features_col).alias("x"))


def model_shapley(pipeline_model, df: DataFrame, id_col: str = "estu_consecutivo", features_col: str = "raw_features") -> DataFrame:
    """I1/I3 of a fitted pipeline: id, y_pred, base, phi in the order of ``feature_names``."""
    rows = scored_rows(pipeline_model, df, [id_col, F.col("prediction").alias("y_pred")], features_col)
    return shapley_rows(rows, *model_trees(pipeline_model.stages[-1]), id_col, keep=["y_pred"])


def model_ranking(pipeline_model, df: DataFrame, features_col: str = "raw_features") -> DataFrame:
    return shapley_ranking(scored_rows(pipeline_model, df, [], features_col), *model_trees(pipeline_model.stages[-1]),
                           feature_names(pipeline_model, df, features_col))


def long_values(values: DataFrame, names: list[str], id_col: str = "estu_consecutivo") -> DataFrame:
    """(row, feature, contribution) of the nonzero values."""
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("phi").alias("contribution"))
    return (values.select(id_col, F.explode(named).alias("e")).select(id_col, "e.feature", "e.contribution")
            .where("contribution <> 0"))
