"""Regression trees by split search over prefix sums (R5-R7, I2), level by level in Spark.

A level is one aggregate: every (node, feature, value) with its rows and label sum. Running sums along
the values of a feature give each possible cut's left side, and the total its right side, so a node's
best cut is the row of greatest variance gain. Categories are ordered by their mean label first, which
makes the best of all their divisions a cut as well. A feature of more than ``bins`` values is cut at
(approximate) quantiles, so no window holds more than ``bins`` rows. Only the chosen cuts, one row a
node, reach the driver; rows find their node through expressions over their columns, nothing is joined.

Ties in gain go to the first feature by name, then to the lower cut. Rows with a null number or label
are left out; a null category is a category of its own (''). A node keeps a leaf if no cut gains
anything or leaves ``min_rows`` rows on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.session import cut_lineage

BINS = 256
REFRESH = 10   # boosting rounds whose trees stay an expression before residuals are written anew


@dataclass
class TreeNode:
    n: int
    mean: float
    feature: str | None = None
    threshold: float | None = None            # numbers: x <= threshold goes left
    categories: list[str] | None = None       # categories that go left
    gain: float = 0.0
    left: int | None = None
    right: int | None = None


@dataclass
class Tree:
    """Node 1 is the root; the children of node k are 2k and 2k + 1."""

    nodes: dict[int, TreeNode] = field(default_factory=dict)

    def goes_left(self, k: int) -> Column:
        t = self.nodes[k]
        if t.categories is not None:
            return F.coalesce(F.col(t.feature).cast("string"), F.lit("")).isin(t.categories)
        return F.col(t.feature).cast("double") <= F.lit(t.threshold)

    def _walk(self, k: int, leaf) -> Column:
        t = self.nodes[k]
        if t.feature is None:
            return leaf(k)
        return F.when(self.goes_left(k), self._walk(2 * k, leaf)).otherwise(self._walk(2 * k + 1, leaf))

    def node(self) -> Column:
        return self._walk(1, lambda k: F.lit(k))

    def predict(self) -> Column:
        return self._walk(1, lambda k: F.lit(self.nodes[k].mean))

    def importance(self) -> dict[str, float]:
        """Share of the total gain by feature."""
        out: dict[str, float] = {}
        for t in self.nodes.values():
            if t.feature:
                out[t.feature] = out.get(t.feature, 0.0) + t.gain
        whole = sum(out.values())
        return {f: g / whole for f, g in sorted(out.items(), key=lambda x: (-x[1], x[0]))} if whole else {}


def _cuts(rows: DataFrame, numbers: list[str], bins: int) -> dict[str, list[float]]:
    """Upper bounds of the bins of the features that have too many values."""
    if not numbers:
        return {}
    many = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in numbers]).first()
    wide = [c for c in numbers if many[c] > 0.9 * bins]  # the count is approximate
    if not wide:
        return {}
    points = [i / bins for i in range(1, bins)]
    got = rows.agg(*[F.percentile_approx(c, points, 100 * bins).alias(c) for c in wide]).first()
    return {c: sorted(set(got[c] or [])) for c in wide}


def _binned(c: str, bounds: list[float] | None) -> Column:
    """The value, or the least bound at or above it (the values beyond the last bound are one bin)."""
    x = F.col(c).cast("double")
    if not bounds:
        return x
    at = F.array(*[F.lit(b) for b in bounds])
    return F.coalesce(F.get(F.filter(at, lambda b: b >= x), 0), F.lit(float("inf")))


def best_cuts(rows: DataFrame, node: Column, numbers: list[str], categories: list[str], label: str,
              min_rows: int = 1, bounds: dict[str, list[float]] | None = None) -> DataFrame:
    """The best cut of every node: node, feature, threshold, cats, gain, n_left, mean_left, n_right, mean_right."""
    bounds = bounds or {}
    entries = [F.struct(F.lit(c).alias("feature"), _binned(c, bounds.get(c)).alias("value"), F.lit(None).cast("string").alias("cat")) for c in numbers]
    entries += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("value"),
                         F.coalesce(F.col(c).cast("string"), F.lit("")).alias("cat")) for c in categories]
    long = rows.select(node.alias("node"), F.col(label).cast("double").alias("y"), F.explode(F.array(*entries)).alias("e"))
    hist = (long.groupBy("node", F.col("e.feature").alias("feature"), F.col("e.value").alias("value"), F.col("e.cat").alias("cat"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
    side = hist.withColumn("ord", F.coalesce("value", F.col("s") / F.col("n")))
    whole = Window.partitionBy("node", "feature")
    along = whole.orderBy("ord", "cat")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    cut = side.select("*", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"), F.lead("ord").over(along).alias("after"),
                      F.collect_list("cat").over(upto).alias("cats"), F.sum("n").over(whole).alias("nt"), F.sum("s").over(whole).alias("st"))
    nr, sr = F.col("nt") - F.col("nl"), F.col("st") - F.col("sl")
    gain = F.col("sl") * F.col("sl") / F.col("nl") + F.try_divide(sr * sr, nr) - F.col("st") * F.col("st") / F.col("nt")
    cut = cut.where((F.col("nl") >= min_rows) & (nr >= F.greatest(F.lit(min_rows), F.lit(1)))).withColumn("gain", gain)
    # between two values, or at the bound of a bin
    threshold = F.when(F.col("feature").isin(list(bounds)), F.col("value")).otherwise((F.col("value") + F.col("after")) / 2)
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("gain"), "feature", "ord", "cat"))
    return (cut.withColumn("place", first).where("place = 1")
            .select("node", "feature", threshold.alias("threshold"), F.when(F.col("cat").isNotNull(), F.array_sort("cats")).alias("cats"), "gain",
                    F.col("nl").alias("n_left"), (F.col("sl") / F.col("nl")).alias("mean_left"), nr.alias("n_right"), (sr / nr).alias("mean_right")))


def fit_tree(rows: DataFrame, numbers: list[str], categories: list[str] | None = None, label: str = K.TARGET, depth: int = 2,
             min_rows: int = 1, bins: int = BINS) -> Tree:
    """A regression tree of at most ``depth`` levels; one pass over ``rows`` a level."""
    categories = categories or []
    rows = rows.select(*{*numbers, *categories, label}).na.drop(subset=[*numbers, label])
    bounds = _cuts(rows, numbers, bins)
    root = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("m")).first()
    tree = Tree({1: TreeNode(root.n, root.m)})
    for level in range(depth):
        open_nodes = [k for k in tree.nodes if k >> level == 1]
        at = tree.node()
        cuts = best_cuts(rows.withColumn("__node", at).where(F.col("__node").isin(open_nodes)), F.col("__node"), numbers, categories,
                         label, min_rows, bounds).collect()  # one row a node of the level
        for r in cuts:
            t = tree.nodes[r.node]
            if r.gain <= 1e-9 * max(abs(t.mean), 1.0):
                continue
            t.feature, t.threshold, t.categories, t.gain = r.feature, r.threshold, None if r.cats is None else list(r.cats), r.gain
            t.left, t.right = 2 * r.node, 2 * r.node + 1
            tree.nodes[t.left], tree.nodes[t.right] = TreeNode(r.n_left, r.mean_left), TreeNode(r.n_right, r.mean_right)
        if not cuts:
            break
    return tree


@dataclass
class Boosted:
    """base + step * the trees."""

    base: float
    step: float
    trees: list[Tree]

    def predict(self) -> Column:
        out = F.lit(self.base)
        for t in self.trees:
            out = out + F.lit(self.step) * t.predict()
        return out


def fit_boosted(rows: DataFrame, numbers: list[str], categories: list[str] | None = None, label: str = K.TARGET, rounds: int = 1,
                depth: int = 2, step: float = 0.1, min_rows: int = 1, bins: int = BINS) -> Boosted:
    """Gradient boosting of squared error: each round fits a tree to the residuals so far."""
    categories = categories or []
    rows = rows.select(*{*numbers, *categories, label}).na.drop(subset=[*numbers, label])
    model = Boosted(rows.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0, step, [])
    left = rows.withColumn("__left", F.col(label).cast("double") - F.lit(model.base))
    for k in range(rounds):
        tree = fit_tree(left, numbers, categories, "__left", depth, min_rows, bins)
        model.trees.append(tree)
        left = left.withColumn("__left", F.col("__left") - F.lit(step) * tree.predict())
        if (k + 1) % REFRESH == 0:
            left = cut_lineage(left)
    return model


def as_arrays(tree: Tree, features: list[str]) -> dict:
    """The tree in the flat form that ``shapley`` works on (numbers only)."""
    order = sorted(tree.nodes)
    at = {k: i for i, k in enumerate(order)}
    nodes = [tree.nodes[k] for k in order]
    return {"feat": [features.index(t.feature) if t.feature else -1 for t in nodes],
            "thr": [np.nan if t.threshold is None else t.threshold for t in nodes], "cats": [None] * len(nodes),
            "left": [at.get(t.left, -1) for t in nodes], "right": [at.get(t.right, -1) for t in nodes],
            "value": [t.mean for t in nodes], "cover": [float(t.n) for t in nodes]}
