"""Random-search tuning over a fold column.

Each trial x fold is one distributed fit; trials run concurrently from a small
driver thread pool (``parallelism``), the Spark analogue of parallel trials. The
training frame is checkpointed once into the shared checkpoint folder so every
fit reads the same materialised rows instead of recomputing the joins. Our own
fold loop (not ``CrossValidator``) lets training folds carry the leave-one-out
flag while validation folds get plain lookups.
"""

from __future__ import annotations

import math
import threading
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators import diagnostics as D
from cohortlens.operators import gram
from cohortlens.operators import groupagg as G
from cohortlens.operators import ml
from cohortlens.operators import split as S
from cohortlens.session import cut_lineage

# ---- FIXED VALUES: reference search spaces (name, low, high, kind) ----------
SEARCH_SPACES: dict[str, list[tuple[str, float, float, str]]] = {
    "lightGBM": [
        ("n_estimators", 200, 1000, "int"),
        ("max_depth", 4, 12, "int"),
        ("learning_rate", 0.01, 0.3, "log"),
        ("num_leaves", 20, 150, "int"),
        ("min_child_samples", 10, 100, "int"),
        ("subsample", 0.6, 1.0, "float"),
        ("colsample_bytree", 0.6, 1.0, "float"),
        ("reg_alpha", 1e-8, 10.0, "log"),
        ("reg_lambda", 1e-8, 10.0, "log"),
    ],
    "xgboost": [
        ("n_estimators", 200, 1000, "int"),
        ("max_depth", 4, 12, "int"),
        ("learning_rate", 0.01, 0.3, "log"),
        ("subsample", 0.6, 1.0, "float"),
        ("colsample_bytree", 0.6, 1.0, "float"),
        ("reg_alpha", 1e-8, 10.0, "log"),
        ("reg_lambda", 1e-8, 10.0, "log"),
        ("min_child_weight", 1, 50, "int"),
        ("gamma", 1e-8, 5.0, "log"),
    ],
    "catboost": [
        ("iterations", 200, 1000, "int"),
        ("depth", 4, 10, "int"),
        ("learning_rate", 0.01, 0.3, "log"),
        ("l2_leaf_reg", 1e-3, 10.0, "log"),
        ("bagging_temperature", 0.0, 1.0, "float"),
        ("random_strength", 1e-3, 10.0, "log"),
    ],
    "randomForest": [
        ("n_estimators", 100, 500, "int"),
        ("max_depth", 6, 20, "int"),
        ("min_samples_split", 5, 50, "int"),
        ("min_samples_leaf", 2, 30, "int"),
        ("max_features", 0.3, 1.0, "float"),
    ],
    "ridge": [("alpha", 1e-3, 1e3, "log")],
    "lasso": [("alpha", 1.0, 500.0, "log")],
}
PROFILE_OF = {"lightGBM": "gbt_profile_a", "xgboost": "gbt_profile_b", "catboost": "gbt_profile_c",
              "randomForest": "forest", "ridge": "ridge", "lasso": "lasso"}
N_STARTUP_TRIALS = 10


def draw(space: str, trial: int, seed: int = K.SEED) -> dict[str, float]:
    """One seeded draw from a search space (int / uniform / log-uniform)."""
    rng = np.random.RandomState(seed * 1000 + trial)
    out = {}
    for name, lo, hi, kind in SEARCH_SPACES[space]:
        if kind == "int":
            out[name] = float(rng.randint(int(lo), int(hi) + 1))
        elif kind == "log":
            out[name] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
        else:
            out[name] = float(rng.uniform(lo, hi))
    return out


def to_mllib(space: str, p: dict[str, float]) -> dict:
    """Parameter bridge to MLlib names; parameters without a counterpart are dropped. The
    penalty ``alpha`` goes through as it is: ridge scales it by the rows of each fit."""
    if space in ("ridge", "lasso"):
        return {"alpha": p["alpha"]}
    rounds = "numTrees" if space == "randomForest" else "maxIter"
    out = {}
    if "n_estimators" in p or "iterations" in p:
        out[rounds] = int(p.get("n_estimators", p.get("iterations")))
    if "max_depth" in p or "depth" in p:
        out["maxDepth"] = int(p.get("max_depth", p.get("depth")))
    if "learning_rate" in p:
        out["stepSize"] = p["learning_rate"]
    if "subsample" in p:
        out["subsamplingRate"] = p["subsample"]
    if "colsample_bytree" in p or "max_features" in p:
        out["featureSubsetStrategy"] = f"{p.get('colsample_bytree', p.get('max_features')):.4f}"
    for least in ("min_child_samples", "min_child_weight", "min_samples_leaf"):
        if least in p:
            out["minInstancesPerNode"] = int(p[least])
    if "gamma" in p:
        out["minInfoGain"] = p["gamma"]
    return out


def should_prune(running_mean: float, finished: list[float], n_startup: int = N_STARTUP_TRIALS) -> bool:
    """Median rule: once ``n_startup`` trials are complete, stop a trial whose running mean
    fold RMSE at this step is worse than the median of the completed trials at the same step."""
    return len(finished) >= n_startup and running_mean > float(np.median(finished))


class MedianPruner:
    """Running means of completed trials by step; safe for concurrent trials. A trial is
    compared only with trials that completed before it asks, never with itself or a pruned one."""

    def __init__(self, n_startup: int = N_STARTUP_TRIALS):
        self.n_startup, self._lock, self._done = n_startup, threading.Lock(), []

    def prune(self, running: list[float]) -> bool:
        with self._lock:
            finished = [r[len(running) - 1] for r in self._done]
        return should_prune(running[-1], finished, self.n_startup)

    def complete(self, running: list[float]) -> None:
        with self._lock:
            self._done.append(list(running))


def _fold_features(data: DataFrame, k: int, id_col: str):
    """Per fold: fit the preprocessing prefix once on the training folds (LOO flag
    set) and materialise (raw features, label) of train and validation rows. The prefix
    is independent of the model and its hyperparameters, so every space and trial reuses it."""
    out = []
    for f in range(k):
        tr = data.where(F.col("fold") != f).drop("fold")
        va = data.where(F.col("fold") == f).drop("fold")
        full = ml.build_pipeline("tree", None, tr.columns)
        # ``data`` is the one checkpoint: folds are filters of it, never copies
        fitted, cur, held = ml.fit_stages(full.getStages()[:-1], tr.withColumn(G.TRAIN_FLAG, F.lit(True)))
        prefix = PipelineModel(fitted)
        trx = cut_lineage(cur.select("raw_features", F.col(K.TARGET).cast("double").alias(K.TARGET)))
        vax = cut_lineage(prefix.transform(va).select(
            id_col, "raw_features", F.col(K.TARGET).cast("double").alias(K.TARGET)))
        for h in held:
            h.unpersist()
        out.append((trx, vax, ml.label_stats(trx)))
    return out


def search_folds(df: DataFrame, k: int = 3, id_col: str = "estu_consecutivo", seed: int = K.SEED) -> list:
    """The folds of a search and their features (see ``_fold_features``)."""
    return _fold_features(cut_lineage(S.kfold_assign(df, id_col, k, seed)), k, id_col)


def _space_features(folds: list, linear: bool) -> list:
    """The folds' rows as a space's learner takes them: scaled by the training folds if linear."""
    out = []
    for trx, vax, stats in folds:
        if linear:
            scaler = ml.make_scaler().fit(trx)
            out.append((scaler.transform(trx).drop("raw_features"), scaler.transform(vax).drop("raw_features"), stats))
        else:
            out.append((trx.withColumnRenamed("raw_features", "features"), vax.withColumnRenamed("raw_features", "features"), stats))
    return out


def cv_trial(train: list, valid: list, kind: str, penalty: float, pruner: MedianPruner) -> tuple[float, str]:
    """Mean fold RMSE and state of one penalty, from the folds' Gram matrices."""
    scores, running = [], []
    for score in gram.fold_rmse(train, valid, kind, penalty):
        scores.append(score)
        running.append(float(np.mean(scores)))
        if len(running) < len(train) and pruner.prune(running):
            return running[-1], "pruned"
    pruner.complete(running)
    return running[-1], "complete"


def random_search_cv(df: DataFrame, spaces: list[str], n_trials: int, k: int = 3,
                     parallelism: int = 2, id_col: str = "estu_consecutivo", seed: int = K.SEED,
                     fixed: dict[str, float] | None = None, n_startup: int = N_STARTUP_TRIALS,
                     folds: list | None = None) -> DataFrame:
    """Seeded random search, k-fold CV RMSE per trial, median pruning once ``n_startup``
    trials of a space are complete. Returns the trials table (model, trial, rmse, state, params).

    ``fixed`` sets parameters by hand instead of drawing them (e.g. a number of rounds); the
    table records the parameters as fitted. Fold preprocessing is fitted once per fold (see
    ``_fold_features``; ``folds`` passes those of ``search_folds`` to several searches); each trial x fold then fits only the learner on the feature vectors, and
    linear spaces solve all trials from one Gram matrix a fold (``gram``)."""
    spark = df.sparkSession
    raw = search_folds(df, k, id_col, seed) if folds is None else folds
    cache: dict[bool, list] = {}
    grams = None
    rows = []
    for space in spaces:
        profile = PROFILE_OF[space]
        linear = profile in ml.LINEAR
        if linear not in cache:
            cache[linear] = _space_features(raw, linear)
        folds, pruner = cache[linear], MedianPruner(n_startup)
        if linear:  # all trials and folds from the folds' Gram matrices: no job per trial
            if grams is None:
                grams = [[gram.total(gram.collect_grams(part, "features")) for part in (trx, vax)] for trx, vax, _ in folds]
            for t in range(n_trials):
                p = draw(space, t, seed)
                p.update({n: float(v) for n, v in (fixed or {}).items() if n in p})
                rows.append((space, t, *cv_trial([g[0] for g in grams], [g[1] for g in grams], space, p["alpha"], pruner), p))
            continue

        def one_trial(t: int, space=space, profile=profile, folds=folds, pruner=pruner):
            p = draw(space, t, seed)
            p.update({n: float(v) for n, v in (fixed or {}).items() if n in p})
            scores, running = [], []
            for f, (trx, vax, stats) in enumerate(folds):
                model = ml.set_penalty(ml.make_model(profile, to_mllib(space, p)), *stats).fit(trx)
                pred = model.transform(vax)
                scores.append(pred.agg(F.sqrt(F.avg((F.col(K.TARGET) - F.col("prediction")) ** 2))).first()[0])
                running.append(float(np.mean(scores)))
                if f + 1 < len(folds) and pruner.prune(running):
                    return (space, t, running[-1], "pruned", p)
            pruner.complete(running)
            return (space, t, running[-1], "complete", p)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows += list(pool.map(one_trial, range(n_trials)))
    return spark.createDataFrame(
        [(m, t, r, s, {kk: float(v) for kk, v in p.items()}) for m, t, r, s, p in rows],
        "model string, trial int, rmse double, state string, params map<string,double>")


def fit_best(trials: DataFrame, train: DataFrame, space: str, cut: bool = True):
    """E5: refit the best complete trial of ``space`` on the full training frame (``cut`` as in ``ml.fit_train``)."""
    best = trials.where((F.col("model") == space) & (F.col("state") == "complete")) \
        .orderBy("rmse", "trial").first()
    params = to_mllib(space, dict(best["params"]))
    return ml.fit_train(ml.build_pipeline(PROFILE_OF[space], params, train.columns), train, cut)


def group_kfold_cv(build_fn, df: DataFrame, group_col: str = "estu_mcpio_reside",
                   n_splits: int = 5, id_col: str = "estu_consecutivo") -> DataFrame:
    """Group K-fold (X4); per fold metrics, sizes and distinct group counts."""
    if group_col not in df.columns:
        raise ValueError(f"{group_col!r} not in frame")
    data = cut_lineage(S.group_kfold_assign(df, group_col, n_splits))
    spark = df.sparkSession
    sizes = {r["fold"]: (r["n"], r["g"]) for r in data.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("group_key").alias("g")).collect()}
    n_all, g_all = (sum(x[k] for x in sizes.values()) for k in (0, 1))
    out = []
    for f in range(n_splits):
        tr = data.where(F.col("fold") != f)
        va = data.where(F.col("fold") == f)
        model = ml.fit_train(build_fn(), tr.drop("fold", "group_key"), cut=False)  # a filter of ``data``
        m = D.regression_report(ml.predict(model, va.drop("fold", "group_key"))).first()
        n, g = sizes.get(f, (0, 0))
        out.append((f + 1, m["rmse"], m["mae"], m["r2"], n_all - n, n, g_all - g, g))
    return spark.createDataFrame(out, "fold int, rmse double, mae double, r2 double, "
                                      "n_train bigint, n_val bigint, n_groups_train bigint, "
                                      "n_groups_val bigint")


def temporal_holdout_cv(build_fn, df: DataFrame, period_col: str = "periodo",
                        train_until: str = "20194", cut: bool = True) -> DataFrame:
    """Temporal holdout (X5, raises on an empty side) + fit + metrics + period lists (``cut`` as in
    ``ml.fit_train``)."""
    data = S.temporal_split(df, period_col, train_until, check=True)
    tr = data.where(F.col("role") == "train").drop("role")
    te = data.where(F.col("role") == "test").drop("role")
    model = ml.fit_train(build_fn(), tr, cut)
    m = D.regression_report(ml.predict(model, te))
    periods = data.groupBy().agg(
        F.sort_array(F.collect_set(F.when(F.col("role") == "train", F.col(period_col))))
        .alias("train_periods"),
        F.sort_array(F.collect_set(F.when(F.col("role") == "test", F.col(period_col))))
        .alias("test_periods"),
        F.count_if(F.col("role") == "train").alias("n_train"),
        F.count_if(F.col("role") == "test").alias("n_test"))
    ps = periods.select(F.struct(*periods.columns).alias("s")).scalar()
    return m.select(F.lit("TemporalHoldout").alias("scheme"), F.lit(train_until).alias("train_until"),
                    "*", *[ps.getField(c).alias(c) for c in periods.columns])


def robustness_summary(holdout: DataFrame, folds: DataFrame, temporal: DataFrame) -> DataFrame:
    """One row per validation scheme, each with the number of rows it scored."""
    fs = D.fold_summary(folds)
    n = folds.agg(F.sum("n_val")).scalar()
    return (holdout.select(F.lit("holdout").alias("scheme"), "rmse", "mae", "r2", "n")
            .unionByName(fs.select(F.lit("group_kfold").alias("scheme"),
                                   F.col("rmse_mean").alias("rmse"), F.col("mae_mean").alias("mae"),
                                   F.col("r2_mean").alias("r2"), n.alias("n")))
            .unionByName(temporal.select(F.lit("temporal").alias("scheme"), "rmse", "mae", "r2", "n")))


def _closed_form_folds(df: DataFrame, features: list[str], fold: str, kind: str, penalty: float, target: str):
    """(models by fold, trained on the other folds; Gram matrix of each fold)."""
    grams = gram.collect_grams(df, features, target, F.col(fold))
    whole = gram.total(grams)
    return {k: gram.solve(whole - g, kind, penalty) for k, g in grams.items()}, grams


def penalty_search(df: DataFrame, features: list[str], n_trials: int, k: int = 3, space: str = "ridge", id_col: str = "estu_consecutivo",
                   target: str = K.TARGET, seed: int = K.SEED, n_startup: int = N_STARTUP_TRIALS) -> DataFrame:
    """E1-E3 over numeric columns: seeded penalties, k-fold RMSE and median pruning, from one scan."""
    whole_rows = df.select(id_col, *features, target).na.drop()
    grams = gram.collect_grams(S.kfold_assign(whole_rows, id_col, k, seed), features, target, F.col("fold"))
    whole, pruner, rows = gram.total(grams), MedianPruner(n_startup), []
    train, valid = [whole - grams[f] for f in sorted(grams)], [grams[f] for f in sorted(grams)]
    for t in range(n_trials):
        p = draw(space, t, seed)
        rows.append((space, t, *cv_trial(train, valid, space, p["alpha"], pruner), p))
    return df.sparkSession.createDataFrame(rows, "model string, trial int, rmse double, state string, params map<string,double>")


def group_kfold_linear(df: DataFrame, features: list[str], group_col: str, k: int = 5, kind: str = "linear", penalty: float = 0.0,
                       target: str = K.TARGET) -> DataFrame:
    """E7 with a linear learner: all folds fitted from one aggregate (leave-fold-out by subtraction)
    and scored in one plan."""
    f = cut_lineage(S.group_kfold_assign(df.select(group_col, *features, target).na.drop(subset=[*features, target]), group_col, k))
    models, _ = _closed_form_folds(f, features, "fold", kind, penalty, target)
    m = D.metric_exprs("y_true", "y_pred")
    per = (gram.predictions(f, features, models, target, F.col("fold"), ["fold", "group_key"]).groupBy("fold")
           .agg(*[m[c].alias(c) for c in ("rmse", "mae", "r2")], m["n"].alias("n_val"), F.count_distinct("group_key").alias("n_groups_val")))
    both = f.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_distinct("group_key").alias("g")).alias("t")).scalar()
    return per.select((F.col("fold") + 1).cast("int").alias("fold"), "rmse", "mae", "r2", (both.getField("n") - F.col("n_val")).alias("n_train"),
                      "n_val", (both.getField("g") - F.col("n_groups_val")).alias("n_groups_train"), "n_groups_val")


def holdout_linear(train: DataFrame, test: DataFrame, features: list[str], kind: str = "linear", penalty: float = 0.0,
                   target: str = K.TARGET) -> DataFrame:
    """A linear learner fitted on ``train`` from one aggregate, metrics on ``test``."""
    model = gram.solve(gram.total(gram.collect_grams(train, features, target)), kind, penalty)
    return D.regression_report(gram.predictions(test, features, {0: model}, target))


def group_kfold_cell_mean(df: DataFrame, group_col: str, cell: list[str],
                          target: str = K.TARGET, k: int = 5) -> DataFrame:
    """E7 with a closed-form learner (training-fold mean of a categorical cell),
    for ALL folds at once and without a driver loop: per (cell, fold) and per cell
    sums/counts give the leave-fold-out mean (S_c - S_cf) / (N_c - N_cf); a cell
    absent from the training folds falls back to the training-fold mean. Only
    partial aggregates over small (cell x fold) tables; per-fold metrics are one
    ``groupBy(fold)``."""
    keyed = df.select(group_col, *[F.coalesce(F.col(c).cast("string"), F.lit(K.MISSING_GROUP))
                                   .alias(c) for c in cell],
                      F.col(target).cast("double").alias("__y"))
    f = S.group_kfold_assign(keyed, group_col, k)
    cf = f.groupBy(*cell, "fold").agg(F.sum("__y").alias("__scf"), F.count(F.lit(1)).alias("__ncf"))
    ct = f.groupBy(*cell).agg(F.sum("__y").alias("__sc"), F.count(F.lit(1)).alias("__nc"))
    gf = f.groupBy("fold").agg(F.sum("__y").alias("__sf"), F.count(F.lit(1)).alias("__nf"),
                               F.count_distinct("group_key").alias("__gf"))
    tot = f.agg(F.struct(F.sum("__y").alias("s"), F.count(F.lit(1)).alias("n"),
                         F.count_distinct("group_key").alias("g")).alias("t")).scalar()
    ntr = F.col("__nc") - F.col("__ncf")
    y_pred = F.when(ntr > 0, (F.col("__sc") - F.col("__scf")) / ntr) \
        .otherwise((tot.getField("s") - F.col("__sf")) / (tot.getField("n") - F.col("__nf")))
    p = f.join(cf, [*cell, "fold"]).join(ct, cell).join(gf, "fold") \
        .select("fold", "__gf", F.col("__y").alias("y_true"), y_pred.alias("y_pred"))
    m = D.metric_exprs("y_true", "y_pred")
    per = p.groupBy("fold", "__gf").agg(m["rmse"].alias("rmse"), m["mae"].alias("mae"),
                                        m["r2"].alias("r2"), m["n"].alias("n_val"))
    return per.select((F.col("fold") + 1).cast("int").alias("fold"), "rmse", "mae", "r2",
                      (tot.getField("n") - F.col("n_val")).alias("n_train"), "n_val",
                      (tot.getField("g") - F.col("__gf")).alias("n_groups_train"),
                      F.col("__gf").alias("n_groups_val"))
