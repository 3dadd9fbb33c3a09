"""Registered queries: linear learners from sufficient statistics, with SQL for two features.

Every query fits and scores all rows that have both features and the target; the SQL solves the same
normal equations from sums.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import features as FX
from cohortlens.operators import diagnostics as D
from cohortlens.operators import gram
from cohortlens.operators import split as SP
from cohortlens.operators import tune as T
from cohortlens.operators.ml import LASSO_ALPHA, RIDGE_ALPHA
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort
from cohortlens.plans.oracle import with_views
from cohortlens.plans.q_model import greedy_folds_sql, recursive
from cohortlens.plans.registry import register
from cohortlens.session import cut_lineage

ID, Y, GROUP = "estu_consecutivo", K.TARGET, "estu_mcpio_reside"
XS = ["fami_personashogar_num", "indice_socioeconomico"]
CUT = R.TRAIN_UNTIL
HASH = f"md5(concat(cast({ID} AS string), '#{K.SEED}'))"
FOLDS, TRIALS = 3, 12
PATH = [0.001, 1.0, RIDGE_ALPHA, 1000.0, 100000.0]
M = ["rmse", "mae", "r2"]
DRAWS = [T.draw("ridge", t)["alpha"] for t in range(TRIALS)]


def _rows(spark, sf_dir):
    """The complete rows, written once: splits, fits and scores read that table."""
    df = FX.add_deterministic_features(cohort(spark, sf_dir)).select(ID, "periodo", GROUP, *XS, Y)
    return cut_lineage(df.na.drop(subset=[*XS, Y]))


def _holdout(rows):
    s = SP.stratified_split(rows, ID, "periodo", 0.2)
    return s.where(F.col("role") == "train"), s.where(F.col("role") == "test")


# ---------------------------------------------------------------- SQL
ROWS = f""", d AS (SELECT {ID}, periodo, {GROUP}, cast({XS[0]} AS double) AS x1, cast({XS[1]} AS double) AS x2, cast({Y} AS double) AS y
      FROM feat WHERE {XS[0]} IS NOT NULL AND {XS[1]} IS NOT NULL AND {Y} IS NOT NULL)"""
HOLDOUT = f""", h0 AS (SELECT *, row_number() OVER (PARTITION BY periodo ORDER BY {HASH}, {ID}) AS rk,
      count(*) OVER (PARTITION BY periodo) AS ns FROM d),
    h AS (SELECT *, rk <= round(0.2 * ns) AS is_test FROM h0),
    tr AS (SELECT * FROM h WHERE NOT is_test), te AS (SELECT * FROM h WHERE is_test)"""
_S = ["n", "s1", "s2", "sy", "s11", "s12", "s22", "s1y", "s2y", "syy"]
SUMS = """count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy, sum(x1 * x1) AS s11, sum(x1 * x2) AS s12,
      sum(x2 * x2) AS s22, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y, sum(y * y) AS syy"""


def _fit(name: str, src: str, keys: str = "") -> str:
    """CTE ``name``: coefficients (w1, w2, b) of every row of ``src`` (sums and a penalty ``a``)."""
    k = keys + ", " if keys else ""
    return f"""{name}_c AS (SELECT {k}n, s1, s2, sy, s11 - s1 * s1 / n + a AS c11, s12 - s1 * s2 / n AS c12, s22 - s2 * s2 / n + a AS c22,
      s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y FROM {src}),
    {name}_w AS (SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS w1, (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS w2 FROM {name}_c),
    {name} AS (SELECT {k}w1, w2, (sy - w1 * s1 - w2 * s2) / n AS b FROM {name}_w)"""


METRICS = """sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
      1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(y), 0) AS r2"""
SCORE = "x1 * w1 + x2 * w2 + b AS p"


def _search_sql(src: str, drawn: list[float] = DRAWS) -> str:
    """CTE ``trials`` (trial, a, rmse): mean RMSE over the folds of each drawn penalty."""
    draws = ", ".join(f"({t}, CAST({a!r} AS DOUBLE))" for t, a in enumerate(drawn))
    both = ", ".join(f"t.{c} - f.{c} AS {c}" for c in _S)
    return f"""kf AS (SELECT *, (row_number() OVER (ORDER BY {HASH}, {ID}) - 1) % {FOLDS} AS fold FROM {src}),
    fs AS (SELECT fold, {SUMS} FROM kf GROUP BY fold), ft AS (SELECT {SUMS} FROM kf),
    dr(trial, a) AS (VALUES {draws}),
    ls AS (SELECT fold, trial, a, {both} FROM fs f, ft t, dr),
    {_fit("m", "ls", "fold, trial")},
    e AS (SELECT kf.fold, trial, sqrt(avg((y - (x1 * w1 + x2 * w2 + b)) * (y - (x1 * w1 + x2 * w2 + b)))) AS rmse
          FROM kf JOIN m ON kf.fold = m.fold GROUP BY kf.fold, trial),
    trials AS (SELECT dr.trial, a, avg(rmse) AS rmse FROM e JOIN dr ON e.trial = dr.trial GROUP BY dr.trial, a)"""


def _sql(body: str) -> str:
    return with_views(ROWS + body, features=True)


# ---------------------------------------------------------------- R2, R3: fits
@register("linear_two_features", sql=_sql(HOLDOUT + f""", s AS (SELECT {SUMS}, 0 AS a FROM tr), {_fit("m", "s")},
    sc AS (SELECT y, {SCORE} FROM te, m)
    SELECT w1, w2, b AS intercept, q.* FROM m, (SELECT {METRICS}, count(*) AS n FROM sc) q"""), floats=["w1", "w2", "intercept", *M])
def linear_two_features(spark, sf_dir):
    """R2: least squares on the stratified training part, coefficients and metrics on the rest."""
    tr, te = _holdout(_rows(spark, sf_dir))
    w, b = gram.solve(gram.total(gram.collect_grams(tr, XS, Y)), "linear")
    rep = D.regression_report(gram.predictions(te, XS, {0: (w, b)}, Y))
    return rep.select(F.lit(float(w[0])).alias("w1"), F.lit(float(w[1])).alias("w2"), F.lit(b).alias("intercept"), *M, "n")


@register("ridge_path", sql=_sql(f""", al(a) AS (VALUES {", ".join(f"(CAST({a!r} AS DOUBLE))" for a in PATH)}),
    s AS (SELECT * FROM (SELECT {SUMS} FROM d) q, al), {_fit("m", "s", "a")}
    SELECT a AS alpha, w1, w2, b AS intercept, sqrt(avg((y - (x1 * w1 + x2 * w2 + b)) * (y - (x1 * w1 + x2 * w2 + b)))) AS rmse
    FROM d, m GROUP BY a, w1, w2, b"""), floats=["w1", "w2", "intercept", "rmse"])
def ridge_path(spark, sf_dir):
    """R3 for many penalties from one matrix: coefficients and training RMSE."""
    g = gram.total(gram.collect_grams(_rows(spark, sf_dir), XS, Y))
    rows = [(a, *map(float, w), g.intercept(w), g.scores(w, g.intercept(w))[0]) for a, w in zip(PATH, g.ridge(PATH))]
    return spark.createDataFrame(rows, "alpha double, w1 double, w2 double, intercept double, rmse double")


# ---------------------------------------------------------------- E1-E5: search
@register("penalty_search", sql=_sql(f", {_search_sql('d')} SELECT 'ridge' AS model, CAST(trial AS INTEGER) AS trial, a AS alpha, rmse FROM trials"),
          floats=["rmse"])
def penalty_search(spark, sf_dir):
    """Seeded penalties, mean RMSE over folds; the states are E3's and have a test of their own."""
    t = T.penalty_search(_rows(spark, sf_dir), XS, TRIALS, FOLDS, n_startup=TRIALS)
    return t.select("model", "trial", F.col("params")["alpha"].alias("alpha"), "rmse")


@register("penalty_comparison", sql=_sql(f", {_search_sql('d')} " + """
    SELECT 'ridge' AS model, min(rmse) AS best_cv_rmse, count(*) AS n_trials, arg_min(a, rmse) AS best_alpha FROM trials"""),
          floats=["best_cv_rmse"])
def penalty_comparison(spark, sf_dir):
    """E4 over the closed-form search."""
    t = D.comparison_table(T.penalty_search(_rows(spark, sf_dir), XS, TRIALS, FOLDS, n_startup=TRIALS))
    return t.select("model", "best_cv_rmse", "n_trials", F.col("best_params")["alpha"].alias("best_alpha"))


@register("penalty_fit_best", sql=_sql(HOLDOUT + f""", {_search_sql('tr')},
    s AS (SELECT * FROM (SELECT {SUMS} FROM tr) q, (SELECT arg_min(a, rmse) AS a FROM trials) z), {_fit("best", "s", "a")},
    sc AS (SELECT y, a, {SCORE} FROM te, best)
    SELECT a AS alpha, {METRICS}, count(*) AS n FROM sc GROUP BY a"""), floats=M)
def penalty_fit_best(spark, sf_dir):
    """E5: search on the training part, refit the best penalty on all of it, E6 on the holdout."""
    tr, te = _holdout(_rows(spark, sf_dir))
    best = (T.penalty_search(tr, XS, TRIALS, FOLDS, n_startup=TRIALS).where("state = 'complete'")
            .orderBy("rmse", "trial").first()["params"]["alpha"])
    return T.holdout_linear(tr, te, XS, "ridge", best).select(F.lit(best).alias("alpha"), *M, "n")


# ---------------------------------------------------------------- E7-E10: validation schemes
GROUPS = f""", kk AS (SELECT *, coalesce(cast({GROUP} AS string), '{K.MISSING_GROUP}') AS g FROM d),
    gs AS (SELECT g, count(*) AS sz FROM kk GROUP BY g), {greedy_folds_sql("gs")},
    kf AS (SELECT kk.*, fold FROM kk JOIN fo ON kk.g = fo.g),
    fs AS (SELECT fold, {SUMS} FROM kf GROUP BY fold), ft AS (SELECT {SUMS} FROM kf),
    ls AS (SELECT fold, 0 AS a, {", ".join(f"t.{c} - f.{c} AS {c}" for c in _S)} FROM fs f, ft t), {_fit("gm", "ls", "fold")},
    sc AS (SELECT kf.fold, g, y, {SCORE} FROM kf JOIN gm ON kf.fold = gm.fold),
    folds AS (SELECT cast(fold + 1 AS int) AS fold, {METRICS}, (SELECT count(*) FROM kf) - count(*) AS n_train, count(*) AS n_val,
      (SELECT count(DISTINCT g) FROM kf) - count(DISTINCT g) AS n_groups_train, count(DISTINCT g) AS n_groups_val FROM sc GROUP BY fold)"""
TEMPORAL = f""", tt AS (SELECT {SUMS}, 0 AS a FROM d WHERE periodo <= '{CUT}'), {_fit("tm", "tt")},
    ts AS (SELECT y, {SCORE} FROM d, tm WHERE periodo > '{CUT}')"""
HELD = f", hs AS (SELECT {SUMS}, 0 AS a FROM tr), {_fit('hm', 'hs')}, hp AS (SELECT y, {SCORE} FROM te, hm)"


@register("group_kfold_linear", sql=recursive(_sql(GROUPS + " SELECT * FROM folds")), floats=M)
def group_kfold_linear(spark, sf_dir):
    return T.group_kfold_linear(_rows(spark, sf_dir), XS, GROUP)


@register("fold_summary_linear", sql=recursive(_sql(GROUPS + """ SELECT count(*) AS n_splits, avg(rmse) AS rmse_mean,
    stddev_samp(rmse) AS rmse_std, avg(mae) AS mae_mean, avg(r2) AS r2_mean FROM folds""")),
          floats=["rmse_mean", "rmse_std", "mae_mean", "r2_mean"])
def fold_summary_linear(spark, sf_dir):
    return D.fold_summary(T.group_kfold_linear(_rows(spark, sf_dir), XS, GROUP))


def _temporal(rows):
    parts = SP.temporal_split(rows, "periodo", CUT, check=True)
    return parts.where(F.col("role") == "train"), parts.where(F.col("role") == "test")


@register("temporal_holdout_linear", sql=_sql(TEMPORAL + f" SELECT {METRICS}, count(*) AS n FROM ts"), floats=M)
def temporal_holdout_linear(spark, sf_dir):
    """E8 with a linear learner."""
    return T.holdout_linear(*_temporal(_rows(spark, sf_dir)), XS).select(*M, "n")


@register("robustness_linear", sql=recursive(_sql(HOLDOUT + HELD + GROUPS + TEMPORAL + f"""
    SELECT 'holdout' AS scheme, {METRICS}, count(*) AS n FROM hp
    UNION ALL SELECT 'group_kfold', avg(rmse), avg(mae), avg(r2), CAST(sum(n_val) AS BIGINT) FROM folds
    UNION ALL SELECT 'temporal', {METRICS}, count(*) FROM ts""")), floats=M)
def robustness_linear(spark, sf_dir):
    """The metrics of the three schemes."""
    rows = _rows(spark, sf_dir)
    return T.robustness_summary(T.holdout_linear(*_holdout(rows), XS), T.group_kfold_linear(rows, XS, GROUP),
                                T.holdout_linear(*_temporal(rows), XS))


@register("baseline_linear_rows", sql=_sql(HOLDOUT + HELD + f""", np AS (SELECT y, (SELECT avg(y) FROM tr) AS p FROM te)
    SELECT 'naive_mean' AS model, {METRICS}, count(*) AS n FROM np UNION ALL SELECT 'linear', {METRICS}, count(*) FROM hp"""), floats=M)
def baseline_linear_rows(spark, sf_dir):
    """Naive mean and linear baseline on the same rows."""
    tr, te = _holdout(_rows(spark, sf_dir))
    mu = tr.agg(F.avg(Y)).scalar()
    naive = D.regression_report(te.select(F.col(Y).cast("double").alias("y_true"), mu.alias("y_pred")))
    return (naive.select(F.lit("naive_mean").alias("model"), *M, "n")
            .unionByName(T.holdout_linear(tr, te, XS).select(F.lit("linear").alias("model"), *M, "n")))


@register("lasso_two_features", sql=_sql(f""", s AS (SELECT {SUMS} FROM d),
    c AS (SELECT n, s1, s2, sy, s11 - s1 * s1 / n AS c11, s12 - s1 * s2 / n AS c12, s22 - s2 * s2 / n AS c22,
            s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y, {LASSO_ALPHA} / 10 * n AS l FROM s),
    cand AS (SELECT *, 0.0 AS w1, 0.0 AS w2 FROM c
      UNION ALL SELECT *, sign(c1y) * greatest(abs(c1y) - l, 0) / c11, 0.0 FROM c
      UNION ALL SELECT *, 0.0, sign(c2y) * greatest(abs(c2y) - l, 0) / c22 FROM c
      {" ".join(f"UNION ALL SELECT *, (c22 * (c1y - {i} * l) - c12 * (c2y - {j} * l)) / (c11 * c22 - c12 * c12), (c11 * (c2y - {j} * l) - c12 * (c1y - {i} * l)) / (c11 * c22 - c12 * c12) FROM c" for i in (-1, 1) for j in (-1, 1))}),
    cost AS (SELECT *, 0.5 * (w1 * w1 * c11 + 2 * w1 * w2 * c12 + w2 * w2 * c22) - w1 * c1y - w2 * c2y + l * (abs(w1) + abs(w2)) AS f FROM cand)
    SELECT w1, w2, (sy - w1 * s1 - w2 * s2) / n AS intercept FROM cost ORDER BY f LIMIT 1"""), floats=["w1", "w2", "intercept"])
def lasso_two_features(spark, sf_dir):
    """R4 on two features; the SQL takes the best of all sign patterns."""
    g = gram.total(gram.collect_grams(_rows(spark, sf_dir), XS, Y))
    w, b = gram.solve(g, "lasso", LASSO_ALPHA / 10)
    return spark.createDataFrame([(float(w[0]), float(w[1]), b)], "w1 double, w2 double, intercept double")
