"""Registered queries: bundles of a closed-form model, pruned searches, record sinks read back, quartiles, ordered peek."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators import bundle as B
from cohortlens.operators import clean, profile
from cohortlens.operators import diagnostics as D
from cohortlens.operators import tune as T
from cohortlens.plans import q_linear as L
from cohortlens.plans import q_quality as Q
from cohortlens.plans.cohort import cohort, raw_records
from cohortlens.plans.oracle import with_views
from cohortlens.plans.registry import register
from cohortlens.session import scratch_path
from cohortlens.sources import tables as S

ID = "estu_consecutivo"


# ---------------------------------------------------------------- A12, L3
@register("describe_quartiles", sql=Q._raw(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min,
        quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, max(x) AS max
      FROM (SELECT cast(try_cast({c} AS bigint) AS double) AS x FROM raw)""" for c in Q.SCORES)),
          floats=["mean", "std", "min", "p25", "p50", "p75", "max"])
def describe_quartiles(spark, sf_dir):
    """A12 with quartiles."""
    return profile.describe(clean.cast_numeric(raw_records(spark, sf_dir), Q.SCORES), Q.SCORES, quartiles=True)


@register("peek_ordered", sql=with_views(f"SELECT * FROM cohort ORDER BY {ID} LIMIT 1000"))
def peek_ordered(spark, sf_dir):
    """L3: the first rows by id (limit is the feature; one partial top-k a task)."""
    return cohort(spark, sf_dir).orderBy(ID).limit(1000)


# ---------------------------------------------------------------- S6, S7: every record read back
GROUPS = f"""SELECT estu_mcpio_reside, fami_estratovivienda, count(*) AS n, avg({K.TARGET}) AS mean_score
    FROM cohort GROUP BY estu_mcpio_reside, fami_estratovivienda"""
GROUP_SCHEMA = "estu_mcpio_reside string, fami_estratovivienda string, n bigint, mean_score double"


def _groups(spark, sf_dir):
    return cohort(spark, sf_dir).groupBy("estu_mcpio_reside", "fami_estratovivienda").agg(
        F.count(F.lit(1)).alias("n"), F.avg(K.TARGET).alias("mean_score"))


@register("csv_roundtrip", sql=with_views(GROUPS), floats=["mean_score"])
def csv_roundtrip(spark, sf_dir):
    """A group table to CSV with header, every record read back typed (nulls stay null)."""
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    S.write_csv(_groups(spark, sf_dir), path)
    return spark.read.schema(GROUP_SCHEMA).option("header", True).csv(path)


@register("json_records_roundtrip", sql=with_views(GROUPS), floats=["mean_score"])
def json_records_roundtrip(spark, sf_dir):
    """The same table as JSON records, read back with its declared schema."""
    path = scratch_path(spark, f"json-{uuid.uuid4().hex}")
    S.write_json_records(_groups(spark, sf_dir), path)
    return spark.read.schema(GROUP_SCHEMA).json(path)


# ---------------------------------------------------------------- B2, B5, S8, R11, M9, M10
def _linear_bundle(spark, sf_dir):
    """(bundle of a least-squares pipeline saved and loaded back, its holdout)."""
    tr, te = L._holdout(L._rows(spark, sf_dir))
    model = Pipeline(stages=[VectorAssembler(inputCols=L.XS, outputCol="features"),
                             LinearRegression(labelCol=L.Y, solver="normal")]).fit(tr)
    scored = model.transform(te).select(F.col(L.Y).cast("double").alias("y_true"), F.col("prediction").alias("y_pred"))
    fitted = model.stages[-1]
    weights = spark.createDataFrame([(c, float(w)) for c, w in zip(L.XS, fitted.coefficients)], "feature string, importance double")
    out = scratch_path(spark, f"bundle-{uuid.uuid4().hex}")
    B.save_bundle(out, model, D.regression_report(scored), {"solver": "normal"}, B.feature_schema(tr, L.Y), weights, "linear")
    return B.load_bundle(spark, out), te


BUNDLE = L.HOLDOUT + f", s AS (SELECT {L.SUMS}, 0 AS a FROM tr), {L._fit('m', 's')}, sc AS (SELECT {ID}, y, {L.SCORE} FROM te, m)"


@register("bundle_linear_scores", sql=L._sql(BUNDLE + f""", r AS (SELECT sqrt(avg((y - p) * (y - p))) AS rmse FROM sc)
    SELECT {ID}, p AS prediction, greatest({K.SCORE_MIN}, p - rmse) AS lower, least({K.SCORE_MAX}, p + rmse) AS upper FROM sc, r"""),
          floats=["prediction", "lower", "upper"])
def bundle_linear_scores(spark, sf_dir):
    """The holdout scored by the loaded bundle, with its band of one RMSE."""
    b, te = _linear_bundle(spark, sf_dir)
    return B.predict_with_bundle(b, te).select(ID, "prediction", "lower", "upper")


@register("bundle_linear_metrics", sql=L._sql(BUNDLE + f" SELECT count(*) AS n, {L.METRICS} FROM sc"), floats=L.M)
def bundle_linear_metrics(spark, sf_dir):
    """The metrics record of the loaded bundle."""
    return _linear_bundle(spark, sf_dir)[0]["metrics"].select("n", *L.M)


@register("bundle_linear_weights", sql=L._sql(BUNDLE + f""" SELECT '{L.XS[0]}' AS feature, w1 AS importance FROM m
    UNION ALL SELECT '{L.XS[1]}', w2 FROM m"""), floats=["importance"])
def bundle_linear_weights(spark, sf_dir):
    """The per-feature table of the loaded bundle (here the coefficients)."""
    return _linear_bundle(spark, sf_dir)[0]["importance"]


# ---------------------------------------------------------------- E3: pruned search
PRUNED_TRIALS = 24
PRUNED_DRAWS = [T.draw("ridge", t)["alpha"] for t in range(PRUNED_TRIALS)]


def _pruned_sql() -> str:
    """Trials after the startup ones, one at a time: each sees the trials completed before it."""
    last = L.FOLDS - 1
    start = T.N_STARTUP_TRIALS
    steps = [f"""run AS MATERIALIZED (SELECT trial, row_number() OVER (PARTITION BY trial ORDER BY fold) - 1 AS step,
        avg(rmse) OVER (PARTITION BY trial ORDER BY fold) AS r FROM e)""",
             f"done{start - 1} AS MATERIALIZED (SELECT * FROM run WHERE trial < {start})",
             *(f"""stop{t} AS MATERIALIZED (SELECT min(step) AS halt FROM run q WHERE trial = {t} AND step < {last}
        AND r > (SELECT median(r) FROM done{t - 1} d WHERE d.step = q.step)),
    done{t} AS MATERIALIZED (SELECT * FROM done{t - 1} UNION ALL SELECT * FROM run WHERE trial = {t} AND (SELECT halt FROM stop{t}) IS NULL)"""
               for t in range(start, PRUNED_TRIALS))]
    halts = " ".join(f"WHEN {t} THEN (SELECT halt FROM stop{t})" for t in range(start, PRUNED_TRIALS))
    return ", " + L._search_sql("d", PRUNED_DRAWS) + ", " + ", ".join(steps) + f"""
    , ends AS (SELECT trial, a AS alpha, CASE trial {halts} END AS halt FROM dr)
    SELECT CAST(ends.trial AS INTEGER) AS trial, alpha, r AS rmse, CASE WHEN halt IS NULL THEN 'complete' ELSE 'pruned' END AS state
    FROM ends JOIN run ON run.trial = ends.trial AND run.step = coalesce(halt, {last})"""


@register("penalty_search_pruned", sql=L._sql(_pruned_sql()), floats=["rmse"])
def penalty_search_pruned(spark, sf_dir):
    """24 penalties, median pruning after the 10 startup trials, with each trial's state."""
    t = T.penalty_search(L._rows(spark, sf_dir), L.XS, PRUNED_TRIALS, L.FOLDS)
    return t.select("trial", F.col("params")["alpha"].alias("alpha"), "rmse", "state")
