"""Model bundle: schema, persistence, scoring, input validation.

A bundle directory holds the fitted ``PipelineModel`` (ML persistence), and
small tables written by Spark: metrics and params (JSON records), the feature
schema (JSON) and the importance table (CSV with header).
"""

from __future__ import annotations

import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators.gaps import score_requests
from cohortlens.sources.tables import write_csv, write_json_records

MAX_DOMAIN = 200


def feature_schema(df: DataFrame, target: str | None = K.TARGET) -> DataFrame:
    """B1: per column dtype; for string columns distinct non-null count and the sorted
    domain when it has at most 200 values (else null).

    Distinct counts are partial aggregates on (column, value); domains are only
    collected for columns already known to be small (semi-join), so no task ever
    gathers an unbounded value set."""
    cols = [c for c in df.columns if c != target]
    strings = [c for c, t in df.dtypes if t == "string" and c != target]
    dtypes = df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes if c in cols],
                                             "column string, dtype string")
    if not strings:
        return dtypes.select("column", "dtype", F.lit(None).cast("bigint").alias("n_unique"),
                             F.lit(None).cast("array<string>").alias("domain"))
    long = df.select(*strings).unpivot([], strings, "column", "value") \
        .where(F.col("value").isNotNull()).distinct()
    n_unique = long.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    small = n_unique.where(F.col("n_unique") <= MAX_DOMAIN).select("column")
    domains = long.join(small, "column", "left_semi").groupBy("column") \
        .agg(F.sort_array(F.collect_list("value")).alias("domain"))
    return dtypes.join(n_unique, "column", "left").join(domains, "column", "left") \
        .select("column", "dtype", "n_unique", "domain")


def domain_violations(requests: DataFrame, schema: DataFrame, id_col: str) -> DataFrame:
    """(id, column, value) of request values outside a recorded (non-null) domain."""
    cols = [r["column"] for r in schema.where(F.col("domain").isNotNull()).select("column")
            .collect() if r["column"] in requests.columns]
    long = requests.select(id_col, *[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([id_col], cols, "column", "value").where(F.col("value").isNotNull())
    allowed = schema.where(F.col("domain").isNotNull()) \
        .select("column", F.explode("domain").alias("value"))
    return long.join(allowed, ["column", "value"], "left_anti")


def save_bundle(out_dir: str, model: PipelineModel, metrics: DataFrame, params: dict,
                schema: DataFrame, importance: DataFrame | None = None,
                model_name: str = "") -> None:
    """B2: write every bundle part under ``out_dir`` with Spark writers."""
    spark = metrics.sparkSession
    model.write().overwrite().save(os.path.join(out_dir, "pipeline"))
    write_json_records(metrics.coalesce(1), os.path.join(out_dir, "metrics"))
    spark.createDataFrame([(model_name, json.dumps(params, sort_keys=True))],
                          "model string, params string") \
        .coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "params"))
    write_json_records(schema.coalesce(1), os.path.join(out_dir, "feature_schema"))
    if importance is not None:
        write_csv(importance.coalesce(1), os.path.join(out_dir, "importance"))


# declared, never inferred: a column that is null in every row stays
METRICS_SCHEMA = "n bigint, rmse double, mae double, r2 double"
FEATURE_SCHEMA = "column string, dtype string, n_unique bigint, domain array<string>"


def load_bundle(spark: SparkSession, out_dir: str, with_importance: bool = True) -> dict:
    """Load the model and the small tables back, the importance table included."""
    return {
        "pipeline": PipelineModel.load(os.path.join(out_dir, "pipeline")),
        "metrics": spark.read.schema(METRICS_SCHEMA).json(os.path.join(out_dir, "metrics")),
        "params": spark.read.schema("model string, params string").json(os.path.join(out_dir, "params")),
        "feature_schema": spark.read.schema(FEATURE_SCHEMA).json(os.path.join(out_dir, "feature_schema")),
        "importance": spark.read.schema("feature string, importance double").option("header", True)
        .csv(os.path.join(out_dir, "importance")) if with_importance else None,
    }


def predict_with_bundle(bundle: dict, requests: DataFrame) -> DataFrame:
    """Score a request table; band = the bundle's test RMSE (default 36.5), clamped."""
    m = bundle["metrics"]
    rmse = m.agg(F.first("rmse", ignorenulls=True)).scalar() if "rmse" in m.columns \
        else F.lit(K.DEFAULT_BAND)
    return score_requests(bundle["pipeline"], requests, F.coalesce(rmse, F.lit(K.DEFAULT_BAND)))
