"""Scans and sinks.

Every scan is lazy and column-pruned: callers pass the columns they need so the
parquet reader's ``ReadSchema`` holds only those, and filters written after the
scan are pushed into it by Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of one table (file or directory), optionally pruned."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_folder(spark: SparkSession, folder: str, fmt: str = "parquet",
                schema: T.StructType | None = None) -> DataFrame:
    """Scan every file of a format under a folder (glob ``*.fmt``)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(os.path.join(folder, f"*.{fmt}"))


def all_string_schema(columns: list[str]) -> T.StructType:
    """Raw records arrive as strings; never infer."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet sink, optionally partitioned (e.g. by period for pruning).

    Rows are rebalanced on the partition columns first: a folder gets a few files instead of
    one from every task, and Spark splits a folder that holds too many rows."""
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def land_json(spark: SparkSession, json_dir: str, columns: list[str], out_path: str) -> DataFrame:
    """JSON landing pages (all-string records) -> parquet table."""
    df = spark.read.schema(all_string_schema(columns)).json(json_dir)
    write_parquet(df, out_path)
    return spark.read.parquet(out_path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with header (one file per partition; small tables coalesce)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv_top(spark: SparkSession, path: str, schema: T.StructType, sort_col: str,
                 k: int = 20) -> DataFrame:
    """Typed CSV scan, top-k by a column (TakeOrderedAndProject)."""
    return spark.read.schema(schema).option("header", True).csv(path) \
        .orderBy(F.col(sort_col).desc()).limit(k)


def write_json_records(df: DataFrame, path: str) -> None:
    """JSON record sink (metadata/params/metrics/schema)."""
    df.write.mode("overwrite").json(path)


def file_fingerprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per parquet file: rows, and order-free sum and xor of row hashes. Files are
    read by splits, so a file of any size is many tasks and no cell holds a file."""
    out = None
    for path in paths:
        df = spark.read.parquet(path)
        name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
        one = row_fingerprint(df.withColumn("__file", name), by=["__file"], columns=df.columns)
        out = one if out is None else out.unionByName(one)
    return out.withColumnRenamed("__file", "name")


def row_fingerprint(df: DataFrame, by: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Order-insensitive fingerprint of a table's rows: count, xor and sum of row hashes
    (the sum still moves when a row is present twice)."""
    h = F.xxhash64(*[F.col(c) for c in columns or df.columns])
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(h).alias("xor_hash"),
                                       F.sum(h.cast("decimal(38,0)")).alias("sum_hash"))
