"""Co-partitioned tables (S4, J1, W4): rows and lookups bucketed alike join without an exchange.

A table that is joined on the same key again and again is written once in ``n`` buckets of
(key, salt). Spark plans a join of two tables with the same buckets as a merge of bucket i with
bucket i: nothing is shuffled. The salt, ``pmod(xxhash64(id), salts)``, deals a hot key's rows
over up to ``salts`` buckets (a bucketed join has no exchange that adaptive execution could
split); the lookup side holds each key once per salt, so it grows by that factor and not with the
rows. A group aggregate over the table first reduces within (key, salt) where the rows are.

The tables are external: the files lie under ``path``, the session's catalog knows their buckets.
Another session registers the same files with ``open_bucketed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "__salt"
SALTS = 8
BUCKETS = 64


def salt_of(id_col: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int")


def with_salt(df: DataFrame, id_col: str, salts: int = SALTS) -> DataFrame:
    """Rows with their salt."""
    return df.withColumn(SALT, salt_of(id_col, salts))


def replicated(lookup: DataFrame, salts: int = SALTS) -> DataFrame:
    """A lookup with every row once per salt."""
    return lookup.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` buckets of ``keys``, sorted within, as catalog table
    ``table``, and read it. Rows are exchanged by the buckets' own hash first: one file a bucket."""
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet") \
        .option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema, keys: list[str],
                  buckets: int = BUCKETS) -> DataFrame:
    """Register the files of an earlier ``write_bucketed`` (same keys and buckets) in this session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)
