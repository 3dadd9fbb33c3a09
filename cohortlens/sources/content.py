"""Content fingerprints of files.

A file is cut into fixed byte ranges, each range is digested (SHA-256) by itself, and the file's
digest is the SHA-256 of its ranges' digests in order (64 lowercase hex digits each, joined
without a separator). It depends on the bytes and the range size alone, not on how Spark splits the work, so a file
that changed in any byte differs even if it still holds the same rows.

Ranges are rows: they are dealt out over the cluster and a task reads one range at a time, so a
file of any size takes as many tasks as there are. Ranges are read through Arrow's file systems
(local and mounted paths, HDFS, S3, GCS). Files of any other scheme go through Spark's
``binaryFile`` reader, which holds a whole file in a cell and refuses more than 2 GB.
"""

from __future__ import annotations

import hashlib
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 8 << 20
ARROW_SCHEMES = ("", "file", "hdfs", "s3", "s3a", "gs")


def _digest_ranges(range_bytes: int):
    def run(batches):
        from pyarrow import fs

        for batch in batches:
            out = []
            for path, start, size in zip(*(batch.column(k).to_pylist() for k in range(3))):
                u = urlparse(path)
                if u.scheme in ("", "file"):
                    source, inner = fs.LocalFileSystem(), u.path
                else:
                    source, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                with source.open_input_file(inner) as f:
                    data = f.read_at(min(range_bytes, size - start), start)
                if len(data) != min(range_bytes, size - start):
                    raise OSError(f"{path} changed while it was read")
                out.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             names=["path", "start", "n_bytes", "digest"])
    return run


def _starts(range_bytes: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))


def _by_ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    ranges = files.select("path", F.explode(_starts(range_bytes)).alias("start"), F.col("length").alias("n_bytes"))
    done = ranges.repartition("path", "start").mapInArrow(
        _digest_ranges(range_bytes), "path string, start bigint, n_bytes bigint, digest string")
    inner = F.sort_array(F.collect_list(F.struct("start", "digest")))
    return done.groupBy("path", "n_bytes").agg(
        F.count(F.lit(1)).alias("n_ranges"),
        F.sha2(F.array_join(F.transform(inner, lambda r: r["digest"]), ""), 256).alias("content_sha256"))


def _by_spark(files: DataFrame, range_bytes: int) -> DataFrame:
    digests = F.transform(_starts(range_bytes), lambda s: F.sha2(F.substring("content", (s + 1).cast("int"), F.lit(range_bytes)), 256))
    return files.select("path", F.col("length").alias("n_bytes"), F.size(digests).cast("long").alias("n_ranges"),
                        F.sha2(F.array_join(digests, ""), 256).alias("content_sha256"))


def content_fingerprints(spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES,
                         through_spark: bool | None = None) -> DataFrame:
    """One row per file under ``paths`` (files or folders): path, name, n_bytes, n_ranges, content_sha256.

    Spark's readers pass over empty files: they have no row, and a file that became empty shows as
    removed in ``changed_files``. ``through_spark`` forces Spark's reader (true) or ranges
    (false); by default the files' scheme decides. Both give the same digests."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    if through_spark is None:
        scheme = F.regexp_extract("path", r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
        through_spark = not files.where(~scheme.isin(*ARROW_SCHEMES)).select("path").isEmpty()
    out = _by_spark(files, range_bytes) if through_spark else _by_ranges(files.select("path", "length"), range_bytes)
    return out.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "n_bytes", "n_ranges", "content_sha256")


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files by path that differ between two fingerprints: added, removed or changed."""
    a = before.select("path", F.col("content_sha256").alias("old"))
    b = after.select("path", F.col("content_sha256").alias("new"))
    return a.join(b, "path", "full").where(~F.col("old").eqNullSafe(F.col("new"))).select(
        "path", F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
        .otherwise("changed").alias("change"))
