"""SparkSession construction and cluster-safe lineage cuts."""

from __future__ import annotations

import contextvars
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults sized for a large cluster; tests override shuffle partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # identical exchanges across query branches are shuffled once (cohort joins,
    # range-block ranks and exact quantiles rely on it; see quantiles.py)
    "spark.sql.exchange.reuse": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Spark's own size check for broadcast: only sides whose estimated size is
    # below this are broadcast; larger sides fall back to a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable checkpoint files once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "cohortlens",
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the context's, else the one in ``spark.checkpoint.dir``.

    Only a local master may go without: then a scratch folder is chosen. On a cluster that
    folder would be the driver's alone, so a missing setting is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc.getCheckpointDir() is not None:
        d = os.path.dirname(sc.getCheckpointDir().rstrip("/"))  # Spark adds a folder of its own
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SCOPE: contextvars.ContextVar[tuple[str, ...]] = contextvars.ContextVar("scratch_scope", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables (inside the open scope)."""
    return os.path.join(checkpoint_dir(spark), "tables", *_SCOPE.get(), name)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark reads; none is fine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside are deleted at the end, also after an error. Frames made
    inside read them lazily, so a result must be written elsewhere, or used up, before the end.
    Scopes may be nested; threads started inside write outside of it. Gives the scope's folder."""
    token = _SCOPE.set((*_SCOPE.get(), f"scope-{uuid.uuid4().hex}"))
    folder = os.path.dirname(scratch_path(spark, "x"))
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        drop_path(spark, folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once as a columnar table in the shared checkpoint folder and read it back: cuts lineage
    like ``cut_lineage``, and later passes read only the columns they need."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
