"""Incremental consolidation of landed files.

A landing folder only grows: new files are added to it, none is rewritten. ``consolidate`` runs a
file stream once over what is there (``availableNow``) and appends it to a parquet table. Which
files were read is kept in the stream's checkpoint, which files were written in the table's own
log, so every landed file enters the table once: a repeated run adds nothing, and a run that was
lost after writing is not written a second time when it is repeated.

Files may gain columns over time. The schema of a run is the union of the columns of all landed
files (parquet: from the footers, by a Spark job) or the declared columns (JSON: all strings); rows
of files without a column have null there. A column whose type changes in a way parquet cannot
merge is an error, before anything is read.

Rows are written by the tasks that read them: no shuffle, and no state that grows with the table
except the two lists of file names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortlens.sources.tables import all_string_schema


def landed_schema(spark: SparkSession, landing: str) -> T.StructType:
    """The union of the columns of every parquet file under ``landing``, all nullable, without the data."""
    merged = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(landing).schema
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in merged])


def consolidate(spark: SparkSession, landing: str, table: str, checkpoint: str, fmt: str = "parquet",
                columns: list[str] | None = None, max_files: int = 10_000) -> int:
    """Append every file that landed since the last run; returns the rows added by this run.

    ``checkpoint`` belongs to this pair of folders and is never shared. ``columns`` declares the
    all-string columns of text formats. ``max_files`` bounds a batch's file list, not the run:
    ``availableNow`` goes on with batches until all files are in."""
    schema = landed_schema(spark, landing) if columns is None else all_string_schema(columns)
    rows = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files) \
        .option("recursiveFileLookup", True).load(landing)
    run = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(p["numInputRows"] for p in run.recentProgress)


def read_consolidated(spark: SparkSession, table: str) -> DataFrame:
    """The table as its log lists it (files of an unfinished run are not seen), all columns of all runs."""
    return spark.read.option("mergeSchema", True).parquet(table)
