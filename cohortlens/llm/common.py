"""Small helpers shared by the operators: scans, shared-folder tables, session sizes."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import scratch_path
from cohortlens.sources.tables import table_path

WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    """Place of a public vocabulary file; present on the driver and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder (one per run, never overwritten)."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def via_table(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives a lost
    executor, and lets later readers prune columns."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(batches, column: int = 1, size: int = 1 << 20):
    """Arrow batches cut into row ranges that hold about ``size`` bytes of a text column (one row at
    least), so that what a worker builds from a range is bounded by bytes, not by rows."""
    import pyarrow.compute as pc

    for batch in batches:
        lo, held = 0, 0
        for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if k > lo and held + n > size:
                yield batch.slice(lo, k - lo)
                lo, held = k, 0
            held += n
        if lo < batch.num_rows:
            yield batch.slice(lo)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_digest(text_col: str = "text") -> Column:
    """SHA-256 of the whole text; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", **also: Column) -> DataFrame:
    """Rows of docs whose id (null included) is among the kept ids. ``also`` names further columns
    of kept, each with its expression over docs: decisions on rows rather than on ids. The join
    ignores repeated keys; a distinct here would run in the exchange of kept, by a hot host."""
    keys = {"doc_id": F.col(id_col), **also}
    ids = kept.select(*(F.col(c).alias(f"_kept_{c}") for c in keys))
    same = [e.eqNullSafe(F.col(f"_kept_{c}")) for c, e in keys.items()]
    return docs.join(ids, functools.reduce(Column.__and__, same), "left_semi")
