"""Operator 2: exact duplicates through an extendible-hash index on shared files (native).

    1. Entries: rows are grouped by (64-bit key, text). The grouping compares whole texts,
       and its partial aggregate folds the copies of a text inside each map task, so a text
       that a third of all rows share sends one row per task. Texts that differ under one
       key stay separate entries: the key's chain.
    2. Directory: it starts with one bucket and doubles where a bucket is overfull, one more
       leading bit of the key at a time, until every bucket fits or ``directory_bits`` are
       used. It has at most 2 ** directory_bits cells; the capacity follows the number of
       entries so that this depth suffices.
    3. Pages: owner tasks take contiguous key ranges (whole buckets), order each key's chain
       and write the pages to the shared folder.
    4. Every document finds its entry by key and chain link; Spark splits a hot key's
       documents, whose other side is a single entry.

DataFrame functions only. ``key_bits`` below 64 shortens keys, to force chains in tests.

Defined results: null counts as empty text, and all empty texts are equal; of equal texts
the largest doc_id stays, and of rows that repeat an id and a text exactly one stays; a null
id stays only if no other row has the text; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import shuffle_partitions, via_table

DIRECTORY_BITS = 12
BUCKET_ENTRIES = 4096


def _key(text: Column, key_bits: int) -> Column:
    h = F.xxhash64(text)
    return h if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - key_bits), 64 - key_bits)


def entries(docs: DataFrame, key_bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: key, text_sha256, keep_id, group_size."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
            .withColumn("key", _key(F.col("text"), key_bits))
            .groupBy("key", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .select("key", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))


def directory(counts: dict[int, int], bits: int, capacity: int) -> list[tuple[int, int]]:
    """(first cell, depth) of every bucket, by doubling from one bucket of depth 0."""
    done, todo, depth = [], [(0, counts)], 0
    while todo:
        split = []
        for first, cells in todo:
            if depth == bits or sum(cells.values()) <= capacity:
                done.append((first, depth))
                continue
            half = first + (1 << (bits - depth - 1))
            split += [(first, {c: n for c, n in cells.items() if c < half}),
                      (half, {c: n for c, n in cells.items() if c >= half})]
        todo, depth = split, depth + 1
    return sorted(done)


def build_index(docs: DataFrame, key_bits: int = 64, bits: int = DIRECTORY_BITS, bucket_entries: int = BUCKET_ENTRIES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index pages: bucket, depth, key, chain, text_sha256, keep_id, group_size."""
    spark = docs.sparkSession
    found = via_table(entries(docs, key_bits, id_col, text_col), "dedup-entries")
    cell = F.shiftrightunsigned("key", 64 - bits)
    counts = {r.cell: r.n for r in found.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    capacity = max(bucket_entries, -(-4 * sum(counts.values()) >> bits))
    buckets = directory(counts, bits, capacity)
    cells = [(c, first, depth) for first, depth in buckets for c in range(first, first + (1 << (bits - depth)))]
    table = spark.createDataFrame(cells, "cell long, bucket long, depth int")
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    link = Window.partitionBy("bucket", "key", "text_sha256")
    pages = (found.withColumn("cell", cell).join(F.broadcast(table), "cell")  # 2 ** bits rows at most
             .repartitionByRange(shuffle_partitions(spark), "bucket", "key")
             .withColumn("chain", F.row_number().over(chain))
             .withColumn("key", F.when(F.count(F.lit(1)).over(link) > 1,
                                       F.raise_error(F.lit("two texts share key and digest"))).otherwise(F.col("key"))))
    return via_table(pages.select("bucket", "depth", "key", "chain", "text_sha256", "keep_id", "group_size"), "dedup-index")


def exact_dedup(docs: DataFrame, key_bits: int = 64, bits: int = DIRECTORY_BITS, bucket_entries: int = BUCKET_ENTRIES,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain."""
    index = build_index(docs, key_bits, bits, bucket_entries, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text, key_bits).alias("key"),
                        F.sha2(text, 256).alias("text_sha256"))
            .groupBy("doc_id", "key", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
            .select("doc_id", "key", "text_sha256", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")))
    return rows.join(index, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256", "bucket", "chain")
