"""Operator 6: training order on fixed-stride shards.

    1. Documents become sequences of at most ``length`` tokens; the sequence table is written
       once, with its place (partition, row), and counted.
    2. A sequence's dense index (rows of the partitions before, plus its row) goes through a
       keyed Feistel network over the next even power of two; values outside [0, N) walk the
       cycle until they fall inside. The result is a permutation of the N slots that depends
       on the key and N alone, found without a sort or a shuffle.
    3. Slots are range-partitioned by shard. A task writes whole shards of
       ``records`` sequences: one row a shard, whose payload holds one record every
       ``stride`` bytes (id, piece, token count, padded tokens).
A reader that stopped at slot s opens shard s // records at byte (s % records) * stride;
shards are rows sorted by number, so earlier ones are skipped by Parquet statistics.

Defined results: a null or empty text is one sequence without tokens; repeated rows are
sequences each; a null id stays null; an empty table gives no shards; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import new_table_path, shuffle_partitions, sliced, tokenizer_path
from cohortlens.llm.wordbpe import word_bpe

LENGTH = 512
RECORDS = 4096
SLICE = 1 << 23   # bytes of text whose distinct words are encoded together
ROUNDS = 6
HEAD = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("n_tokens", "<i4")])
NO_ID = np.iinfo(np.int64).min


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of indexes in [0, n): a keyed permutation, by cycle walking."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (2 ** 64 - 1)))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & low
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & low)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _sequences(path: str, length: int):
    def run(batches):
        enc = word_bpe(path)
        width = enc.dtype.itemsize * length
        for batch in sliced(batches, size=SLICE):
            tokens, at = enc.encode_column(batch.column(1))
            pieces = np.maximum(1, -(-np.diff(at) // width))
            doc = np.repeat(np.arange(batch.num_rows), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            starts = np.append(at[doc] + piece * width, at[-1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()),
                 pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(starts), tokens])],
                names=["doc_id", "piece", "tokens"])
    return run


def _slots(before, n: int, key: int):
    def run(batches):
        first = before.value
        for batch in batches:
            pid, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
            base = np.array([first[p] for p in pid.tolist()], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(feistel(base + place, n, key), pa.int64())],
                                             names=["doc_id", "piece", "tokens", "slot"])
    return run


def _write_shards(path: str, length: int, records: int):
    def run(batches):
        item = word_bpe(path).dtype.itemsize
        width = item * length
        shard, buf, count = None, bytearray(), 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([count], pa.int32()),
                                               pa.array([HEAD.itemsize + width], pa.int32()), pa.array([bytes(buf)], pa.binary())],
                                              names=["shard", "records", "stride", "payload"])
        for batch in batches:
            for i, piece, tokens, slot in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if slot // records != shard:
                    if count:
                        yield flush()
                    shard, buf, count = slot // records, bytearray(), 0
                buf += np.array((NO_ID if i is None else i, piece, len(tokens) // item), HEAD).tobytes()
                buf += tokens.ljust(width, b"\0")
                count += 1
        if count:
            yield flush()
    return run


def write_training_order(docs: DataFrame, key: int, path: str | None = None, length: int = LENGTH, records: int = RECORDS,
                         id_col: str = "doc_id", text_col: str = "text") -> tuple[str, int]:
    """Writes the shards to the shared folder; returns their folder and the number of sequences."""
    spark = docs.sparkSession
    path = path or tokenizer_path()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    seqs = (rows.mapInArrow(_sequences(path, length), "doc_id long, piece int, tokens binary")
            .withColumn("pid", F.spark_partition_id())
            .withColumn("place", F.monotonically_increasing_id() - F.shiftleft(F.col("pid").cast("long"), 33)))
    folder = new_table_path(spark, "sequences")
    seqs.write.option("compression", "zstd").parquet(folder)
    table = spark.read.schema(seqs.schema).parquet(folder)
    before, n = {}, 0
    for r in sorted(table.groupBy("pid").count().collect()):  # one row a partition
        before[r.pid] = n
        n += r["count"]
    slots = (table.mapInArrow(_slots(spark.sparkContext.broadcast(before), n, key), "doc_id long, piece int, tokens binary, slot long")
             .withColumn("shard", F.floor(F.col("slot") / records)))
    shards = (slots.repartitionByRange(shuffle_partitions(spark), "shard").sortWithinPartitions("slot")
              .drop("shard").mapInArrow(_write_shards(path, length, records), "shard long, records int, stride int, payload binary"))
    out = new_table_path(spark, "shards")
    shards.write.option("compression", "zstd").parquet(out)
    return out, n


SHARD = "shard long, records int, stride int, payload binary"
RECORD = "slot long, shard long, record int, byte_offset long, doc_id long, piece int, n_tokens long, ids_crc32 long"


def _records(path: str, records: int, first_slot: int):
    def run(batches):
        dtype = word_bpe(path).dtype
        for batch in batches:
            for shard, count, stride, payload in zip(*(batch.column(k).to_pylist() for k in range(4))):
                head = np.ndarray(count, HEAD, payload, strides=(stride,))
                lo = max(0, first_slot - shard * records)
                at = np.arange(lo, count)
                crc = [zlib.crc32(np.frombuffer(payload, dtype, int(head["n_tokens"][k]), int(k) * stride + HEAD.itemsize).astype("<u4"))
                       for k in at]
                ids = head["doc_id"][lo:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard * records + at, pa.int64()), pa.array(np.full(len(at), shard), pa.int64()), pa.array(at, pa.int32()),
                     pa.array(at * stride, pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID),
                     pa.array(head["piece"][lo:].copy(), pa.int32()), pa.array(head["n_tokens"][lo:].astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["slot", "shard", "record", "byte_offset", "doc_id", "piece", "n_tokens", "ids_crc32"])
    return run


def read_training_order(spark, folder: str, first_slot: int = 0, path: str | None = None, records: int = RECORDS) -> DataFrame:
    """Records from ``first_slot`` on (resume), one row each; earlier shards are not opened."""
    shards = spark.read.schema(SHARD).parquet(folder).filter(F.col("shard") >= first_slot // records)
    return shards.mapInArrow(_records(path or tokenizer_path(), records, first_slot), RECORD)
