"""Operator 8: best-fit packing of documents into fixed-length token sequences.

Bulk-synchronous best-fit decreasing over runs:
    1. Pieces: every document is encoded, closed with an end id and cut into pieces of at
       most ``capacity`` tokens; the narrow piece table is written to the shared folder.
    2. Range sort: pieces are range-partitioned by (length, id, piece). A piece's rank among
       those of its length is its place in its partition plus the counts before it, so no
       task or window holds a whole length, however common.
    3. Supersteps: pieces of one length are interchangeable, as are gaps of one size, so both
       are run tables: (length, first rank, n) and (gap, first sequence, n). Stretches of lengths
       are taken longest first. In a superstep the runs are dealt out by range of size; each
       range's owner sweeps its sizes downwards and gives each run of pieces its successors, the
       least gaps that hold it; what the ranges left over is swept across them; conflicts go to
       the longer piece, then the lower rank. A gap is used once a superstep (with as many pieces
       of that length as fit) and is open again, smaller, in the next; pieces larger than every
       gap open new sequences. Supersteps repeat until the stretch is placed. Each one writes
       its run table to the shared folder, so a lost executor costs at most one superstep.
    4. The placed runs come back to the pieces by (length, rank), giving sequence and offset.

Run tables are bounded by the capacity, not by the documents: at most ``capacity`` lengths, and
gap runs of at most ``capacity`` sizes that a placed run splits in two or three. About 20 to 80
supersteps are made, whatever the input. Counts per (partition, length) and the placed runs reach
the driver.

Defined results: a null text is empty and has the end id alone; repeated rows are packed
each; pieces of equal length are ranked by (doc_id, piece); an empty table gives no rows;
extra columns are ignored; a long document is cut, never truncated.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cohortlens.llm.common import new_table_path, shuffle_partitions, sliced, tokenizer_path, via_table
from cohortlens.llm.wordbpe import word_bpe

CAPACITY = 2048
END_ID = 0
RANGES = 8  # owners of a superstep
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, capacity: int, end_id: int):
    def run(batches):
        enc = word_bpe(path)
        end = np.array([end_id], "<u4")
        for batch in sliced(batches):
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([np.frombuffer(enc.encode(text or b""), enc.dtype).astype("<u4"), end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    rows.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], pa.int32() if c == 1 else pa.int64()) for c in range(5)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_cut(path or tokenizer_path(), capacity, end_id), PIECES)


def ranked_by_length(pieces: DataFrame) -> tuple[DataFrame, dict[tuple[int, int], tuple[int, int]], dict[int, int]]:
    """(table with pid and place, {(pid, length): (first place, pieces of that length before)}, {length: pieces}).

    The dictionaries hold at most partitions + capacity entries.
    """
    n = shuffle_partitions(pieces.sparkSession)
    ordered = (pieces.repartitionByRange(n, "length", "doc_id", "piece")
               .sortWithinPartitions("length", "doc_id", "piece")
               .withColumn("pid", F.spark_partition_id())
               .withColumn("place", F.monotonically_increasing_id() - F.shiftleft(F.col("pid").cast("long"), 33)))
    table = via_table(ordered, "ranked-pieces")
    seen: dict[int, int] = {}
    before = {}
    for r in sorted(table.groupBy("pid", "length").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).collect()):
        before[r.pid, r.length] = (r.first, seen.get(r.length, 0))
        seen[r.length] = seen.get(r.length, 0) + r.n
    return table, before, seen


def stretches(capacity: int) -> list[tuple[int, int]]:
    """Length ranges (low, high], longest first: cuts at capacity / 1 .. 8, fifths of the rest above
    a sixteenth of the capacity, halves below (short pieces fit almost anywhere)."""
    highs, h = {capacity // k for k in range(1, 9)} - {0}, capacity
    while h > 0:
        highs.add(h)
        h = min(h - 1, h * 4 // 5 if 16 * h > capacity else h // 2)
    cuts = sorted(highs, reverse=True) + [0]
    return list(zip(cuts[1:], cuts[:-1]))


# Kinds of run rows. SHRUNK gaps were used in this superstep and rest until the next.
PIECE, GAP, PLACED, SHRUNK, OPENED = range(5)
RUN = ["kind", "size", "first", "n", "sequence", "per", "offset"]
RUNS = "kind int, size long, first long, n long, sequence long, per long, offset long"


def successor_sweep(rows, capacity: int) -> list[tuple]:
    """One sweep over the runs of a range, by size downwards, gaps before pieces of the same size.

    The gaps met so far form a stack whose top is the least gap that is large enough: a run of
    pieces takes gaps from the top, as many pieces a gap as fit, until either is used up. Longer
    pieces (and lower ranks) come first, which settles conflicts. Rows: what was placed, the gaps
    shrunk by it, the gaps not used and the pieces that found none. Sweeping two neighbouring
    ranges and then what both left over is the same as one sweep over both."""
    out, stack = [], []
    for kind, size, first, n in sorted(((r[0], r[1], r[2], r[3]) for r in rows if r[0] in (PIECE, GAP)),
                                       key=lambda r: (-r[1], -r[0], r[2])):
        if kind == GAP:
            stack.append([size, first, n])
            continue
        while n and stack:
            gap, sequence, count = stack[-1]
            per = gap // size
            used = min(count, -(-n // per))
            placed = min(n, used * per)
            out.append((PLACED, size, first, placed, sequence, per, capacity - gap))
            full, rest = divmod(placed, per)
            out.extend((SHRUNK, left, at, m, 0, 0, 0) for left, at, m in
                       ((gap - per * size, sequence, full), (gap - rest * size, sequence + full, min(rest, 1))) if left and m)
            first, n = first + placed, n - placed
            stack[-1][1:] = sequence + used, count - used
            if used == count:
                stack.pop()
        if n:
            out.append((PIECE, size, first, n, 0, 0, 0))
    return out + [(GAP, *g, 0, 0, 0) for g in stack] + [tuple(r) for r in rows if r[0] not in (PIECE, GAP)]


def open_sequences(pieces: list[tuple], opened: int, capacity: int) -> tuple[list[tuple], int]:
    """New sequences for runs of pieces that no gap can hold, longest first: whole sequences of one
    length, and what is left of a run with the runs after it. Rows, and the sequences opened."""
    out, first_new, room = [], opened, 0
    for _, size, first, n, *_ in sorted(pieces, key=lambda r: (-r[1], r[2])):
        part = min(n, room // size)
        if part:  # the sequence begun by longer pieces
            out.append((PLACED, size, first, part, opened - 1, part, capacity - room))
            room, first, n = room - part * size, first + part, n - part
        if not n:
            continue
        if room:
            out.append((GAP, room, opened - 1, 1, 0, 0, 0))
            room = 0
        per = capacity // size
        full, rest = divmod(n, per)
        out.append((PLACED, size, first, n, opened, per, 0))
        if full and capacity - per * size:
            out.append((GAP, capacity - per * size, opened, full, 0, 0, 0))
        opened += full + min(rest, 1)
        room = capacity - rest * size if rest else 0
    if room:
        out.append((GAP, room, opened - 1, 1, 0, 0, 0))
    return out, opened - first_new


def joined_gaps(gaps: list[tuple]) -> list[tuple]:
    """Gap runs of one size whose sequences follow each other as one run."""
    out: list[list] = []
    for _, size, first, n, *_ in sorted(gaps, key=lambda r: (r[1], r[2])):
        if out and out[-1][0] == size and out[-1][1] + out[-1][2] == first:
            out[-1][2] += n
        else:
            out.append([size, first, n])
    return [(GAP, *g, 0, 0, 0) for g in out]


def settle(rows, capacity: int, opened: int) -> list[tuple]:
    """The end of a superstep: what the ranges left over is swept, shrunk gaps open again, and pieces
    larger than every gap open new sequences."""
    rows = successor_sweep(rows, capacity)
    gaps = [r for r in rows if r[0] in (GAP, SHRUNK)]
    largest = max((r[1] for r in gaps), default=0)
    pieces = [r for r in rows if r[0] == PIECE]
    new, count = open_sequences([r for r in pieces if r[1] > largest], opened, capacity)
    return ([r for r in rows + new if r[0] == PLACED] + joined_gaps(gaps + [r for r in new if r[0] == GAP])
            + [r for r in pieces if r[1] <= largest] + [(OPENED, 0, 0, count, 0, 0, 0)])


def _on_runs(step):
    def run(pdf):
        return pd.DataFrame(step(list(pdf[RUN].itertuples(index=False, name=None))), columns=RUN)
    return run


def superstep(runs: DataFrame, low: int, opened: int, capacity: int, ranges: int = RANGES) -> DataFrame:
    """One superstep over the runs of gaps and of the stretch's pieces: every range of sizes is swept
    by its owner, then what the ranges left over is matched across them."""
    width = max(1, -(-(capacity - low) // ranges))
    owner = F.greatest(F.lit(0), F.floor((F.lit(capacity) - F.col("size")) / width)).cast("int")
    swept = runs.groupBy(owner.alias("owner")).applyInPandas(_on_runs(lambda r: successor_sweep(r, capacity)), RUNS)
    return swept.groupBy(F.lit(0).alias("all")).applyInPandas(_on_runs(lambda r: settle(r, capacity, opened)), RUNS)


def matched_runs(lengths: DataFrame, counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, sequence, pieces per sequence, offset) and the number of sequences.

    ``lengths`` has a row (length, n) for every length; ``counts`` is the same on the driver and
    only tells which stretches are empty."""
    spark = lengths.sparkSession
    zero = F.lit(0).cast("long")
    pieces = lengths.select(F.lit(PIECE).alias("kind"), F.col("length").alias("size"), zero.alias("first"), "n",
                            *[zero.alias(c) for c in RUN[4:]])
    state, paths, opened = None, [], 0
    for low, high in stretches(capacity):
        if not any(low < x <= high for x in counts):
            continue
        due = pieces.where((F.col("size") > low) & (F.col("size") <= high))
        runs = due if state is None else due.unionByName(state.where(F.col("kind") == GAP))
        left = 1
        while left:
            seen = Observation()
            paths.append(new_table_path(spark, "packing-superstep"))
            superstep(runs, low, opened, capacity).observe(
                seen, F.sum(F.when(F.col("kind") == PIECE, F.col("n"))).alias("left"),
                F.sum(F.when(F.col("kind") == OPENED, F.col("n"))).alias("opened")).write.parquet(paths[-1])
            left, opened = seen.get["left"] or 0, opened + (seen.get["opened"] or 0)
            state = spark.read.schema(RUNS).parquet(paths[-1])
            runs = state.where(F.col("kind").isin(PIECE, GAP))
    if not paths:
        return np.zeros((0, 5), np.int64), 0
    placed = spark.read.schema(RUNS).parquet(*paths).where(F.col("kind") == PLACED)
    table = placed.select("size", "first", "sequence", "per", "offset").toPandas()
    return table.to_numpy(dtype=np.int64).reshape(-1, 5), opened


def _place(runs: np.ndarray, before: dict):
    def run(batches):
        table, first_of = runs.value, before.value
        keys = (table[:, 0] << 40) + table[:, 1]
        at = np.argsort(keys, kind="stable")
        table, keys = table[at], keys[at]
        for batch in batches:
            c = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            length = c["length"].to_numpy(zero_copy_only=False)
            base = np.array([first_of[k] for k in zip(c["pid"].to_pylist(), c["length"].to_pylist())], np.int64).reshape(-1, 2)
            rank = c["place"].to_numpy(zero_copy_only=False) - base[:, 0] + base[:, 1]
            r = table[np.searchsorted(keys, (length << 40) + rank, side="right") - 1]
            nth, slot = np.divmod(rank - r[:, 1], r[:, 3])
            yield pa.RecordBatch.from_arrays(
                [c[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(r[:, 2] + nth, pa.int64()), pa.array(r[:, 4] + slot * length, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    sc = docs.sparkSession.sparkContext
    pieces = via_table(token_pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    table, before, counts = ranked_by_length(pieces)
    runs, _ = matched_runs(table.groupBy("length").agg(F.count(F.lit(1)).alias("n")), counts, capacity)
    return table.mapInArrow(_place(sc.broadcast(runs), sc.broadcast(before)),
                            PIECES + ", sequence_id long, offset long")
