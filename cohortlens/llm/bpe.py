"""Operator 3: BPE encoding and decoding through a distinct-word table.

Plan
    1. split: every block of documents (a run of rows of one file, or a hash bucket)
       yields its distinct words, sorted, one row per (block, word range ``bin``).
    2. encode once: rows are dealt out by ``bin``; a task sees every block's share of
       its words, encodes each distinct word once and answers every block with the ids
       in the order (position) the block listed its words.
    3. documents and answers are dealt out by block; a block's answers come first in
       sort order, so a task holds one block's words and streams its documents past them.
    4. decode: the ids of each listed word are joined to the id-to-piece table, whose
       size is the vocabulary's; a document's text is its words' pieces in order.

No text is cut and no word is dropped; memory is bounded by the distinct words of one
block or bin. A word that every block holds costs one row entry per block, not per use.

Defined results: null text = empty text = no ids, empty decoded text; repeated rows give
repeated results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import shuffle_partitions, sliced, tokenizer_path
from cohortlens.llm.wordbpe import word_bpe

BLOCK_ROWS = 8_192   # rows of a file that share a word list
COMPRESS_BYTES = 1 << 20


def file_block(rows: int = BLOCK_ROWS) -> Column:
    """Block of a row read from files: (file, run of rows)."""
    return F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / rows))


def hash_block(id_col: str, blocks: int) -> Column:
    """Block of a row of any frame."""
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(blocks)).cast("long")


def _split_words(bins: int, max_words: int = 1_000_000):
    """(block, text) -> (bin, block, words): distinct words of the block in this task."""
    def flush(block, words):
        lists: dict[int, list[bytes]] = {}
        for w in sorted(words):
            lists.setdefault(zlib.crc32(w) % bins, []).append(w)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(lists), pa.int32()), pa.array([block] * len(lists), pa.int64()),
             pa.array([b"\n".join(v) for v in lists.values()], pa.binary())],
            names=["bin", "block", "words"])

    def run(batches):
        block, seen = None, set()
        for batch in sliced(batches):
            for b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if seen and (b != block or len(seen) >= max_words):
                    yield flush(block, seen)
                    seen = set()
                block = b
                if text:
                    seen.update(text.split())
        if seen:
            yield flush(block, seen)
    return run


def _encode_bins(path: str):
    """(bin, block, words) -> (block, words, counts, ids): each distinct word encoded once."""
    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=6).compress
        enc = word_bpe(path)
        table: dict[bytes, bytes] = {}
        current, width = None, enc.dtype.itemsize
        for batch in sliced(batches, 2):
            out = []
            for b, block, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if b != current:
                    table, current = {}, b
                ids = []
                for w in words.split(b"\n"):
                    got = table.get(w)
                    if got is None:
                        got = table[w] = enc.encode_word(w)
                    ids.append(got)
                counts = np.fromiter(map(len, ids), dtype="<i4", count=len(ids)) // width
                out.append((block, pack(words), pack(counts.tobytes()), pack(b"".join(ids))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64())] + [pa.array([r[i] for r in out], pa.binary()) for i in (1, 2, 3)],
                names=["block", "words", "counts", "ids"])
    return run


def _pack_texts():
    """(block, doc_id, text) -> (block, ids, lengths, zstd of the texts), about 1 MB of text a row."""
    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=6).compress
        block, ids, texts, size = None, [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([pack(b"".join(texts))], pa.binary())],
                names=["block", "doc_ids", "lengths", "texts"])
        for batch in sliced(batches, 2):
            for b, i, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if ids and (b != block or size >= COMPRESS_BYTES):
                    yield flush()
                    ids, texts, size = [], [], 0
                block = b
                ids.append(i)
                texts.append(text or b"")
                size += len(texts[-1])
        if ids:
            yield flush()
    return run


def _digest(path: str):
    """A block's word lists, then its documents: ids and decoded text of each document."""
    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        enc = word_bpe(path)
        width, block, table = enc.dtype.itemsize, None, {}
        for batch in batches:
            out = []
            cols = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for b, _, words, counts, ids, doc_ids, lengths, texts in zip(*cols):
                if b != block:
                    block, table = b, {}
                if words is not None:
                    words, counts, ids = unpack(words), unpack(counts), unpack(ids)
                    stops, lo = np.cumsum(np.frombuffer(counts, "<i4")).tolist(), 0
                    pieces = [enc.pieces[i] for i in np.frombuffer(ids, enc.dtype).tolist()]
                    for w, hi in zip(words.split(b"\n"), stops):
                        table[w] = (ids[lo * width:hi * width], b" ".join(pieces[lo:hi]))
                        lo = hi
                    continue
                raw, at = unpack(texts) if texts else b"", 0
                for i, n in zip(doc_ids, lengths):
                    got = [table[w] for w in raw[at:at + n].split()]
                    at += n
                    code = np.frombuffer(b"".join([g[0] for g in got]), enc.dtype)
                    text = b" ".join([g[1] for g in got if g[1]])
                    out.append((i, len(code), hashlib.sha256(code.astype("<u4").tobytes()).hexdigest(),
                                hashlib.sha256(text).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                     pa.array([r[2] for r in out], pa.string()), pa.array([r[3] for r in out], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


ANSWER = "block long, kind int, words binary, counts binary, ids binary, doc_ids array<long>, lengths array<long>, texts binary"


def encode_decode(docs: DataFrame, block: Column | None = None, path: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ids and decoded text per document (see the module's plan).

    ``block`` groups rows that lie together, so that they share a word list; by default
    rows are grouped by a hash of their id.
    """
    path = path or tokenizer_path()
    parts = shuffle_partitions(docs.sparkSession)
    block = hash_block(id_col, parts) if block is None else block
    rows = docs.select(block.cast("long").alias("block"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("binary").alias("text"))
    listed = rows.select("block", "text").mapInArrow(
        _split_words(4 * parts), "bin int, block long, words binary")
    answers = (listed.repartition("bin").sortWithinPartitions("bin")
               .mapInArrow(_encode_bins(path), "block long, words binary, counts binary, ids binary"))
    packed = rows.mapInArrow(_pack_texts(), "block long, doc_ids array<long>, lengths array<long>, texts binary")
    none = {c: F.lit(None) for c in ("words", "counts", "ids")}
    both = (answers.withColumns({"kind": F.lit(0), "doc_ids": F.lit(None).cast("array<long>"),
                                 "lengths": F.lit(None).cast("array<long>"), "texts": F.lit(None).cast("binary")})
            .unionByName(packed.withColumns({"kind": F.lit(1)} | {k: v.cast("binary") for k, v in none.items()})))
    cols = [c.split()[0] for c in ANSWER.split(", ")]
    return (both.select(*cols).repartition("block").sortWithinPartitions("block", "kind")
            .mapInArrow(_digest(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
