"""Operator 11: cross-tokenizer alignment by pointer jumping, with corpus-wide link counts.

    Tokens   Each text is encoded by two tokenizers, A and B, and every token gets its byte range in
             space + text. Where the joined bytes of either differ from space + text (characters that
             a tokenizer rewrites), the document has no tokens.
    Jumping  Tokens of A and B that overlap form chains. Every token points to the overlapping token
             that ends farthest to the right (at equal ends to the B token; one without a farther
             partner to itself). Doubling the successors, ``to = to[to]`` over all tokens of a slice of
             documents at once, ends when nothing changes, after the logarithm of the longest chain;
             each token then holds its group's terminal token, which labels the group.
    Links    All pairs of an A and a B token of one group. A group's ids are folded to distinct ids with
             their multiplicities first, so a long group of few ids stays small.
    Counts   Documents are kept in blocks of about ``BLOCK_LINKS`` distinct links, one row a block in a
             table in the shared folder. A block names each of its id pairs once, with the number of
             its documents; these rows, not the documents', go through the aggregate by pair (map-side
             combined), the highest count by A id, and back to the block, whose documents then look
             their links up. A pair that every document holds is one row a block.

Defined results: texts that are null, empty or changed by a tokenizer have zeros and an empty
``groups_sha256``; repeated rows (and ids, and null ids) are documents each; an empty table gives no
rows; extra columns are ignored. A text of any length is one document, encoded whole.
"""

from __future__ import annotations

import functools
import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.byte_bpe import ByteBpe
from cohortlens.llm.common import sliced, tokenizer_path, via_table

BYTES, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"   # the ranks are byte_bpe_50k.json's vocabulary
BLOCK_LINKS = 200_000
FOLD = 64            # groups of more links than this are folded to distinct ids first

RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
BLOCKS = ("block string, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "shas array<string>, sizes array<long>, pairs binary, times binary")


class Pair:
    """The two tokenizers of a worker: ids of a text and the bytes of every id."""

    def __init__(self, bytes_path: str, pieces_path: str):
        import sentencepiece

        self.a = ByteBpe(bytes_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.bytes_a = self.a.pieces
        self.bytes_b = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.text_a = np.array([str(k) for k in range(len(self.bytes_a))], object)
        self.text_b = np.array([str(k) for k in range(len(self.bytes_b))], object)

    def _piece(self, k: int) -> bytes:
        s = self.b.id_to_piece(k)
        return bytes([int(s[3:5], 16)]) if self.b.is_byte(k) else s.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple]:
        """(ids of A, ids of B) of each text; both empty where a tokenizer changes the text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            # A's ids are merges of the text's own bytes: only B can change a text
            same = text and b"".join(map(self.bytes_b.__getitem__, b)) == b" " + text.encode()
            out.append((self.a.plain(" " + text), b) if same else ((), ()))
        return out


@functools.lru_cache(maxsize=2)
def tokenizer_pair(bytes_path: str, pieces_path: str) -> Pair:
    return Pair(bytes_path, pieces_path)


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terminal B token of every A and of every B token, by pointer jumping.

    ``end_a`` and ``end_b`` are the ascending ends of tokens that tile the same bytes."""
    n = len(end_a)
    over_a = np.searchsorted(end_b, end_a)          # the B token that holds an A token's last byte
    over_b = np.searchsorted(end_a, end_b)
    far_b = end_a[over_b] > end_b if n else np.zeros(0, bool)
    to = np.concatenate([n + over_a, np.where(far_b, over_b, n + np.arange(len(end_b)))])
    while True:
        onward = to[to]
        if np.array_equal(onward, to):
            return to[:n] - n, to[n:] - n
        to = onward


def _fold(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(ids, return_counts=True)


def _distinct(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their times."""
    at = np.argsort(keys, kind="stable")
    keys, times = keys[at], times[at]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(times, new) if len(new) else times


def align(pair: Pair, texts: list[str]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs, times) of each text.

    A pair is a * (ids of B) + b; ``times`` counts its occurrences in the text."""
    coded = pair.encode(texts)
    na, nb = (np.array([len(c[k]) for c in coded], np.int64) for k in (0, 1))
    a = np.concatenate([np.asarray(c[0], np.int64) for c in coded] or [np.zeros(0, np.int64)])
    b = np.concatenate([np.asarray(c[1], np.int64) for c in coded] or [np.zeros(0, np.int64)])
    if not len(a):
        return [(0, 0, 0, 0, "", a, a)] * len(texts)
    # one text after another: both tile the same bytes, so a group never crosses texts
    last_a, last_b = terminals(np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[b]))
    label, group_b = np.unique(last_b, return_inverse=True)
    group_a = np.searchsorted(label, last_a)
    ga, gb = np.bincount(group_a, minlength=len(label)), np.bincount(group_b, minlength=len(label))
    doc = np.repeat(np.arange(len(texts)), nb)[label]                    # document of a group
    n_groups = np.bincount(doc, minlength=len(texts))
    n_links = np.bincount(doc, weights=(ga * gb).astype(float), minlength=len(texts)).astype(np.int64)

    # text of the groups: the tokens of A, then of B, of each group in turn
    first_a, first_b = np.cumsum(ga) - ga, np.cumsum(gb) - gb
    words = np.empty(2 * (len(a) + len(b)), object)
    at_a = 2 * (np.arange(len(a)) + first_b[group_a])
    at_b = 2 * (np.arange(len(b)) + (first_a + ga)[group_b])
    words[at_a], words[at_b] = pair.text_a[a], pair.text_b[b]
    words[at_a + 1] = words[at_b + 1] = ","
    words[at_a[first_a + ga - 1] + 1] = "|"
    words[at_b[first_b + gb - 1] + 1] = ";"
    stops = np.concatenate([[0], np.cumsum(2 * (na + nb))])

    size_b = len(pair.bytes_b)
    plain = ga * gb <= FOLD
    keys, times = [], []
    many = np.where(plain, gb, 0)[group_a]                               # partners of each A token
    of = np.repeat(np.arange(len(a)), many)
    partner = first_b[group_a[of]] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    docs = [doc[group_a[of]]]
    keys.append(a[of] * size_b + b[partner])
    times.append(np.ones(len(of), np.int64))
    for g in np.flatnonzero(~plain):
        ua, ca = _fold(a[first_a[g]:first_a[g] + ga[g]])
        ub, cb = _fold(b[first_b[g]:first_b[g] + gb[g]])
        keys.append((ua[:, None] * size_b + ub).ravel())
        times.append((ca[:, None] * cb).ravel())
        docs.append(np.full(len(keys[-1]), doc[g]))
    wide = len(pair.bytes_a) * size_b
    docs = np.concatenate(docs)
    if wide * len(texts) < 1 << 62:
        pairs, times = _distinct(docs * wide + np.concatenate(keys), np.concatenate(times))
        docs, pairs = np.divmod(pairs, wide)
    else:                                                                # huge vocabularies: one document at a time
        parts = [_distinct(np.concatenate(keys)[docs == d], np.concatenate(times)[docs == d]) for d in range(len(texts))]
        docs = np.repeat(np.arange(len(texts)), [len(p[0]) for p in parts])
        pairs, times = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    cut = np.searchsorted(docs, np.arange(len(texts) + 1))
    out = []
    for d in range(len(texts)):
        sha = hashlib.sha256("".join(words[stops[d]:stops[d + 1] - 1]).encode()).hexdigest() if na[d] else ""
        own = slice(cut[d], cut[d + 1])
        out.append((int(na[d]), int(nb[d]), int(n_groups[d]), int(n_links[d]), sha, pairs[own], times[own]))
    return out


# ------------------------------------------------------------------ Spark
def _pack(values: list[np.ndarray]) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(np.concatenate(values).astype("<u4" if max(v.max(initial=0) for v in values) < 1 << 32 else "<u8").tobytes())


def _unpack(raw: bytes, size: int) -> np.ndarray:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(raw)
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * size else "<u8").astype(np.int64)


def _align_blocks(bytes_path: str, pieces_path: str, block_links: int):
    """(doc_id, text) -> one row a block of documents."""
    def run(batches):
        pair = tokenizer_pair(bytes_path, pieces_path)
        ids, rows, held = [], [], 0

        def flush():
            pairs, times = [r[5] for r in rows], [r[6] for r in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(pa.int64()))]
                + [pa.array([[r[k] for r in rows]], pa.list_(pa.int64())) for k in range(4)]
                + [pa.array([[r[4] for r in rows]], pa.list_(pa.string())), pa.array([[len(p) for p in pairs]], pa.list_(pa.int64())),
                   pa.array([_pack(pairs)], pa.binary()), pa.array([_pack(times)], pa.binary())],
                names=[c.split()[0] for c in BLOCKS.split(", ")])
        for part in sliced(batches):
            got = align(pair, [(t or b"").decode("utf-8", "replace") for t in part.column(1).to_pylist()])
            for i, row in zip(part.column(0).to_pylist(), got):
                ids.append(i)
                rows.append(row)
                held += len(row[5]) + 16
                if held >= block_links:
                    yield flush()
                    ids, rows, held = [], [], 0
        if ids:
            yield flush()
    return run


def _block_pairs(size_b: int):
    """A block's distinct id pairs and in how many of its documents each is linked."""
    def run(batches):
        for batch in batches:
            for block, sizes, raw in zip(*(batch.column(k) for k in range(3))):
                pairs, n = _fold(_unpack(raw.as_py(), sum(sizes.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()] * len(pairs), pa.string()), pa.array(pairs // size_b), pa.array(pairs % size_b), pa.array(n, pa.int64())],
                    names=["block", "a", "b", "n"])
    return run


def _look_up(size_b: int):
    """A block and its pairs' counts -> its documents."""
    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        keys = right.column("a").to_numpy() * size_b + right.column("b").to_numpy()
        at = np.argsort(keys)
        keys, count, best = keys[at], right.column("count").to_numpy()[at], right.column("best").to_numpy()[at]
        out = []
        for row in left.to_pylist():
            sizes = row["sizes"]
            where = np.searchsorted(keys, _unpack(row["pairs"], sum(sizes)))
            times = _unpack(row["times"], sum(sizes))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            total, top = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(total, doc, times * count[where])
            np.add.at(top, doc, times * (count[where] == best[where]))
            own = [row[c] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
            out.append(pa.table([pa.array(x, pa.int64()) for x in (*own, top, total)] + [pa.array(row["shas"], pa.string())],
                                names=[c.split()[0] for c in RESULT.split(", ")]))
        return pa.concat_tables(out) if out else pa.schema(
            [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RESULT.split(", ")]).empty_table()
    return run


def align_corpus(docs: DataFrame, bytes_path: str | None = None, pieces_path: str | None = None,
                 block_links: int = BLOCK_LINKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: numbers of tokens, groups, links, best links, their counts, groups' digest."""
    import sentencepiece

    bytes_path, pieces_path = bytes_path or tokenizer_path(BYTES), pieces_path or tokenizer_path(PIECES)
    size_b = sentencepiece.SentencePieceProcessor(model_file=pieces_path).get_piece_size()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    blocks = via_table(rows.mapInArrow(_align_blocks(bytes_path, pieces_path, block_links), BLOCKS), "aligned-blocks")
    named = via_table(blocks.select("block", "sizes", "pairs").mapInArrow(_block_pairs(size_b), "block string, a long, b long, n long"), "block-pairs")
    counts = (named.groupBy("a", "b").agg(F.sum("n").alias("count"))
              .withColumn("best", F.max("count").over(Window.partitionBy("a"))))  # at most the ids of B in a window
    answers = named.join(counts, ["a", "b"]).select("block", "a", "b", "count", "best")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_look_up(size_b), RESULT)
