"""Operator 12: byte-level BPE as a monoid tree reduction.

A node is a span of a text with the ids the span has when it stands alone. Two neighbours join
to the node of the joined span, so encoding is a homomorphism onto a monoid and any tree over a
text's spans gives the same ids:

    encode   A span is halved down to leaves of ``LEAF`` characters. A join keeps the ids left of
             the last sync point of the left node and right of the first sync point of the right
             node; the text between, the boundary window, is encoded anew. A sync point is a place
             where the pattern always cuts, whatever surrounds it (SYNC), and whose cuts to the
             left look no further, so the ids outside the window are those of the whole. A node
             without a sync point lets the window grow to its edge.
    runs     Where a long window is a single run of letters (one match of the pattern), the window
             grows in tokens instead, doubling, until each edge pair of tokens, kept and new, is
             what its own bytes encode to. Merges go by rank and never depend on tokens beyond
             such a pair, so everything outside is final.
    decode   The bytes of an id list are those of its halves, concatenated up the same tree.
    Spark    Texts of at most ``CHUNK`` characters are one subtree inside a task. Longer ones are
             cut into chunk rows, encoded in parallel and joined level by level, ``FAN``
             neighbours a task at a time; the number of levels is the logarithm of the longest
             text. The chunk table is written once, so a lost executor costs its tasks only.

A task holds the texts of one slice, or ``FAN`` neighbouring nodes of one text.

Defined results: a null text is empty and has no ids and an empty decoded text; repeated rows
(and ids) are rows each; an empty table gives no rows; extra columns are ignored; a text of any
length is encoded whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import uuid
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import sliced, tokenizer_path, via_table

MULTI = "byte_bpe_multi_50k.tiktoken"
LEAF = 1024          # characters of a leaf
CHUNK = 1 << 16      # characters that one task encodes as one subtree
FAN = 8              # neighbours joined by one task on a level above the chunks

# Letters whose class no Unicode version changes; other letters only end a window at white space.
_LETTERS = "A-Za-zà-öø-ÿа-яА-Я一-龥ぁ-ゖァ-ヺ가-힣"
_SIGNS = r"!-&(-/:-@\[-`{-~、。，"   # the apostrophe may join what follows it
#: Places at which every segmentation cuts: a visible character before white space, and changes
#: between letters, digits and signs.
SYNC = (rf"(?<=[\p{{L}}\p{{M}}\p{{N}}\p{{P}}\p{{S}}])(?=[ \t\n\r])|(?<=[{_LETTERS}])(?=[0-9'{_SIGNS}])"
        rf"|(?<=[0-9])(?=[{_LETTERS}'{_SIGNS}])|(?<=[{_SIGNS}])(?=[{_LETTERS}0-9])")


@dataclass
class Node:
    """text[lo:hi] encoded alone; its first and last sync points (text offsets), if any."""

    lo: int
    hi: int
    ids: array
    first: int | None
    last: int | None


class ByteBpe:
    def __init__(self, path: str, leaf: int = LEAF):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.leaf = leaf
        enc = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain, self._piece = enc.encode_ordinary, enc._core_bpe.encode_single_piece
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.pieces[i] = raw
        self._next_sync = regex.compile(SYNC).search
        self._last_sync = regex.compile(f"(?r)(?:{SYNC})").search
        self._letters = regex.compile(f" ?[{_LETTERS}]+").fullmatch

    # -------------------------------------------------------------- sync points
    def _syncs(self, text: str, lo: int, hi: int) -> tuple[int | None, int | None]:
        """First and last sync points strictly inside text[lo:hi], seen from inside alone."""
        span = text if (lo, hi) == (0, len(text)) else text[lo:hi]
        got = self._next_sync(span)
        return (None, None) if got is None else (lo + got.start(), lo + self._last_sync(span).start())

    # -------------------------------------------------------------- joins
    def _tail(self, ids: array, size: int) -> int:
        """Index of the token that starts ``size`` bytes before the end."""
        k = len(ids)
        while size > 0:
            k -= 1
            size -= len(self.pieces[ids[k]])
        return k

    def _head(self, ids: array, size: int) -> int:
        """Number of tokens in the first ``size`` bytes."""
        k = 0
        while size > 0:
            size -= len(self.pieces[ids[k]])
            k += 1
        return k

    def _settled(self, left: int, right: int) -> bool:
        return self._piece(self.pieces[left] + self.pieces[right]) == [left, right]

    def _join_run(self, a: array, b: array) -> array:
        """Ids of one match from those of its two parts: token windows that double until stable."""
        k = 1
        while True:
            left, right = max(0, len(a) - k), min(k, len(b))
            window = self._piece(self.decode(a[left:]) + self.decode(b[:right]))
            if ((left == 0 or self._settled(a[left - 1], window[0]))
                    and (right == len(b) or self._settled(window[-1], b[right]))):
                return a[:left] + array("I", window) + b[right:]
            k *= 2

    def join(self, text: str, a: Node, b: Node, base: int = 0) -> Node:
        """Node of two neighbours; ``text`` starts at offset ``base``."""
        if a.lo == a.hi or b.lo == b.hi:
            return b if a.lo == a.hi else a
        m = a.hi
        p, q = a.lo if a.last is None else a.last, b.hi if b.first is None else b.first
        at = self._next_sync(text[m - 1 - base:m + 1 - base])
        if at is not None and at.start() == 1:
            ids, here = a.ids + b.ids, m
        else:
            window, here = text[p - base:q - base], None
            keep_a = self._tail(a.ids, len(window[:m - p].encode()))
            keep_b = self._head(b.ids, len(window[m - p:].encode()))
            if len(window) > 2 * self.leaf and self._letters(window):
                middle = self._join_run(a.ids[keep_a:], b.ids[:keep_b])
            else:
                middle = array("I", self.plain(window))
            ids = a.ids[:keep_a] + middle + b.ids[keep_b:]
        known = [s for s in (a.first, a.last, here, b.first, b.last) if s is not None]
        return Node(a.lo, b.hi, ids, known[0] if known else None, known[-1] if known else None)

    # -------------------------------------------------------------- trees
    def node(self, text: str, lo: int, hi: int, base: int = 0) -> Node:
        """Encode text[lo:hi] by halves (offsets count from ``base``)."""
        if hi - lo <= self.leaf:
            span = text[lo - base:hi - base]
            first, last = self._syncs(span, 0, len(span))
            return Node(lo, hi, array("I", self.plain(span)), None if first is None else lo + first, None if last is None else lo + last)
        mid = (lo + hi) // 2
        return self.join(text, self.node(text, lo, mid, base), self.node(text, mid, hi, base), base)

    def encode(self, text: str) -> array:
        if len(text) <= self.leaf:
            return array("I", self.plain(text))
        return self.node(text, 0, len(text)).ids

    def decode(self, ids) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.pieces.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])

    def digests(self, ids: array) -> tuple[int, str, str]:
        """n_tokens, SHA-256 of the ids as little-endian 32-bit integers, SHA-256 of the decoded bytes."""
        raw = np.asarray(ids, "<u4").tobytes()
        return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """The worker's encoder; a reused worker keeps it between tasks."""
    return ByteBpe(path)


# ------------------------------------------------------------------ Spark
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
CHUNKS = "text_key string, doc_id long, node long, nodes long, text string"
NODES = "text_key string, doc_id long, node long, nodes long, text string, ids binary, first_sync long, last_sync long"


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def _digest_rows(ids: list, nodes: list, bpe: ByteBpe) -> pa.RecordBatch:
    rows = [bpe.digests(n) for n in nodes]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
         pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _encode_whole(path: str):
    def run(batches):
        bpe = byte_bpe(path)
        for part in sliced(batches):
            yield _digest_rows(part.column(0).to_pylist(), [bpe.encode(_text(t)) for t in part.column(1).to_pylist()], bpe)
    return run


def _cut(chunk: int):
    """A long text -> its chunks in order, under a key of its own (made once: the table is written)."""
    def run(batches):
        for batch in batches:
            for i, raw in zip(*(batch.column(k) for k in range(2))):
                text, key = _text(raw.as_py()), uuid.uuid4().hex
                starts = range(0, len(text), chunk)
                for k, at in enumerate(starts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([i.as_py()], pa.int64()), pa.array([k], pa.int64()),
                         pa.array([len(starts)], pa.int64()), pa.array([text[at:at + chunk]])],
                        names=["text_key", "doc_id", "node", "nodes", "text"])
    return run


def _node_row(key, doc_id, k, n, text: str, node: Node) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key]), pa.array([doc_id], pa.int64()), pa.array([k], pa.int64()), pa.array([n], pa.int64()), pa.array([text]),
         pa.array([node.ids.tobytes()], pa.binary()), pa.array([node.first], pa.int64()), pa.array([node.last], pa.int64())],
        names=["text_key", "doc_id", "node", "nodes", "text", "ids", "first_sync", "last_sync"])


def _encode_chunks(path: str):
    def run(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            for key, doc_id, k, n, text in zip(*(batch.column(c) for c in range(5))):
                text = text.as_py()
                yield _node_row(key.as_py(), doc_id.as_py(), k.as_py(), n.as_py(), text, bpe.node(text, 0, len(text)))
    return run


def _join_level(path: str, fan: int):
    """Sorted node rows -> one row for each ``fan`` neighbours of a text."""
    def run(batches):
        bpe = byte_bpe(path)
        parent, texts, nodes = None, [], []

        def joined():
            whole = "".join(texts)
            while len(nodes) > 1:  # neighbours pair by pair
                pairs = [nodes[k:k + 2] for k in range(0, len(nodes), 2)]
                nodes[:] = [p[0] if len(p) == 1 else bpe.join(whole, *p) for p in pairs]
            key, doc_id, k, n = parent
            return _node_row(key, doc_id, k, n, whole, nodes[0])
        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(8))):
                key, doc_id, k, n, text, raw, first, last = (x.as_py() for x in row)
                mine = (key, doc_id, k // fan, -(-n // fan))
                if parent not in (None, mine):
                    yield joined()
                    texts, nodes = [], []
                parent = mine
                at = sum(map(len, texts))
                ids = array("I")
                ids.frombytes(raw)
                nodes.append(Node(at, at + len(text), ids, None if first is None else at + first, None if last is None else at + last))
                texts.append(text)
        if nodes:
            yield joined()
    return run


def _digest_nodes(path: str):
    def run(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            for doc_id, raw in zip(batch.column(0), batch.column(1)):
                ids = array("I")
                ids.frombytes(raw.as_py())
                yield _digest_rows([doc_id.as_py()], [ids], bpe)
    return run


def encode_decode(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, fan: int = FAN,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = path or tokenizer_path(MULTI)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = F.coalesce(F.char_length("text"), F.lit(0))
    raw = F.col("text").cast("binary").alias("text")
    out = rows.filter(size <= chunk).select("doc_id", raw).mapInArrow(_encode_whole(path), DIGESTS)
    longest = rows.agg(F.max(size)).first()[0] or 0
    if longest <= chunk:
        return out
    chunks = via_table(rows.filter(size > chunk).select("doc_id", raw).mapInArrow(_cut(chunk), CHUNKS), "bpe-chunks")
    nodes = chunks.repartition("text_key", "node").mapInArrow(_encode_chunks(path), NODES)
    width = -(-longest // chunk)
    while width > 1:
        parent = F.floor(F.col("node") / fan)
        nodes = (nodes.repartition(F.col("text_key"), parent).sortWithinPartitions("text_key", "node")
                 .mapInArrow(_join_level(path, fan), NODES))
        width = -(-width // fan)
    return out.unionByName(nodes.select("doc_id", "ids").mapInArrow(_digest_nodes(path), DIGESTS))
