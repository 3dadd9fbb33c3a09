"""Word-end BPE for one worker: distinct words are merged once and remembered.

White space always separates tokens in these vocabularies, so a text's ids are the
ids of its white-space-separated words in order. A word is lower-cased and cut into
pre-tokens by the tokenizer's own pattern; the merges of a pre-token run in tiktoken,
whose merge loop takes byte ranks. The last byte carries the word-end mark: ASCII
pre-tokens have its high bit set (ASCII pieces only ever join to ASCII pieces); in all
others every byte is written as a pair (0, byte), or (1, byte) for the last. Both loops
join the lowest-ranked neighbours first, and every vocabulary entry is reachable from its
own bytes (tested), so the ids equal those of the tokenizers library. Words that hold a
special token, a byte 0 or 1, or characters outside the assigned basic plane (whose
classes may differ between Unicode tables) go to the library itself.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# FIXED VALUES: the pre-tokenizer pattern of the vocabulary file
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

MAX_WORDS = 200_000      # words met by a worker before those not met since the last time are forgotten
MAX_PRETOKENS = 200_000


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in of each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


UNASSIGNED = frozenset(chr(c) for c in range(1 << 16) if unicodedata.category(chr(c)) in ("Cn", "Cs", "Co"))
# words that may need the library; all others are lower-cased together
ODD = re.compile("[\0\1" + "".join(map(re.escape, sorted(UNASSIGNED))) + "\U00010000-\U0010ffff]|<\\|")


MARKED = [bytes([b | 0x80]) for b in range(128)]


class _Words(dict):
    """word (bytes) or pre-token (str) -> its ids as little-endian bytes. Those met lately and those of
    one generation before are remembered, so words in use outlive the rare ones between them."""

    def __init__(self, encode: Callable):
        super().__init__()
        self._encode, self._older = encode, {}

    def __missing__(self, word) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._encode(word)
        self[word] = ids
        return ids

    def age(self) -> None:
        """A new generation: what was not met since the last one is forgotten."""
        self._older = dict(self)
        self.clear()


class WordBpe:
    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"]
        self.specials = [t["content"].encode() for t in spec["added_tokens"]]
        special_names = {t["content"] for t in spec["added_tokens"]}
        alphabet = _byte_alphabet()
        # single bytes are never whole tokens here: they rank after every merge
        ranks = {bytes([b]): len(vocab) + b for b in range(256)}
        ascii_ranks = {}
        for piece, i in vocab.items():
            if piece in special_names:
                continue
            end = piece.endswith(suffix)
            raw = bytes(alphabet[c] for c in (piece[: -len(suffix)] if end else piece))
            ranks[self._paired(raw, end)] = i
            if raw.isascii():
                ascii_ranks[self._marked(raw) if end else raw] = i
        self._merge, self._merge_ascii = (
            tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=r, special_tokens={})._core_bpe.encode_single_piece
            for r in (ranks, ascii_ranks))
        self._pretokens = regex.compile(PRETOKEN).findall
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.pieces = [self.library.id_to_token(i).encode() for i in range(self.size)]
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self.words = _Words(self.encode_word)
        self._pieces = _Words(self._pretoken)

    @staticmethod
    def _paired(raw: bytes, end: bool = True) -> bytes:
        out = bytearray(2 * len(raw))
        out[1::2] = raw
        if end:
            out[-2] = 1
        return bytes(out)

    @staticmethod
    def _marked(raw: bytes) -> bytes:
        return raw[:-1] + MARKED[raw[-1]]

    def _ids(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}{self._code}", *ids)

    def _pretoken(self, p: str) -> bytes:
        raw = p.encode()
        return self._ids(self._merge_ascii(self._marked(raw)) if p.isascii() else self._merge(self._paired(raw)))

    def encode_word(self, word: bytes) -> bytes:
        """Ids of one word without ASCII white space inside."""
        if len(self._pieces) >= MAX_PRETOKENS:
            self._pieces.age()
        s = word.decode()
        if b"\0" in word or b"\1" in word or (b"<|" in word and any(x in word for x in self.specials)):
            return self._ids(self.library.encode(s, add_special_tokens=False).ids)
        if not s.isascii() and (max(s) > "\uffff" or not UNASSIGNED.isdisjoint(s)):
            return self._ids(self.library.encode(s, add_special_tokens=False).ids)
        return self._lowered(self._lower(s))

    @staticmethod
    def _lower(s: str) -> str:
        """Words as the library normalises them; white space between words keeps them apart."""
        if not s.isascii():
            s = unicodedata.normalize("NFC", s)
            if "Σ" in s:  # the library lowers each character alone: no final sigma
                s = s.replace("Σ", "σ")
        return s.lower()

    def _age(self) -> None:
        if len(self.words) >= MAX_WORDS:
            self.words.age()
        if len(self._pieces) >= MAX_PRETOKENS:
            self._pieces.age()

    def _lowered(self, s: str) -> bytes:
        if s.isalpha():
            return self._pieces[s]
        if s[-1] in ".,;:!?" and s[:-1].isalpha():
            return self._pieces[s[:-1]] + self._pieces[s[-1]]
        return b"".join(map(self._pieces.__getitem__, self._pretokens(s)))

    def encode_words(self, words: str) -> list[bytes]:
        """Ids of words between line feeds (none if empty), lower-cased together; their pre-tokens
        are remembered."""
        self._age()
        if ODD.search(words):
            each = words.split("\n")
            odd = {w: self.words[w.encode()] for w in each if ODD.search(w)}
            plain = self.encode_words("\n".join("" if w in odd else w for w in each))
            return [odd.get(w, ids) for w, ids in zip(each, plain)]
        pieces, out = self._pieces, []
        for s in self._lower(words).split("\n"):
            if s.isalpha():
                out.append(pieces[s])
            elif s:
                out.append(self._lowered(s))
            else:
                out.append(b"")
        return out

    def encode_column(self, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
        """Ids of a column of whole texts (binary; null: empty), one after another, as little-endian
        bytes of ``dtype``, and the byte at which each text starts (and the last one ends). Words
        met in several texts are looked up once."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, b"").view(pa.string()))
        coded = lists.flatten().dictionary_encode()  # an empty word at white space that ends a text
        if not len(coded):
            return pa.py_buffer(b""), np.zeros(len(texts) + 1, np.int64)
        distinct = pc.binary_join(pa.LargeListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), "\n")[0].as_py()
        each = pa.array(self.encode_words(distinct), pa.large_binary()).take(coded.indices)
        _, ends, data = each.buffers()
        counts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        return data, np.frombuffer(ends, np.int64, len(each) + 1)[counts]

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text as little-endian bytes of ``dtype``."""
        self._age()
        return b"".join(map(self.words.__getitem__, text.split()))


_LOADED: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """The worker's encoder; a reused worker keeps it between tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
