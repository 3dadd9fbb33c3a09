"""Operators 3, 6 and 8 against the tokenizers library and serial packing."""

from __future__ import annotations

import bisect
import hashlib
import random
import sys
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlens.llm import bpe, packing, training_order, wordbpe
from cohortlens.llm.common import tokenizer_path
from cohortlens.llm.wordbpe import word_bpe
from tests.llm.conftest import docs_rows


@pytest.fixture(scope="module")
def library():
    return LIBRARY


LIBRARY = Tokenizer.from_file(tokenizer_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def ours(text):
    enc = word_bpe(tokenizer_path())
    return np.frombuffer(enc.encode(text.encode()), enc.dtype).tolist()


def test_every_vocabulary_entry_is_reached_as_in_the_library(library):
    plain = [p[:-4] for p in library.get_vocab() if p.endswith("</w>")]
    texts = [p for p in plain if p.isascii()]
    assert len(texts) > 10_000
    for a in range(0, len(texts), 2000):
        part = texts[a:a + 2000]
        assert [ours(t) for t in part] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_every_assigned_character_between_letters(library):
    chars = [chr(c) for c in range(sys.maxunicode) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    texts = [" ".join("a" + c + "B" for c in chars[k:k + 50]) for k in range(0, len(chars), 50)]
    for a in range(0, len(texts), 500):
        part = texts[a:a + 500]
        assert [ours(t) for t in part] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ours(text) == ids_of(LIBRARY, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.one_of(st.sampled_from(" \n\x0b\x1c\x85aBÉéΣ'.!<|\0\1\U0001f600\u0378"), st.characters()), max_size=30),
                          st.just("<|startoftext|> Don't don't. 12ab")), max_size=6), st.integers(0, 2))
def test_a_column_of_texts(texts, skip):
    texts = [t if t is None else t.encode("utf-8", "ignore") for t in texts]
    enc = word_bpe(tokenizer_path())
    data, at = enc.encode_column(pa.array(texts, pa.binary()).slice(skip))
    got = [np.frombuffer(data, enc.dtype, (b - a) // enc.dtype.itemsize, a).tolist() if b > a else [] for a, b in zip(at.tolist(), at[1:].tolist())]
    assert got == [ids_of(LIBRARY, (t or b"").decode()) for t in texts[skip:]]


def test_pretokens_of_a_column_are_merged_once_and_common_ones_outlive_rare_ones(monkeypatch):
    enc, met = wordbpe.WordBpe(tokenizer_path()), []
    for merge in ("_merge", "_merge_ascii"):
        monkeypatch.setattr(enc, merge, lambda raw, run=getattr(enc, merge): met.append(raw) or run(raw))
    monkeypatch.setattr(wordbpe, "MAX_PRETOKENS", 30)
    for k in range(20):
        rare = " ".join(f"{a}{b}q" for a in "abcde" for b in "fghijklmnopqrstuvwxyz"[k:k + 2])
        enc.encode_column(pa.array([f"Common common. COMMON, {rare} été Été".encode()] * 3))
    assert sum(enc._marked(b"common") == raw for raw in met) == sum(enc._paired("été".encode()) == raw for raw in met) == 1


def test_encode_decode_digests(awkward, clashing, library):
    want = []
    for i, t, *_ in docs_rows():
        ids = ids_of(library, t)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    for df in (awkward, clashing):
        assert sorted(map(tuple, bpe.encode_decode(df).collect()), key=str) == sorted(want, key=str)


def test_word_lists_may_be_split(awkward, monkeypatch, library):
    split = bpe._split_words
    monkeypatch.setattr(bpe, "_split_words", lambda bins: split(bins, max_words=3))
    got = {(r.doc_id, r.n_tokens) for r in bpe.encode_decode(awkward).collect()}
    assert got == {(i, len(ids_of(library, t))) for i, t, *_ in docs_rows()}


def test_tokens_of_an_empty_table(empty_docs):
    assert bpe.encode_decode(empty_docs).count() == 0
    assert packing.pack(empty_docs).count() == 0


# ------------------------------------------------------------------ packing
def serial(lengths, cap):
    bins = []
    for x in sorted(lengths, reverse=True):
        fits = [b for b in bins if b >= x]
        if fits:
            bins.remove(min(fits))
            bins.append(min(fits) - x)
        else:
            bins.append(cap - x)
    return len(bins)


def in_one_process(counts, cap, ranges):
    """The supersteps without Spark: sweeps of the ranges one after another, then settle."""
    gaps, placed, opened, steps = [], [], 0, 0
    for low, high in packing.stretches(cap):
        pieces = [(packing.PIECE, x, 0, n, 0, 0, 0) for x, n in counts.items() if low < x <= high]
        while pieces:
            width, owners = max(1, -(-(cap - low) // ranges)), {}
            for r in pieces + gaps:
                owners.setdefault(max(0, (cap - r[1]) // width), []).append(r)
            rows = packing.settle([x for own in owners.values() for x in packing.successor_sweep(own, cap)], cap, opened)
            placed += [r for r in rows if r[0] == packing.PLACED]
            gaps, pieces = ([r for r in rows if r[0] == k] for k in (packing.GAP, packing.PIECE))
            opened += sum(r[3] for r in rows if r[0] == packing.OPENED)
            steps += 1
    return np.array([(r[1], r[2], r[4], r[5], r[6]) for r in placed], np.int64).reshape(-1, 5), opened, steps


def random_lengths(rng, n, cap):
    return [rng.randint(1, cap if rng.random() < 0.5 else max(1, cap // 8)) for _ in range(n)]


@pytest.mark.parametrize("cap", [1, 7, 64, 2048])
def test_supersteps_place_every_piece_as_serial_best_fit_does(cap):
    rng = random.Random(cap)
    for n in (0, 1, 5, 60, 300, 3000):
        lengths = random_lengths(rng, n, cap)
        counts = {x: lengths.count(x) for x in lengths}
        runs, opened, steps = in_one_process(counts, cap, 8)
        assert opened == serial(lengths, cap) and steps < 200
        # the number of ranges changes nothing
        assert sorted(map(tuple, runs.tolist())) == sorted(map(tuple, in_one_process(counts, cap, 1)[0].tolist()))
        rows, fill = sorted(map(tuple, runs.tolist())), {}
        for x, k in counts.items():
            own = [r for r in rows if r[0] == x]
            for rank in range(k):
                r = own[bisect.bisect_right([q[1] for q in own], rank) - 1]
                nth, slot = divmod(rank - r[1], r[3])
                fill.setdefault(r[2] + nth, []).append((r[4] + slot * x, x))
        for parts in fill.values():
            at = 0
            for offset, x in sorted(parts):
                assert offset == at
                at += x
            assert at <= cap


def test_spark_supersteps_equal_those_in_one_process(spark):
    lengths = random_lengths(random.Random(3), 400, 64)
    counts = {x: lengths.count(x) for x in lengths}
    table = spark.createDataFrame(list(counts.items()), "length long, n long")
    runs, opened = packing.matched_runs(table, counts, 64)
    want, n, _ = in_one_process(counts, 64, packing.RANGES)
    assert opened == n and sorted(map(tuple, runs.tolist())) == sorted(map(tuple, want.tolist()))
    assert packing.matched_runs(table.where("n < 0"), {}, 64)[1] == 0


def test_packed_documents(awkward, clashing, library):
    want = []
    for i, t, *_ in docs_rows():
        ids = ids_of(library, t) + [0]
        want += [(i, k, at, len(ids[at:at + 64]), zlib.crc32(np.array(ids[at:at + 64], "<u4").tobytes()))
                 for k, at in enumerate(range(0, len(ids), 64))]
    for df in (awkward, clashing):
        rows = packing.pack(df, capacity=64).collect()
        assert sorted((tuple(r[:5]) for r in rows), key=str) == sorted(want, key=str)
        by = {}
        for r in rows:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in by.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= 64
        assert len(by) == serial([r.length for r in rows], 64)


# ------------------------------------------------------------------ training order
@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 65_537])
def test_feistel_is_a_keyed_permutation(n):
    a = training_order.feistel(np.arange(n), n, 1)
    assert sorted(a.tolist()) == list(range(n))
    if n > 100:
        b = training_order.feistel(np.arange(n), n, 2)
        assert (a != b).mean() > 0.9 and abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.2


def feistel_brute(index, n, key):
    """One index in plain integers: six rounds over two halves, walked until inside [0, n)."""
    def mix(x):
        x = (x ^ (x >> 33)) * 0xFF51AFD7ED558CCD % 2 ** 64
        x = (x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53 % 2 ** 64
        return x ^ (x >> 33)
    half = 1
    while 4 ** half < n:
        half += 1
    while True:
        left, right = divmod(index, 2 ** half)
        for k in range(1, 7):
            left, right = right, left ^ mix((right + mix((k * 0x9E3779B97F4A7C15 + key) % 2 ** 64)) % 2 ** 64) % 2 ** half
        index = left * 2 ** half + right
        if index < n:
            return index


@pytest.mark.parametrize("n", [1, 2, 4, 5, 16, 17, 1000])
@pytest.mark.parametrize("key", [0, 5, 2 ** 64 - 1])
def test_feistel_equals_plain_integers(n, key):
    assert training_order.feistel(np.arange(n), n, key).tolist() == [feistel_brute(i, n, key) for i in range(n)]


def test_training_order_ignores_clashing_columns(spark, clashing, awkward):
    read = [sorted(map(tuple, training_order.read_training_order(spark, training_order.write_training_order(
        d.coalesce(1), key=5, length=16, records=8)[0], records=8).collect()), key=str)
            for d in (awkward, clashing.withColumns({c: F.lit(c) for c in ("pid", "place", "slot", "shard", "tokens", "piece")}))]
    assert read[0] == read[1] != []


def test_training_order_round_trip(spark, awkward, library):
    folder, n = training_order.write_training_order(awkward, key=5, length=16, records=8)
    rows = training_order.read_training_order(spark, folder, records=8).collect()
    assert sorted(r.slot for r in rows) == list(range(n))
    want = []
    for i, t, *_ in docs_rows():
        ids = ids_of(library, t)
        want += [(i, k, len(ids[at:at + 16]), zlib.crc32(np.array(ids[at:at + 16], "<u4").tobytes()))
                 for k, at in enumerate(range(0, max(1, len(ids)), 16))]
    assert sorted(((r.doc_id, r.piece, r.n_tokens, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    assert all(r.byte_offset == r.record * (16 + 32) and r.slot == r.shard * 8 + r.record for r in rows)
    rest = training_order.read_training_order(spark, folder, first_slot=n // 2, records=8).collect()
    assert sorted(map(tuple, rest), key=str) == sorted((tuple(r) for r in rows if r.slot >= n // 2), key=str)


def test_training_order_of_an_empty_table(spark, empty_docs):
    folder, n = training_order.write_training_order(empty_docs, key=5)
    assert n == 0 and training_order.read_training_order(spark, folder).count() == 0
