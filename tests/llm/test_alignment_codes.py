"""Operators 11, 12 and 13 against brute force and the tokenizer libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortlens.llm import align, byte_bpe, kmeans_codes
from cohortlens.llm.common import tokenizer_path
from tests.llm.conftest import DOCS, docs_rows

TREE = byte_bpe.ByteBpe(tokenizer_path(byte_bpe.MULTI), leaf=8)
WHOLE = byte_bpe.ByteBpe(tokenizer_path(byte_bpe.MULTI))
BITS = ["a", "b", "the ", "'s", "'re", "'", "r", " ", "  ", "\n", "\t", "1", "23", ".", "!!", "é", "你", "好", "。", "　",
        "​", "\x1c", "\x85", "😀", "́", "ß", "x" * 40, " " * 40, "9" * 30, "-" * 30, "abc" * 30, "'" * 20, "\n" * 20]


# ------------------------------------------------------------------ operator 12
@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(BITS), st.text(max_size=5)), max_size=40).map("".join))
def test_tree_equals_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert TREE.encode(text).tolist() == TREE.plain(text)
    assert TREE.decode(TREE.encode(text)) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(BITS), min_size=3, max_size=30).map("".join), st.data())
def test_joins_are_associative(text, data):
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(text)), st.integers(0, len(text)))))
    x, y, z = TREE.node(text, 0, a), TREE.node(text, a, b), TREE.node(text, b, len(text))
    left, right = TREE.join(text, TREE.join(text, x, y), z), TREE.join(text, x, TREE.join(text, y, z))
    assert left == right and left.ids.tolist() == TREE.plain(text)


@pytest.mark.parametrize("text", ["a" * 60_000, "ab" * 30_000, "你好" * 20_000, " " * 30_000, "\n" * 3000 + "x", "'" * 3000 + "s", "x1" * 20_000,
                                  "".join(random.Random(2).choice("abcdefgh") for _ in range(60_000))])
def test_long_runs(text):
    assert WHOLE.encode(text).tolist() == WHOLE.plain(text)


def test_every_rank_is_what_its_bytes_encode_to():
    """The rule that ends a token window needs this."""
    merge = WHOLE._piece
    assert all(merge(raw) == [i] for i, raw in enumerate(WHOLE.pieces))
    for i, raw in enumerate(WHOLE.pieces):  # also without the library's shortcut for whole entries
        if 1 < len(raw) < 6:
            assert any(WHOLE.pieces[i] == raw[:k] + raw[k:] and raw[:k] in _RANKS and raw[k:] in _RANKS for k in range(1, len(raw)))


_RANKS = set(WHOLE.pieces)


def _digests(ids: list[int]) -> tuple:
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(b"".join(WHOLE.pieces[i] for i in ids)).hexdigest())


@pytest.mark.parametrize("chunk", [1 << 16, 97])
def test_byte_bpe_digests(awkward, clashing, chunk):
    want = sorted([(i, *_digests(WHOLE.plain(t or ""))) for i, t, *_ in docs_rows()], key=str)
    for df in (awkward, clashing):
        got = byte_bpe.encode_decode(df, chunk=chunk, fan=3).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_byte_bpe_of_an_empty_table(empty_docs):
    assert byte_bpe.encode_decode(empty_docs).count() == 0


# ------------------------------------------------------------------ operator 11
PAIR = align.tokenizer_pair(tokenizer_path(align.BYTES), tokenizer_path(align.PIECES))
LIBRARY = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True


def groups_of(text: str) -> list[tuple[list[int], list[int]]]:
    """Groups by walking both token lists: cut where both end."""
    if not text:
        return []
    a, b = LIBRARY.encode(" " + text, add_special_tokens=False).ids, PAIR.b.encode(text)
    raw = b" " + text.encode()
    if b"".join(PAIR.bytes_a[i] for i in a) != raw or b"".join(PAIR.bytes_b[i] for i in b) != raw:
        return []
    out, own, i, j, at_a, at_b = [], ([], []), 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            at_a += len(PAIR.bytes_a[a[i]])
            own[0].append(a[i])
            i += 1
        else:
            at_b += len(PAIR.bytes_b[b[j]])
            own[1].append(b[j])
            j += 1
        if at_a == at_b:
            out.append(own)
            own = ([], [])
    return out


def brute_alignment(rows: list[tuple]) -> list[tuple]:
    groups = [groups_of(t or "") for _, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    count = Counter(k for c in links for k in c)
    best: dict[int, int] = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (i, _), g, c in zip(rows, groups, links):
        sha = hashlib.sha256(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g).encode()).hexdigest() if g else ""
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                    sum(n for k, n in c.items() if count[k] == best[k[0]]), sum(n * count[k] for k, n in c.items()), sha))
    return sorted(out, key=str)


ODD = ["<|endoftext|>", "<s></s>", "<0x41>", "▁", "a▁b", "\0", "ñandú", "ﬁ", "x" * 3000, " ", "\n\n", "aaaa " * 200, "é", "‍😀"]


@pytest.mark.parametrize("block_links", [align.BLOCK_LINKS, 20])
def test_alignment(spark, awkward, clashing, block_links):
    rows = [(r[0], r[1]) for r in docs_rows()]
    want = brute_alignment(rows)
    for df in (awkward, clashing):
        assert sorted((tuple(r) for r in align.align_corpus(df, block_links=block_links).collect()), key=str) == want


def test_alignment_of_odd_texts(spark):
    rows = [(k, t) for k, t in enumerate(ODD + ODD)] + [(None, "nobody"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in align.align_corpus(df, block_links=50).collect()), key=str) == brute_alignment(rows)


def test_alignment_of_an_empty_table(empty_docs):
    assert align.align_corpus(empty_docs).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(BITS + ODD[:8]), st.text(max_size=4)), max_size=25).map("".join))
def test_groups_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    (na, nb, n, links, sha, pairs, times), = align.align(PAIR, [text])
    g = groups_of(text)
    assert (na, nb, n) == (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g))
    want = Counter(x * len(PAIR.bytes_b) + y for a, b in g for x in a for y in b)
    assert dict(zip(pairs.tolist(), times.tolist())) == dict(want) and links == sum(want.values())
    assert sha == (hashlib.sha256(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g).encode()).hexdigest() if g else "")


def test_pointer_jumping_on_random_tilings():
    rng = np.random.default_rng(5)
    for n in (1, 2, 10, 500, 5000):
        end_a = np.unique(np.append(rng.integers(1, 2 * n + 1, n), 2 * n))
        end_b = np.unique(np.append(rng.integers(1, 2 * n + 1, n), 2 * n))
        both = np.intersect1d(end_a, end_b)
        last_a, last_b = align.terminals(end_a, end_b)
        assert (end_b[last_a] == both[np.searchsorted(both, end_a)]).all()
        assert (end_b[last_b] == both[np.searchsorted(both, end_b)]).all()


# ------------------------------------------------------------------ operator 13
VECTORS = "vec_id long, embedding array<float>, label int, code string, home int"


def vector_rows(n: int = 90, dim: int = 64, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = [(int(k), rng.normal(0, 0.3, dim).astype(np.float32).tolist(), None if k % 7 == 0 else int(k % 3), "clash", 1) for k in range(n)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [nan] + [0.0] * 63, [inf] * 64, [None] + [1.0] * 63, [-inf] + [0.0] * 63]
    rows += [(-5 - k, v, 1, "clash", 1) for k, v in enumerate(bad)]
    rows += [rows[3], rows[3], (3, rows[4][1], 2, "x", 0), (None, rows[9][1], None, "x", 0), (200, [0.5] * 10, 2, "x", 0), (201, [], 2, "x", 0),
             (202, [3e30] + [-3e30] + [0.0] * 62, 5, "x", 0)]
    return rows


def brute_codes(rows, parts=16, entries=64, rounds=2):
    bound = 1 << 29
    kept = [(i, [int(np.floor(min(max(256 * float(x), -bound), bound))) for x in v], label) for i, v, label, *_ in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max([len(v) for _, v, _ in kept] or [0]) // parts)
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    full = [v + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in full]
    books = [[(r[1] + [0] * (parts * width - len(r[1])))[p * width:(p + 1) * width] for r in order[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(books[p])) for p, part in enumerate(v)] for v in cut]
    moved = []
    before = None
    for _ in range(rounds):
        got = assign()
        moved.append(0 if before is None else sum(a[1] != b[1] for x, y in zip(got, before) for a, b in zip(x, y)))
        before = got
        for p in range(parts):
            for k in range(len(books[p])):
                own = [v[p] for v, g in zip(cut, got) if g[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    got = assign()
    errors = [sum(d for d, _ in g) for g in got]
    label_error = Counter()
    for (_, _, label), e in zip(kept, errors):
        label_error[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    rows = sorted([(i, "".join(f"{k:02x}" for _, k in g), e, label_error[label], sha) for (i, _, label), g, e in zip(kept, got, errors)], key=str)
    return rows, moved


@pytest.mark.parametrize("n,entries,rounds", [(90, 64, 2), (90, 8, 3), (10, 64, 2), (90, 64, 0)])
def test_codes(spark, n, entries, rounds, monkeypatch):
    monkeypatch.setattr(kmeans_codes, "OWNER_MEMBERS", 40)  # several salts
    rows = vector_rows(n)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = kmeans_codes.compress(df, entries=entries, rounds=rounds).collect()
    assert sorted(map(tuple, got), key=str) == brute_codes(rows, entries=entries, rounds=rounds)[0]


def test_only_members_of_another_entry_migrate(spark, monkeypatch):
    rows, sizes, dealt = vector_rows(), [], kmeans_codes._dealt

    def spy(blocks, name):
        out = dealt(blocks, name)
        sizes.append((name, sum(len(r.at) for r in out.select("at").collect())))
        return out
    monkeypatch.setattr(kmeans_codes, "_dealt", spy)
    kmeans_codes.compress(spark.createDataFrame(rows, VECTORS), entries=8, rounds=3)
    want, moved = brute_codes(rows, entries=8, rounds=3)
    assert sizes == [("residents-0", 16 * len(want)), ("residents-1", moved[1]), ("residents-2", moved[2])]
    assert 0 < moved[2] < moved[1] < 16 * len(want)


def test_other_label_and_id_types(spark):
    rows = [("b", [0.1] * 32, "x"), ("a", [0.2] * 32, None), (None, [0.3] * 32, None)]
    got = kmeans_codes.compress(spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")).collect()
    assert {r.vec_id: r.code[:2] for r in got} == {"a": "00", "b": "01", None: "02"}


@pytest.mark.parametrize("rows", [[], [(1, None, 1, "", 0)], [(1, [], 1, "", 0), (2, [], None, "", 0)]])
def test_codes_without_vectors_or_components(spark, rows):
    got = kmeans_codes.compress(spark.createDataFrame(rows, VECTORS)).collect()
    assert [(r.code, r.error) for r in got] == [("00" * 16, 0)] * sum(r[1] is not None for r in rows)
