"""Operators 2 and 9 against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from cohortlens.llm import components, exact_dedup, near_dup
from tests.llm.conftest import DOCS, docs_rows, words


def exact_brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out, used = [], set()
    for i, t, *_ in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        first = i == keep and (t or "", i) not in used
        used.add((t or "", i))
        out.append((i, keep, len(ids), first, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("key_bits", [64, 1])
def test_exact_dedup_matches_brute_force(awkward, clashing, key_bits):
    for df in (awkward, clashing):
        got = exact_dedup.exact_dedup(df, key_bits=key_bits, bits=4, bucket_entries=2).drop("bucket", "chain")
        assert sorted(map(tuple, got.collect()), key=str) == exact_brute(docs_rows())


def test_chains_hold_colliding_texts(awkward):
    pages = exact_dedup.build_index(awkward, key_bits=1, bits=4, bucket_entries=2)
    assert pages.agg({"chain": "max"}).first()[0] > 4  # two keys for all texts


def test_directory_doubles_only_overfull_buckets():
    counts = {c: 1 for c in range(8)} | {12: 9}
    buckets = exact_dedup.directory(counts, 4, 4)
    assert buckets[0] == (0, 2) and (12, 4) in buckets  # nine entries of one cell end at full depth
    cells = [c for first, d in buckets for c in range(first, first + (1 << (4 - d)))]
    assert cells == list(range(16))


def test_exact_dedup_empty_table(empty_docs):
    assert exact_dedup.exact_dedup(empty_docs).count() == 0


def near_brute(rows):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.setdefault(i, []).append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    ids = sorted(i for i in sets if i is not None)
    comp = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                if a < b and any(x and y and 100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return sorted(((i, len(s), comp.get(i), i is None or comp[i] == i) for i in sets for s in sets[i]), key=str)


def test_near_duplicates_match_brute_force(awkward, clashing):
    for df in (awkward, clashing):
        got = sorted(map(tuple, near_dup.near_duplicates(df).collect()), key=str)
        assert got == near_brute(docs_rows())


def test_near_duplicates_in_chains_and_unlinked_buckets(spark):
    """Chains whose ends are far apart, and a group below the threshold that shares buckets."""
    rng, rows = random.Random(3), []
    text = words(120, 9).split()
    for i in range(30):  # each step changes one word: neighbours are linked, ends are not
        text[(7 * i) % 120] = f"new{i}"
        rows.append((i, " ".join(text), "en", "s", 0))
    base = words(200, 4).split()
    for i in range(100, 130):  # members at a similarity of about 0.8 to each other
        own = [w if rng.random() > 0.012 else f"o{i}{k}" for k, w in enumerate(base)]
        rows.append((i, " ".join(own), "en", "s", 0))
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(map(tuple, near_dup.near_duplicates(df).collect()), key=str) == near_brute(rows)


def test_blocks_compare_every_pair_once(spark, monkeypatch):
    """Blocks of three members find what one block finds."""
    rng = random.Random(5)
    base = words(200, 4).split()
    rows = [(i, " ".join(w if rng.random() > 0.012 else f"o{i}{k}" for k, w in enumerate(base)), "en", "s", 0) for i in range(24)]
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, got.collect()), key=str) == near_brute(rows)


def test_spans_of_blocks_find_every_link(spark, monkeypatch):
    """Buckets of many blocks and several spans, also with blocks by shingles, find what brute force finds."""
    rng = random.Random(6)
    base = words(200, 4).split()
    rows = [(i, " ".join(w if rng.random() > 0.012 else f"o{i}{k}" for k, w in enumerate(base)), "en", "s", 0) for i in range(30)]
    want = near_brute(rows)
    for block, shingles, span in ((3, 1 << 20, 2), (512, 600, 1)):
        for name, value in (("BLOCK", block), ("BLOCK_SHINGLES", shingles), ("SPAN", span)):
            monkeypatch.setattr(near_dup, name, value)
        got = near_dup.near_duplicates(spark.createDataFrame(rows, DOCS))
        assert sorted(map(tuple, got.collect()), key=str) == want


def _made_members(n, seed):
    """Members (block, id, component, size, bands, sketch, text) of one bucket: pairs at all similarities."""
    import zstandard

    rng = random.Random(seed)
    base, out = words(120, seed).split(), []
    for i in range(n):
        text = " ".join(w if rng.random() > 0.02 * (i % 4) else f"o{i}{k}" for k, w in enumerate(base)).encode()
        s = near_dup.shingle_set(text)
        k = near_dup.sketch(s)
        out.append((i % 5, i, i, len(s), near_dup.band_keys(k), k.astype(np.uint8).tobytes(), zstandard.ZstdCompressor().compress(text)))
    return out


@pytest.mark.parametrize("width", [1, 2, 5])
def test_texts_go_only_where_a_sketch_may_have_a_partner(width):
    """Block pairs found by sketches hold every link of the band; members without a partner stay out."""
    members = _made_members(40, 8)
    spans = range(-(-5 // width))
    met = [m for i in spans for j in spans if i <= j for m in near_dup._meeting_blocks(
        [r[:6] for r in members if r[0] // width in (i, j)], i, j, 0, 85, width)]
    assert len(met) == len(set(met))
    wide = {(i, j): near_dup._block_links([r for r in members if r[0] in (i, j)], i, j, 0) for i in range(5) for j in range(i, 5)}
    assert sum(map(len, wide.values())) > 10
    for (i, j), links in wide.items():
        there = {m[2] for m in met if m[:2] == (i, j)}
        assert {x for link in links for x in link} <= there
        assert near_dup._block_links([r for r in members if r[0] in (i, j) and r[1] in there], i, j, 0) == links
    assert near_dup._meeting_blocks([r[:6] for r in members[:1]], 0, 0, 0) == []


def test_shingle_sets_beyond_the_kept_bytes_are_made_again(monkeypatch):
    members = [(0, *r[1:]) for r in _made_members(30, 9)]
    want = near_dup._block_links(members, 0, 0, 0)
    monkeypatch.setattr(near_dup, "SETS_BYTES", 1)
    assert near_dup._block_links(members, 0, 0, 0) == want != []


def near_brute_at(percent, sets):
    """Least id of each document's component, by all pairs."""
    comp = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((comp[a], comp[b]))
                comp = {i: low if c == high else c for i, c in comp.items()}
    return comp


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_at_a_given_similarity(spark, percent):
    import corpus_pipeline

    base, rows = words(204, 4).split(), []
    for g, changed in enumerate((0, 2, 3, 4, 5, 6)):  # similarities 1, 0.90, 0.86, 0.82, 0.78 and 0.74 within a group
        for i in (0, 1):
            own = [f"g{g}{w}" if k % 30 != 7 or k // 30 >= i * changed else f"o{g}x{k}" for k, w in enumerate(base)]
            rows.append((10 * g + i, " ".join(own), "en", "s", 0))
    near = {i: {tuple(w[k:k + 5]) for k in range(200)} for i, w in ((r[0], r[1].split()) for r in rows)}
    comp = near_brute_at(percent, near)
    assert len(set(comp.values())) == {80: 8, 85: 9}[percent]
    df = spark.createDataFrame(rows, DOCS)
    got = near_dup.near_duplicates(df, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == comp
    if percent == 80:  # the pipeline's stage
        left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()}
        assert left == set(comp.values())


def test_pairs_meet_although_sketch_bytes_agree_in_an_earlier_band():
    """Band 0 agrees in the 8 bits of a sketch byte but not in its key: the pair's first bucket is that of band 1."""
    import zstandard

    members = []
    for i, text in enumerate((words(200, 4), words(200, 4) + " more")):
        k = near_dup.sketch(near_dup.shingle_set(words(200, 4).encode()))
        k[0] += np.uint64(i << 8)
        members.append((0, i, i, 196 + i, near_dup.band_keys(k), k.astype(np.uint8).tobytes(),
                        zstandard.ZstdCompressor().compress(text.encode())))
    assert members[0][5] == members[1][5] and (members[0][4] == members[1][4]).tolist() == [False] + [True] * 31
    assert near_dup._block_links(members, 0, 0, 1) == [(0, 1)]
    assert near_dup._block_links(members, 0, 0, 2) == []  # tested once


def test_near_duplicates_empty_table(empty_docs):
    assert near_dup.near_duplicates(empty_docs).count() == 0


@pytest.mark.parametrize("n", [1, 3, 40, 3000])
def test_sketch_agreement_estimates_similarity(n):
    rng = np.random.default_rng(n)
    a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    assert (near_dup.sketch(a) == near_dup.sketch(a[::-1])).all()
    assert near_dup.sketch(a).max() != np.iinfo(np.uint64).max  # every bin is filled
    b = np.concatenate([a[: int(0.9 * n)], rng.integers(0, 2 ** 63, n - int(0.9 * n)).astype(np.uint64)])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((near_dup.sketch(a) == near_dup.sketch(b)).mean() - true) < 0.15


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + k, 501 + k) for k in range(60)] + [(900, 900)]
    least = {x: x for e in links for x in e}
    for _ in range(300):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {x: least[x] for x in linked}
