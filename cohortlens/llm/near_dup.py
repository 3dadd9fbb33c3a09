"""Operator 9: near duplicates by fast similarity sketching, banding and exact checks.

    1. Features (one pass, written once): words, distinct 5-word shingles, their number, a
       digest of the whole set, and the sketch. Sketching throws every shingle into a hashed
       bin, round after round, until every one of ``COORDS`` bins is filled (the last rounds
       deal each bin a value of its own, which guarantees it); a bin keeps its least value,
       led by the round number. Two sketches agree in a coordinate with probability equal to
       the sets' similarity, concentrated as for independent coordinates.
    2. Classes: documents with one shingle set are linked through the least id of the class;
       only this representative goes on, so copies never meet each other in pairs.
    3. Bands of ``ROWS`` coordinates: representatives that agree in a whole band share a
       bucket. A pair misses all bands with probability 1e-8 at similarity 0.85, 3e-6 at 0.8.
    4. Stars: each bucket pairs its members with its least and its greatest member; pairs are
       checked on full shingle sets, and links give components.
    5. Buckets that still span several components are compared block by block: pairs of
       different components whose sizes and sketches allow the similarity, each in the first
       band it shares. Ids and sketches alone decide first, ``SPAN`` blocks a side in one task,
       which blocks a member has such a partner in; only there its text goes, and the pairs
       are checked on full sets (blocks of about ``BLOCK`` members or ``BLOCK_SHINGLES``
       shingles, whichever are more blocks). Links that join components come out, at most one
       a member and block.
    6. Components of all links.

No bucket is capped; a pair is passed over only if its members are already in one component,
their sizes rule the similarity out, or their sketches differ by over six standard deviations.

The least similarity of a link is ``percent``, 85 unless the caller gives another.

Defined results: null, empty and blank texts have an empty set, no links and stay; fewer
than five words make one shingle of the whole sequence; equal sets are linked; rows that
repeat an id are one document, linked through any of its texts; a null id is never linked
and stays; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import sliced, via_table
from cohortlens.llm.components import components

WORDS = 5
PERCENT = 85
BANDS, ROWS = 32, 5
COORDS = BANDS * ROWS
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
SPAN = 16
SETS_BYTES = 64 << 20  # shingle sets that a block's task keeps; others are made again

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (wraps around)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a whole text (ASCII upper case is folded)."""
    import xxhash

    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words), seed=n)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    x = h[: n - 4] * _ODD[0]
    for k in range(1, WORDS):
        x = _mix(x) + h[k: n - 4 + k] * _ODD[k]
    return np.unique(_mix(x))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def min_agree(percent: int) -> int:
    """Least agreeing coordinates of a pair at the similarity, by over six standard deviations."""
    p = percent / 100
    return int(COORDS * p - 6.2 * (COORDS * p * (1 - p)) ** 0.5)


def sketch(shingles: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """The filled bins: round number above 32 bits of hash, least value of each bin."""
    out = np.full(coords, np.iinfo(np.uint64).max, np.uint64)
    t, n, done = np.uint64(coords), len(shingles), 0
    low = np.uint64(0xFFFFFFFF)
    while done < 2 * coords:
        # as many rounds at a time as are likely to fill all bins
        rounds = np.arange(done, min(2 * coords, done + max(1, int(1.3 * coords * np.log(coords) / n))), dtype=np.uint64)
        v = _mix(shingles[None, :] + _mix((rounds + np.uint64(1)) * _ODD[1])[:, None])
        own = rounds[:, None] >= t
        bins = np.where(own, rounds[:, None] - t, ((v & low) * t) >> np.uint64(32))
        np.minimum.at(out, bins.ravel().astype(np.int64), ((rounds[:, None] << np.uint64(32)) | (v >> np.uint64(32))).ravel())
        done = int(rounds[-1]) + 1
        if out.max() != np.iinfo(np.uint64).max:
            break
    return out


_BAND = _mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[3])


def band_keys(s: np.ndarray) -> np.ndarray:
    x = np.zeros(BANDS, np.uint64)
    for k in range(ROWS):
        x = _mix(x + s.reshape(BANDS, ROWS)[:, k] * _ODD[k])
    return _mix(x + _BAND).view(np.int64)


FEATURES = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary, text binary"


def _features(batches):
    import xxhash
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in sliced(batches):
        rows = []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = shingle_set(text or b"")
            if i is None or not len(s):
                rows.append((i, len(s), None, None, None, None))
                continue
            k = sketch(s)
            rows.append((i, len(s), xxhash.xxh3_128_digest(s.tobytes()), band_keys(k),
                         k.astype(np.uint8).tobytes(), pack(text)))
        types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)],
                                         names=["doc_id", "n_shingles", "digest", "bands", "sketch", "text"])


def _linked(percent: int):
    """(a, b, text_a, text_b) -> the pairs whose full sets reach the similarity."""
    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        last, kept = None, None
        for batch in sliced(batches, 2, 4 << 20):
            out = []
            for a, b, ta, tb in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if last is None or ta != last:
                    last, kept = ta, shingle_set(unpack(ta))
                other = shingle_set(unpack(tb))
                if similar(kept, other, percent):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return run


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """pairs (a, b) -> those that are links; texts (doc_id, text) holds compressed whole texts."""
    left = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = left.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_linked(percent), "a long, b long")


def _first_band(bands: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The first band whose whole key, the bucket, each row of bands shares with x."""
    return (bands == x).argmax(axis=1)


def _partners(columns: tuple[np.ndarray, ...], at, others, same: bool, band: int, percent: int):
    """For each member of ``at``: (member, those of ``others`` it may be linked with), where sizes and
    sketches allow the similarity, components differ and no earlier band is shared.
    columns: ids, components (read anew for each member), sizes, bands, sketches."""
    ids, comp, n, bands, s = columns
    least = min_agree(percent)
    for x in at.tolist():
        y = others[(comp[others] != comp[x]) & (100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x]))]
        if same:
            y = y[ids[y] > ids[x]]
        y = y[(s[y] == s[x]).sum(axis=1) >= least]
        if len(y):
            yield x, y[_first_band(bands[y], bands[x]) == band]


def _columns(members: list[tuple]) -> tuple[np.ndarray, ...]:
    """Arrays of (id, component, size, bands, sketch) that lead each member."""
    ids, comp, n = (np.array([r[k] for r in members], np.int64) for k in range(3))
    bands = np.array([r[3] for r in members], np.int64)
    return ids, comp, n, bands, np.frombuffer(b"".join([r[4] for r in members]), np.uint8).reshape(len(members), COORDS)


def _block_links(members: list[tuple], i: int, j: int, band: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join components, among the members (side, id, component, size, bands, sketch, text)
    of one block pair. A pair is tested in the first band it shares, if sizes and sketches allow the
    similarity, unless links found before have joined its components."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    side = np.array([r[0] for r in members], np.int64)
    columns = ids, comp, *_ = _columns([r[1:6] for r in members])
    sets: dict[int, np.ndarray] = {}

    def shingles(k):
        if k not in sets:
            if sum(v.nbytes for v in sets.values()) > SETS_BYTES:
                sets.clear()
            sets[k] = shingle_set(unpack(members[k][6]))
        return sets[k]
    at = np.flatnonzero(side == i)
    out = []
    for x, y in _partners(columns, at, at if i == j else np.flatnonzero(side == j), i == j, band, percent):
        for k in y.tolist():
            if comp[k] != comp[x] and similar(shingles(x), shingles(k), percent):
                out.append((int(ids[x]), int(ids[k])))
                comp[comp == comp[k]] = comp[x]
    return out


def _meeting_blocks(members: list[tuple], i: int, j: int, band: int, percent: int = PERCENT,
                    width: int = SPAN) -> list[tuple[int, int, int, int]]:
    """(lesser block, greater block, id, its block) for every member (block, id, component, size, bands,
    sketch) of spans i and j, of ``width`` blocks, that may be linked with another by sizes and sketches."""
    block = np.array([r[0] for r in members], np.int64)
    columns = ids, *_ = _columns([r[1:6] for r in members])
    at = np.flatnonzero(block // width == i)
    out = set()
    for x, y in _partners(columns, at, at if i == j else np.flatnonzero(block // width == j), i == j, band, percent):
        for k in y.tolist():
            pair = sorted((int(block[x]), int(block[k])))
            out.add((*pair, int(ids[x]), int(block[x])))
            out.add((*pair, int(ids[k]), int(block[k])))
    return sorted(out)


def _by_group(batches, bands_at: int):
    """Rows (key, i, j, band, member...) sorted by group -> (group, members); bands come as arrays."""
    group, rows = None, []
    for batch in batches:
        columns = [batch.column(k).to_pylist() if k != bands_at else batch.column(k).flatten().to_numpy().reshape(-1, BANDS)
                   for k in range(batch.num_columns)]
        for key, i, j, band, *member in zip(*columns):
            if (key, i, j, band) != group:
                if rows:
                    yield group, rows
                group, rows = (key, i, j, band), []
            rows.append(member)
    if rows:
        yield group, rows


def _compare_blocks(percent: int):
    """Members of one block pair, sorted together -> links that join components."""
    def run(batches):
        for group, rows in _by_group(batches, 8):
            links = _block_links(rows, *group[1:], percent)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return run


def _compare_sketches(percent: int, width: int):
    """Members of one pair of spans, sorted together -> the block pairs in which a member may have a link."""
    def run(batches):
        for (key, i, j, band), rows in _by_group(batches, 8):
            met = _meeting_blocks(rows, i, j, band, percent, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(met), pa.int64()), pa.array([m[0] for m in met], pa.int32()),
                 pa.array([m[1] for m in met], pa.int32()), pa.array([band] * len(met), pa.int32()),
                 pa.array([m[3] for m in met], pa.int32()), pa.array([m[2] for m in met], pa.int64())],
                names=["key", "i", "j", "band", "side", "doc_id"])
    return run


def _open_links(members: DataFrame, reps: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Links still missing: buckets that span components, compared in blocks of bounded size, first by
    ids and sketches, then on the texts of the members that may have a link there."""
    comp = comp.withColumnRenamed("node", "doc_id")
    named = members.join(comp, "doc_id", "left").select("key", "band", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    open_keys = (named.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("size"),
                                          F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .filter("lo < hi")
                 .select("key", F.ceil(F.greatest(F.col("m") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("key", "doc_id"), F.col("blocks").cast("long")).cast("int")
    span = F.floor(F.col("block") / SPAN).cast("int")
    rows = (named.join(open_keys, "key").join(reps.select("doc_id", "bands", "sketch"), "doc_id")
            .withColumn("block", block).withColumn("span", span)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((F.col("blocks") - 1) / SPAN).cast("int"))))
            .select("key", F.least("span", "other").alias("i"), F.greatest("span", "other").alias("j"), "band",
                    "block", "doc_id", "component", "n_shingles", "bands", "sketch"))
    meet = via_table(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                     .mapInArrow(_compare_sketches(percent, SPAN), "key long, i int, j int, band int, side int, doc_id long"),
                     "near-meeting")
    texts = (meet.join(reps.select("doc_id", "n_shingles", "bands", "sketch", "text"), "doc_id").join(comp, "doc_id", "left")
             .select("key", "i", "j", "band", "side", "doc_id", F.coalesce("component", "doc_id").alias("component"),
                     "n_shingles", "bands", "sketch", "text"))
    return (texts.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(_compare_blocks(percent), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    feats = via_table(rows.mapInArrow(_features, FEATURES), "near-features")
    classes = via_table(feats.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = feats.join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
    bands = reps.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = bands.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    members = via_table(bands.join(shared, "key"), "near-members")
    stars = (members.select("doc_id", F.explode(F.array("lo", "hi")).alias("hub")).filter("doc_id != hub")
             .select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")).distinct())
    texts = reps.select("doc_id", "text")
    links = via_table(verified(stars, texts, percent), "near-links")
    comp = components(links)
    more = _open_links(members, reps, comp, percent)
    comp = components(links.unionByName(more))
    named = (classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left")
             .select("digest", F.coalesce("component", "rep").alias("component")))
    return (feats.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))))
