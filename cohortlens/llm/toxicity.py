"""Operator 5: toxicity by a convolutional text classifier over hashed word embeddings.

    Learn  A word's embedding is the sum of the hashed rows of the word and of its heads of 3 to 5
           bytes; filters one, two and three words wide slide over it; each filter's maximum over
           the text enters a logistic layer. The first dimension starts at the feature's
           association with the label, counted over all training rows, the rest at random. Then every
           training row's whole text takes part in gradient steps (Adam, AdaGrad for the
           embeddings): rows are dealt by a hash of their id to rounds and parts, each part trains a
           copy of the round's model in numpy, and the changes are averaged (an embedding's over
           the parts that touched it), summed by Spark as whole numbers so that their order does
           not matter. Every row trains ``EPOCHS`` times, whatever the table's size: one of at most
           ``PART`` rows goes through a round whole, a larger one through ``ROUNDS`` rounds each time.
           Texts are split and hashed once; the rounds read the words' feature buckets. Rare classes
           weigh more, up to ``MAX_WEIGHT``.
    Calibrate  A quarter of the labelled rows is kept out of the training. Texts are told apart by
           language from their own function words, and each language with enough toxic
           calibration texts gets the probability threshold of best F1 there; the others get
           that of all, chosen from counts by ``BINS`` bins. Scores are stretched so that the
           threshold lies at 0.5.
    Score  Whole texts, in slices bounded by bytes and words; a very long text is pooled segment by
           segment (maxima of segments that overlap by the widest filter are the text's). A worker
           computes a distinct word's filter responses once and adds them up along the text.

Labels, ``lang``, ``source`` and ids are never inputs of a score.

Defined results: null and empty texts score like a single unknown word; repeated rows score
the same; labels that repeat an id count once, null labels not at all; without labels of
both classes every score is 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import new_table_path, sliced
from cohortlens.session import drop_path

PART = 8192              # rows that train one after the other between two averages, about
ROUNDS = 4               # averages over tables of more rows in an epoch: each row trains in one of the rounds
BUCKETS = 1 << 16
DIM = 8
FILTERS = {1: 8, 2: 4, 3: 4}
HEADS = (3, 4, 5)
EPOCHS = 6               # times that each row trains
BATCH, BATCH_BYTES = 64, 1 << 22  # texts of a step, fewer if they are long
SCALE = float(1 << 32)   # changes are summed as whole multiples of 1 / SCALE
MAX_WEIGHT = 20.0        # most that a row of a rare class may weigh
BINS = 1 << 12           # bins of the probabilities that thresholds are chosen by
MIN_POSITIVES = 12       # toxic calibration texts that a language needs for its own threshold
MAX_WORDS = 100_000      # distinct words a worker remembers before it starts afresh
#: function words by which a text's language is told (own small lists)
LANGUAGES = {"en": "the and of to in is that for on with", "de": "der die und das ist nicht von mit den ein",
             "fr": "le la et les des est dans que une pour", "es": "el los las de que en una del por se"}
SEGMENT_BYTES = 1 << 18  # a longer text is pooled in segments
SLICE_WORDS = 50_000     # words whose responses a worker holds at a time
AHEAD = max(FILTERS) - 1
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]").search
_EDGE = b".,;:!?\"'()[]|*#$%&<>-"


def features(words: list[bytes]) -> np.ndarray:
    """words x (1 + heads) hash buckets: each word and its heads (bucket 0 pads)."""
    from xxhash import xxh3_64_intdigest as digest

    flat, n = [], BUCKETS - 1
    for word in words:
        w = word.strip(_EDGE).lower()
        m = len(w)
        flat.append(digest(w) % n + 1)
        for k in HEADS:
            flat.append(digest(w[:k], k) % n + 1 if m >= k else 0)
    return np.array(flat, np.int32).reshape(-1, 1 + len(HEADS))


@dataclass
class Model:
    emb: np.ndarray                                     # BUCKETS x DIM
    filters: dict[int, np.ndarray]                      # width -> width x DIM x n
    bias: dict[int, np.ndarray]
    out: np.ndarray
    const: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.out + self.const
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, p: np.ndarray, lang: list[str]) -> np.ndarray:
        t = np.array([self.thresholds.get(k, self.thresholds[""]) for k in lang])
        return np.where(p < t, 0.5 * p / t, 0.5 + 0.5 * (p - t) / (1 - t))


def _language(counts: np.ndarray) -> list[str]:
    names = list(LANGUAGES)
    return [names[k] if m else "" for k, m in zip(counts.argmax(axis=1), counts.max(axis=1))]


class Scorer:
    """Filter responses of distinct words, remembered by a worker."""

    def __init__(self, model: Model):
        self.model = model
        blocks = [model.filters[w][j] for w in FILTERS for j in range(w)]
        self.emb = model.emb.astype(np.float32)
        self.weights = np.concatenate(blocks, axis=1).astype(np.float32)  # DIM x all responses
        self.function_words = {x.encode(): k for k, v in enumerate(LANGUAGES.values()) for x in v.split()}
        self.reset()

    def reset(self):
        self.index: dict[bytes, int] = {b"": 0}
        self.rows = np.zeros((1 << 14, self.weights.shape[1]), np.float32)
        self.lang = np.full(1 << 14, len(LANGUAGES), np.int8)

    def _learn(self, words: list[bytes]):
        n, m = len(self.index), len(words)
        while n + m > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.lang = np.concatenate([self.lang, np.full_like(self.lang, len(LANGUAGES))])
        ids = features(words)
        emb = self.emb
        vec = emb[ids[:, 0]]
        for k in range(1, ids.shape[1]):
            vec = vec + emb[ids[:, k]]
        self.rows[n:n + m] = vec @ self.weights
        for k, w in enumerate(words):
            self.index[w] = n + k
            self.lang[n + k] = self.function_words.get(w.lower(), len(LANGUAGES))

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x filters maxima, texts x languages counts of function words), in slices of about
        ``SLICE_WORDS`` words; a long text goes through in segments."""
        best = np.full((len(texts), sum(FILTERS.values())), -np.inf, np.float32)
        counts = np.zeros((len(texts), len(LANGUAGES)), np.int64)
        held, size = [], 0
        for k, text in enumerate(texts):
            for words, final in _segments(text):
                held.append((k, words, final))
                size += len(words)
                if size >= SLICE_WORDS:
                    self._pool(held, best, counts)
                    held, size = [], 0
        if held:
            self._pool(held, best, counts)
        return best + np.concatenate([self.model.bias[w] for w in FILTERS]), counts

    def _pool(self, segments: list[tuple[int, list[bytes], bool]], best: np.ndarray, counts: np.ndarray):
        """Raise the maxima and counts of the segments' texts."""
        if len(self.index) > MAX_WORDS:
            self.reset()
        new = set().union(*(w for _, w, _ in segments)).difference(self.index)
        if new:
            self._learn(sorted(new))
        get, ids, pad = self.index.__getitem__, [], [0] * AHEAD
        for _, words, final in segments:
            ids += map(get, words)
            if final:
                ids += pad
        ids = np.array(ids, np.int64)
        starts, cut, _ = _layout(segments)
        text = np.array([k for k, _, _ in segments])
        rows, at, lo = self.rows[ids], 0, 0
        for w, n in FILTERS.items():
            conv = rows[starts, at:at + n].copy()
            for j in range(1, w):
                conv += rows[starts + j, at + j * n:at + (j + 1) * n]
            np.maximum.at(best[:, lo:lo + n], text, np.maximum.reduceat(conv, cut, axis=0))
            at += w * n
            lo += n
        lang = self.lang[ids[starts]]
        for k in range(len(LANGUAGES)):
            np.add.at(counts[:, k], text, np.add.reduceat((lang == k).astype(np.int64), cut))


def _segments(text: bytes, size: int | None = None):
    """(words, whether they end the text): runs of words of a text, each starting with the last
    ``AHEAD`` words of the one before. A text without words is one empty word."""
    size = SEGMENT_BYTES if size is None else size
    if len(text) <= size:
        yield text.split() or [b""], True
        return
    held, lo = [], 0
    while lo < len(text):
        gap = _SPACE(text, lo + size)
        hi = gap.start() if gap else len(text)
        held += text[lo:hi].split()
        lo = hi
        if lo < len(text) and len(held) > AHEAD:
            yield held, False
            held = held[-AHEAD:]
    yield held or [b""], True


def _layout(segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places where filters start, first of them and number of them by segment) in segments laid end to
    end. They are all words but the last AHEAD, which are padding or start the next segment."""
    sizes = np.array([len(w) if final else len(w) - AHEAD for _, w, final in segments])
    stops = np.cumsum(sizes + AHEAD)
    starts = np.ones(stops[-1], bool)
    for back in range(1, AHEAD + 1):
        starts[stops - back] = False
    return np.flatnonzero(starts), np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes


# ---------------------------------------------------------------- state of the training: rows of DIM + 1 numbers
def _parameters(flat: np.ndarray) -> dict:
    """Views of the filters, biases, output weights and constant inside a flat vector."""
    out, lo = {}, 0
    for w, n in FILTERS.items():
        out[f"f{w}"], lo = flat[lo:lo + w * DIM * n].reshape(w, DIM, n), lo + w * DIM * n
        out[f"b{w}"], lo = flat[lo:lo + n], lo + n
    out["out"], lo = flat[lo:lo + N_FILTERS], lo + N_FILTERS
    out["const"] = flat[lo:lo + 1]
    return out


N_FILTERS = sum(FILTERS.values())
N_DENSE = sum(w * DIM * n + n for w, n in FILTERS.items()) + N_FILTERS + 1
DENSE_ROWS = -(-(3 * N_DENSE + 1) // (DIM + 1))  # parameters, Adam's mean and root mean square, steps


def _dense(state: np.ndarray) -> np.ndarray:
    """The flat part of a state, a view: parameters, their two moments, the number of steps."""
    return state[BUCKETS:].reshape(-1)


def start_state(seen: np.ndarray, n: tuple[int, int], seed: int = 7) -> np.ndarray:
    """Before the first step: embeddings and their summed squares, then the flat part. ``seen``: texts of
    each class that hold a bucket; ``n``: texts of each class."""
    rng = np.random.default_rng(seed)
    state = np.zeros((BUCKETS + DENSE_ROWS, DIM + 1))
    state[:BUCKETS, :DIM] = rng.normal(0, 0.05, (BUCKETS, DIM))
    state[:BUCKETS, 0], state[:BUCKETS, DIM] = _association(seen, n), 1e-3
    state[0, :DIM] = 0
    p = _parameters(_dense(state)[:N_DENSE])
    for w, k in FILTERS.items():
        p[f"f{w}"][:] = rng.normal(0, 0.1, (w, DIM, k))
    p["out"][:], p["const"][0] = rng.normal(0, 0.1, N_FILTERS), -1.5
    p["f1"][0, 0, 0], p["out"][0] = 1.0, 2.0
    return state


def to_model(state: np.ndarray) -> Model:
    p = _parameters(_dense(state)[:N_DENSE].copy())
    return Model(state[:BUCKETS, :DIM].copy(), {w: p[f"f{w}"] for w in FILTERS}, {w: p[f"b{w}"] for w in FILTERS}, p["out"], float(p["const"][0]), {"": 0.5})


def _without_classes() -> Model:
    """Labels of one class or none: every score is 0."""
    model = to_model(start_state(np.zeros((2, BUCKETS)), (0, 0)))
    model.thresholds[""], model.const, model.out[:] = 1 - 1e-9, -30.0, 0
    return model


def _association(seen: np.ndarray, n: tuple[int, int]) -> np.ndarray:
    """Signed root of chi-square of each bucket's presence with the label, less what chance gives."""
    (n0, n1), (b, a) = map(float, n), np.asarray(seen, float)
    c, d = n1 - a, n0 - b
    chi = (a * d - b * c) / np.sqrt(np.maximum((a + b) * (c + d) * n1 * n0, 1)) * np.sqrt(n0 + n1)
    out = np.clip(chi - 4, 0, 12) / 6
    out[0] = 0
    return out


class Features:
    """Feature buckets of distinct words, remembered by a worker. A word's buckets make one key of 8 bytes;
    key 0 is padding."""

    def __init__(self):
        self.reset()

    def reset(self):
        self.index: dict[bytes, int] = {b"": 0}
        self.rows = np.zeros(1 << 14, KEY)

    def learn(self, words):
        if len(self.index) > MAX_WORDS:
            self.reset()
        new = sorted(set(words).difference(self.index))
        n, m = len(self.index), len(new)
        while n + m > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        if new:
            self.rows[n:n + m] = features(new).astype(BUCKET).view(KEY).ravel()
            self.index.update(zip(new, range(n, n + m)))

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(distinct keys, place of each word of the text among them)."""
        held = []
        for words, _ in _segments(text):
            words = words[AHEAD if held else 0:]
            self.learn(words)
            held.append(self.rows[list(map(self.index.__getitem__, words))])
        keys, at = np.unique(np.concatenate(held), return_inverse=True)
        return keys, at.astype(_places(len(keys)))


BUCKET, KEY = np.dtype("<u2"), np.dtype("<u8")  # a bucket, and a word's 1 + heads buckets as one number


def _places(n: int) -> np.dtype:
    """Numbers wide enough for a place among n keys."""
    return np.dtype("u1" if n <= 1 << 8 else "<u2" if n <= 1 << 16 else "<u4")


def _buckets(keys: np.ndarray) -> np.ndarray:
    return keys.view(BUCKET).reshape(len(keys), -1)


def _count(seen: np.ndarray, keys: np.ndarray):
    """One more text in every bucket it holds."""
    seen[np.unique(_buckets(keys))] += 1


class Trainer:
    """Steps over texts as they come, from a state that is left as it is."""

    def __init__(self, state: np.ndarray, weights: tuple[float, float], known: Features | None = None):
        self.before, self.state, self.weights = state, state.copy(), weights
        self.emb, self.square, self.flat = self.state[:BUCKETS, :DIM], self.state[:BUCKETS, DIM], _dense(self.state)
        self.known, self.touched = known or Features(), np.zeros(BUCKETS, bool)
        self.texts, self.labels, self.size = [], [], 0

    def add(self, text: bytes, label: int):
        self.add_words(*self.known.encode(text), label)

    def add_words(self, keys: np.ndarray, at: np.ndarray, label: int):
        """One more text, as ``Features.encode`` gives it."""
        self.texts.append((keys, at))
        self.labels.append(label)
        self.size += keys.nbytes + at.nbytes
        if len(self.texts) == BATCH or self.size >= BATCH_BYTES:
            self.step()

    def _pool(self, segments, best: np.ndarray, window: np.ndarray, p: dict):
        """Raise the texts' maxima; each keeps the features of the words it was found at."""
        own = {k: self.texts[k][0] for k, _, _ in segments}
        distinct, place = np.unique(np.concatenate([PAD, *own.values()]), return_inverse=True)  # key 0 comes first
        first, pad, ids = dict(zip(own, np.cumsum([1, *map(len, own.values())]))), np.zeros(AHEAD, place.dtype), []
        for k, at, final in segments:
            ids.append(place[first[k]:first[k] + len(own[k])][at])
            if final:
                ids.append(pad)
        ids, feats = np.concatenate(ids), _buckets(distinct)
        blocks = np.concatenate([p[f"f{w}"][j] for w in FILTERS for j in range(w)], axis=1)
        rows = (self.emb[feats].sum(axis=1) @ blocks).astype(np.float32)[ids]
        starts, cut, sizes = _layout(segments)
        text, order, at, lo = np.array([k for k, _, _ in segments]), np.arange(len(starts))[:, None], 0, 0
        for w, n in FILTERS.items():
            conv = rows[starts, at:at + n].copy()
            for j in range(1, w):
                conv += rows[starts + j, at + j * n:at + (j + 1) * n]
            top = np.maximum.reduceat(conv, cut, axis=0)
            place = np.minimum.reduceat(np.where(conv == np.repeat(top, sizes, axis=0), order, len(starts)), cut, axis=0)
            better = top > best[text, lo:lo + n]
            best[text, lo:lo + n] = np.where(better, top, best[text, lo:lo + n])
            for j in range(w):
                window[text, lo:lo + n, j] = np.where(better[..., None], feats[ids[starts[place] + j]], window[text, lo:lo + n, j])
            at += w * n
            lo += n

    def step(self):
        """One step over the held texts: Adam on the flat parameters, AdaGrad on the embeddings."""
        if not self.texts:
            return
        b, p = len(self.texts), _parameters(self.flat[:N_DENSE])
        best = np.full((b, N_FILTERS), -np.inf, np.float32)
        window = np.zeros((b, N_FILTERS, AHEAD + 1, 1 + len(HEADS)), np.int32)
        held, size = [], 0
        for k, (_, at) in enumerate(self.texts):
            for lo in range(0, max(1, len(at) - AHEAD), SLICE_WORDS):  # a segment starts filters at SLICE_WORDS words at most
                if held and (size >= SLICE_WORDS or held[-1][0] == k):  # one segment of a text at a time
                    self._pool(held, best, window, p)
                    held, size = [], 0
                final = lo + SLICE_WORDS >= len(at) - AHEAD
                held.append((k, at[lo:] if final else at[lo:lo + SLICE_WORDS + AHEAD], final))
                size += len(held[-1][1])
        self._pool(held, best, window, p)
        y = np.array(self.labels)
        pooled = best + np.concatenate([p[f"b{w}"] for w in FILTERS])
        h = np.maximum(pooled, 0)
        g = (1 / (1 + np.exp(-np.clip(h @ p["out"] + p["const"], -30, 30))) - y) * np.where(y == 1, self.weights[1], self.weights[0]) / b
        back = g[:, None] * p["out"] * (pooled > 0)
        flat_grad = np.zeros(N_DENSE)
        grad, touched, pulls, lo = _parameters(flat_grad), [], [], 0
        grad["out"][:], grad["const"][0] = h.T @ g, g.sum()
        for w, n in FILTERS.items():
            own = back[:, lo:lo + n]
            grad[f"b{w}"][:] = own.sum(axis=0)
            for j in range(w):
                feats = window[:, lo:lo + n, j]
                grad[f"f{w}"][j] = np.einsum("bnd,bn->dn", self.emb[feats].sum(axis=2), own)
                touched.append(feats.ravel())
                pulls.append(np.repeat((own[:, :, None] * p[f"f{w}"][j].T).reshape(-1, DIM), 1 + len(HEADS), axis=0))
            lo += n
        rows, which = np.unique(np.concatenate(touched), return_inverse=True)
        pulls = np.concatenate(pulls)
        total = np.stack([np.bincount(which, pulls[:, d], len(rows)) for d in range(DIM)], axis=1)
        flat, m, v = (self.flat[k * N_DENSE:(k + 1) * N_DENSE] for k in range(3))
        self.flat[3 * N_DENSE] += 1
        t = self.flat[3 * N_DENSE]
        flat_grad += 1e-4 * flat
        m[:] = 0.9 * m + 0.1 * flat_grad
        v[:] = np.sqrt(0.999 * v ** 2 + 0.001 * flat_grad ** 2)
        flat -= 0.01 * (m / (1 - 0.9 ** t)) / (v / np.sqrt(1 - 0.999 ** t) + 1e-8)
        self.square[rows] += (total ** 2).mean(axis=1)
        self.emb[rows] -= 0.02 * total / np.sqrt(self.square[rows])[:, None]
        self.emb[0] = 0
        self.touched[rows] = True
        self.texts, self.labels, self.size = [], [], 0

    def moved(self) -> pa.RecordBatch:
        """What the steps changed, as whole multiples of 1 / SCALE: sums do not depend on their order."""
        self.step()
        keys = np.concatenate([np.flatnonzero(self.touched), np.arange(BUCKETS, BUCKETS + DENSE_ROWS)])
        move = np.rint((self.state[keys] - self.before[keys]) * SCALE).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.ones(len(keys), np.int64)), *map(pa.array, move.T)], names=MOVED)


PAD = np.zeros(1, KEY)
WRITTEN = ["doc_id", "y", "text", "part", "share", "hold", "keys", "at"]
MOVED = ["key", "n", *(f"d{k}" for k in range(DIM + 1))]


def _calibrate(model: Model, held: np.ndarray) -> Model:
    """Thresholds from the counts of calibration texts by (language or none, label, bin of probability)."""
    for k, name in enumerate([*LANGUAGES, ""]):
        own = held[k] if name else held.sum(axis=0)
        if not name or own[1].sum() >= MIN_POSITIVES:
            model.thresholds[name] = _best_threshold(own)
    return model


def _bins(model: Model, scorer: Scorer, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(place among the languages or none, bin of probability) of each text."""
    pooled, counts = scorer.pooled(texts)
    p = model.probability(pooled)
    lang = np.where(counts.max(axis=1) > 0, counts.argmax(axis=1), len(LANGUAGES))
    return lang, np.minimum((p * BINS).astype(np.int64), BINS - 1)


def _weights(n: tuple[int, int]) -> tuple[float, float]:
    return tuple(min(MAX_WEIGHT, sum(n) / (2 * max(k, 1))) for k in n)


def train(texts: list[bytes], labels: list[int], seed: int = 7, epochs: int = EPOCHS) -> Model:
    """The training on one machine, of texts at hand: every text trains or, a quarter, calibrates."""
    y = np.array(labels, int)
    if not len(y) or y.min() == y.max():
        return _without_classes()
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    hold = np.zeros(len(y), bool)
    for k in (0, 1):  # a quarter of each class calibrates
        own = order[y[order] == k]
        hold[own[: len(own) // 4]] = True
    fit_on, known, seen = np.flatnonzero(~hold), Features(), np.zeros((2, BUCKETS), np.int64)
    encoded = {i: known.encode(texts[i]) for i in fit_on}
    for i, (keys, _) in encoded.items():
        _count(seen[y[i]], keys)
    n = tuple(np.bincount(y[fit_on], minlength=2).tolist())
    state = start_state(seen, n, seed)
    for _ in range(epochs):
        trainer = Trainer(state, _weights(n), known)
        for i in rng.permutation(fit_on):
            trainer.add_words(*encoded[i], y[i])
        trainer.step()
        state = trainer.state
    model, at, held = to_model(state), np.flatnonzero(hold), np.zeros((len(LANGUAGES) + 1, 2, BINS), np.int64)
    if len(at):
        lang, bins = _bins(model, Scorer(model), [texts[i] for i in at])
        np.add.at(held, (lang, y[at], bins), 1)
    return _calibrate(model, held)


def _best_threshold(counts: np.ndarray) -> float:
    """Middle of the widest stretch of probabilities with the best F1, from (label, bin) counts."""
    used = np.flatnonzero(counts.sum(axis=0))
    at = np.unique(np.concatenate([[0.02, 0.98], (used + 0.5) / BINS]))
    mid = (at[1:] + at[:-1]) / 2
    above = lambda c: c.sum() - np.concatenate([[0], np.cumsum(c)])[np.searchsorted((np.arange(BINS) + 0.5) / BINS, mid)]
    f1 = 2 * above(counts[1]) / np.maximum(1, above(counts[0]) + above(counts[1]) + counts[1].sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(np.clip(mid[best[np.argmax((at[1:] - at[:-1])[best])]], 0.02, 0.98))


def in_test_fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, part: int = PART) -> DataFrame:
    """(doc_id, y, text, part, share, hold) of every row with a label, less the test fold. Parts hold the
    rows of about ``part`` labels and are dealt by the hash that the join shuffles by: texts move once."""
    known = (labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("y"))
             .filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & ~in_test_fold("_id"))
             .groupBy("_id").agg(F.max("y").cast("int").alias("y")))
    parts = max(1, -(-known.count() // part))
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
             .filter(F.col("doc_id").isNotNull() & ~in_test_fold("doc_id")))
    both = texts.repartition(parts, "doc_id").join(known.repartition(parts, "_id"), F.col("doc_id") == F.col("_id"))
    place = F.pmod(F.hash("doc_id"), F.lit(parts))
    return both.select("doc_id", "y", "text", place.alias("part"), F.pmod(place, F.lit(min(parts, ROUNDS))).alias("share"),
                       (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).cast("int").alias("hold"))


def _encode(batches):
    """Rows that train with their words' keys and places instead of the text; the others as they are."""
    known = Features()
    for batch in sliced(batches, 2):
        names = batch.schema.names
        keys, at, texts = [], [], []
        for hold, text in zip(*(batch.column(names.index(c)).to_pylist() for c in ("hold", "text"))):
            k, a = (None, None) if hold else (x.tobytes() for x in known.encode(text))
            keys.append(k)
            at.append(a)
            texts.append(text if hold else None)
        own = {"keys": pa.array(keys, pa.binary()), "at": pa.array(at, pa.binary()), "text": pa.array(texts, pa.binary())}
        yield pa.RecordBatch.from_arrays([own[c] if c in own else batch.column(names.index(c)) for c in WRITTEN], names=WRITTEN)


def _stored(keys: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(keys, KEY)
    return keys, np.frombuffer(at, _places(len(keys)))


def _count_buckets(batches, keys=None):
    """Texts by (label, bucket), and by label under bucket -1. ``keys`` reads the second column, which
    holds texts if it is not given."""
    known, seen, n = Features(), np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
    keys = keys or (lambda text: known.encode(text)[0])
    for batch in sliced(batches):
        for y, value in zip(*(c.to_pylist() for c in batch.columns)):
            _count(seen[y], keys(value))
            n[y] += 1
    y, key = np.nonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[0, 1], y])), pa.array(np.concatenate([[-1, -1], key])),
                                      pa.array(np.concatenate([n, seen[y, key]]))], names=["y", "key", "n"])


def _round(state, weights):
    """Each part's rows train a copy of the state; the changes of all parts are averaged after."""
    def run(batches):
        trainer, at = None, None
        for batch in sliced(batches, 2):
            for part, y, keys, places in zip(*(c.to_pylist() for c in batch.columns)):
                if part != at:
                    if trainer:
                        yield trainer.moved()
                    trainer, at = Trainer(state.value, weights), part
                trainer.add_words(*_stored(keys, places), y)
        if trainer:
            yield trainer.moved()
    return run


def _hold_bins(model):
    def run(batches):
        scorer, held = Scorer(model.value), np.zeros((len(LANGUAGES) + 1, 2, BINS), np.int64)
        for batch in sliced(batches):
            lang, bins = _bins(model.value, scorer, batch.column(1).to_pylist())
            np.add.at(held, (lang, batch.column(0).to_numpy(), bins), 1)
        lang, y, k = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lang, y, k, held[lang, y, k])], names=["lang", "y", "bin", "n"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        part: int = PART) -> Model:
    """Learn from every labelled row outside the test fold: three quarters train, each ``EPOCHS`` times, one
    calibrates. What comes to the driver is bounded by the model and the bins, not by the rows."""
    spark = docs.sparkSession
    rows = _labelled(docs, labels, id_col, text_col, label_col, part)
    folder = new_table_path(spark, "training")
    kinds = "doc_id long, y int, text binary, part int, share int, hold int, keys binary, at binary"
    (rows.mapInArrow(_encode, kinds)
     .sortWithinPartitions("share", "hold", "part", F.xxhash64("doc_id", F.lit("order")), "doc_id", "y", "keys", "at", "text").drop("doc_id")
     .write.option("compression", "zstd").partitionBy("share", "hold").parquet(folder))
    table = spark.read.schema(kinds).parquet(folder)
    train_rows, held_rows = table.filter("hold = 0"), table.filter("hold = 1").select("y", "text")
    counted = (train_rows.select("y", "keys").mapInArrow(lambda batches: _count_buckets(batches, lambda x: np.frombuffer(x, KEY)), "y long, key long, n long")
               .groupBy("y", "key").agg(F.sum("n").alias("n")).toArrow())
    y, key, n = (counted.column(c).to_numpy() for c in ("y", "key", "n"))
    seen, total = np.zeros((2, BUCKETS), np.int64), [0, 0]
    seen[y[key >= 0], key[key >= 0]] = n[key >= 0]
    for k in (0, 1):
        total[k] = int(n[(key < 0) & (y == k)].sum())
    if not min(total):
        drop_path(spark, folder)
        return _without_classes()
    state, weights = start_state(seen, tuple(total)), _weights(tuple(total))
    shares = sorted(r["share"] for r in train_rows.select("share").distinct().collect())  # ROUNDS at most
    for share in shares * EPOCHS:
        sent = spark.sparkContext.broadcast(state)
        dealt = train_rows.filter(F.col("share") == share).select("part", "y", "keys", "at")
        moved = dealt.mapInArrow(_round(sent, weights), ", ".join(f"{c} long" for c in MOVED)).groupBy("key").agg(
            *[F.sum(c).alias(c) for c in MOVED[1:]]).toArrow()
        keys, times = moved.column("key").to_numpy(), moved.column("n").to_numpy()
        state = state.copy()
        for k, c in enumerate(MOVED[2:]):
            state[keys, k] += moved.column(c).to_numpy() / times / SCALE
        sent.destroy()
    model = to_model(state)
    sent = spark.sparkContext.broadcast(model)
    binned = (held_rows.mapInArrow(_hold_bins(sent), "lang long, y long, bin long, n long")
              .groupBy("lang", "y", "bin").agg(F.sum("n").alias("n")).toArrow())
    sent.destroy()
    drop_path(spark, folder)
    held = np.zeros((len(LANGUAGES) + 1, 2, BINS), np.int64)
    held[tuple(binned.column(c).to_numpy() for c in ("lang", "y", "bin"))] = binned.column("n").to_numpy()
    return _calibrate(model, held)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in sliced(batches):
            pooled, counts = scorer.pooled([t or b"" for t in batch.column(1).to_pylist()])
            s = scorer.model.score(scorer.model.probability(pooled), _language(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, all columns as they are, whose score stays below 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in sliced(batches, at):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            pooled, counts = scorer.pooled([t or b"" for t in texts])
            s = scorer.model.score(scorer.model.probability(pooled), _language(counts))
            yield batch.filter(pa.array(s < 0.5))
    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return (score(docs, fit(docs, labels))
            .select("doc_id", F.coalesce(in_test_fold("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted"))
