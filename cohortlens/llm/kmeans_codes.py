"""Operator 13: vector code compression by member-resident Lloyd.

A vector is cut into ``PARTS`` equal parts; each part is coded by the nearest entry of its position's
codebook, and the codebooks are improved by rounds of Lloyd's method.

    Residents  Part members live in a table in the shared folder, dealt out by (position, entry, salt),
               the owner. A row is a block: the members one run of ``HOME`` vectors (their home) has
               with one entry, as offsets in the home and their integer components. The salt is a hash
               of the home; there are as many salts as keep an owner below ``OWNER_MEMBERS`` members
               even if all parts of a position have one entry.
    Update     A round's entries come from the members where they live: each task sums its residents,
               one row a (position, entry, component) of a task goes through the aggregate, and the new
               codebooks, whose size is parts x entries x width, are given to all tasks.
    Migrate    Residents whose nearest entry has changed, and only those, go through the next shuffle to
               their new owner and form the round's generation of the table. The others stay in the
               files they are in. A generation's member is where it is for as long as its nearest entry
               has stayed the same under every codebook since, so departures need no rewriting.
    Gather     After the last update the owners assign their members again and send entry and squared
               distance back to the home, where codes and errors of at most ``HOME`` vectors meet.

Arithmetic is in integers throughout, so results do not depend on layout or order.

Defined results: vectors that are null, or hold a null, NaN or infinite component, have no row; the
first codebooks are the vectors of least id (null ids last, equal ids by vector), so repeated rows seed
and count each; with fewer vectors there are fewer entries; vectors shorter than the longest one, and a
length that the parts do not divide, are filled with zeros; components beyond +-2^29 / 256 count as that
bound (their squares would not fit 64 bits); null labels are one label; an empty table gives no rows;
extra columns are ignored, labels and ids are carried through.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import shuffle_partitions, via_table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
HOME = 8192                  # vectors whose codes meet in one group
OWNER_MEMBERS = 4_000_000
BOUND = 1 << 29
SCALE = 256

MEMBERS = "home long, position int, entry int, salt int, at array<int>, parts array<int>"


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, vec (integers) of the rows that are kept."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    scaled = F.transform(x, lambda v: F.floor(F.least(F.greatest(v.cast("double") * SCALE, F.lit(-float(BOUND))), F.lit(float(BOUND)))).cast("int"))
    return (rows.filter(x.isNotNull() & finite)
            .select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), scaled.alias("vec")))


def nearest(members: np.ndarray, book: np.ndarray, rows: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower one) and its squared distance, in int64."""
    entry, error = np.zeros(len(members), np.int64), np.zeros(len(members), np.int64)
    for lo in range(0, len(members), rows):
        part = members[lo:lo + rows].astype(np.int64)
        apart = np.zeros((len(part), len(book)), np.int64)
        for d in range(book.shape[1]):
            step = part[:, d, None] - book[:, d]
            apart += step * step
        entry[lo:lo + rows] = best = apart.argmin(axis=1)
        error[lo:lo + rows] = apart[np.arange(len(part)), best]
    return entry, error


def _fill(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """list<int> column -> rows x width, shorter rows filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == len(column) * width:
        return flat.reshape(len(column), width)
    return _fill(column.to_pylist(), width)


def _blocks(home: np.ndarray, at: np.ndarray, position: int, entry: np.ndarray, parts: np.ndarray, salts: int):
    """Member blocks of one position, one a (home, entry)."""
    order = np.lexsort((at, entry, home))
    home, at, entry, parts = home[order], at[order], entry[order], parts[order]
    cut = np.flatnonzero(np.concatenate([[True], (home[1:] != home[:-1]) | (entry[1:] != entry[:-1])])) if len(home) else np.zeros(0, np.int64)
    width = parts.shape[1]
    stops = np.concatenate([cut, [len(home)]]).astype(np.int32)
    salt = (home[cut] * 0x9E3779B1 >> 7) % salts
    return pa.RecordBatch.from_arrays(
        [pa.array(home[cut], pa.int64()), pa.array(np.full(len(cut), position, np.int32)), pa.array(entry[cut].astype(np.int32)), pa.array(salt.astype(np.int32)),
         pa.ListArray.from_arrays(stops, pa.array(at.astype(np.int32))),
         pa.ListArray.from_arrays(stops * np.int32(width), pa.array(parts.ravel().astype(np.int32)))],
        names=[c.split()[0] for c in MEMBERS.split(", ")])


def _first_blocks(books: np.ndarray, width: int, salts: int):
    """(home, at, vec) -> member blocks under the first codebooks."""
    def run(batches):
        parts = len(books)
        for batch in batches:
            home, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vectors = _matrix(batch.column(2), parts * width).reshape(len(home), parts, width)
            for p in range(parts):
                yield _blocks(home, at, p, nearest(vectors[:, p], books[p])[0], vectors[:, p], salts)
    return run


class Residents:
    """Member blocks of a batch, opened: one row a member."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        c = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
        sizes = np.diff(c["at"].offsets.to_numpy())
        self.at = c["at"].flatten().to_numpy()
        self.parts = c["parts"].flatten().to_numpy().reshape(len(self.at), width)
        self.home, self.position, self.entry = (np.repeat(c[n].to_numpy(), sizes) for n in ("home", "position", "entry"))

    def keep(self, which: np.ndarray) -> "Residents":
        for name in ("at", "parts", "home", "position", "entry"):
            setattr(self, name, getattr(self, name)[which])
        return self

    def nearest(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entry, error = np.zeros(len(self.at), np.int64), np.zeros(len(self.at), np.int64)
        for p in np.unique(self.position):
            own = np.flatnonzero(self.position == p)
            entry[own], error[own] = nearest(self.parts[own], books[p])
        return entry, error

    def still_here(self, since: list[np.ndarray]) -> "Residents":
        """Members that no codebook since their generation has sent elsewhere."""
        for books in since:
            self.keep(self.nearest(books)[0] == self.entry)
        return self


def _sums(books: np.ndarray, since: list[np.ndarray]):
    """Resident blocks -> (position, entry, component, members, total), one row each a task."""
    def run(batches):
        parts, entries, width = books.shape
        count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            r = Residents(batch, width).still_here(since)
            np.add.at(count, (r.position, r.entry), 1)
            np.add.at(total, (r.position, r.entry), r.parts)
        position, entry = np.nonzero(count)
        for d in range(width):
            yield pa.RecordBatch.from_arrays(
                [pa.array(position.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(np.full(len(entry), d, np.int32)),
                 pa.array(count[position, entry]), pa.array(total[position, entry, d])],
                names=["position", "entry", "component", "members", "total"])
    return run


def _movers(books: np.ndarray, since: list[np.ndarray], salts: int):
    """Resident blocks -> blocks of the members whose nearest entry is now another."""
    def run(batches):
        for batch in batches:
            r = Residents(batch, books.shape[2]).still_here(since)
            entry, _ = r.nearest(books)
            gone = entry != r.entry
            r.keep(gone)
            entry = entry[gone]
            for p in np.unique(r.position):
                own = r.position == p
                yield _blocks(r.home[own], r.at[own], int(p), entry[own], r.parts[own], salts)
    return run


def _reports(books: np.ndarray, since: list[np.ndarray]):
    """Resident blocks -> (home, position, at, entry, error) of the last assignment, lists a home."""
    def run(batches):
        for batch in batches:
            r = Residents(batch, books.shape[2]).still_here(since)
            entry, error = r.nearest(books)
            order = np.lexsort((r.position, r.home))
            home, position = r.home[order], r.position[order]
            cut = np.flatnonzero(np.concatenate([[True], (home[1:] != home[:-1]) | (position[1:] != position[:-1])])) if len(home) else np.zeros(0, np.int64)
            stops = np.concatenate([cut, [len(home)]]).astype(np.int32)
            lists = (r.at[order].astype(np.int32), entry[order].astype(np.int32), error[order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(home[cut], pa.int64()), pa.array(position[cut].astype(np.int32))] + [pa.ListArray.from_arrays(stops, pa.array(x)) for x in lists],
                names=["home", "position", "at", "entry", "error"])
    return run


def _gather(parts: int, schema: pa.Schema):
    """A home's vectors and its owners' reports -> code and error of each vector."""
    def run(_, vectors: pa.Table, reports: pa.Table) -> pa.Table:
        at = vectors.column("at").to_numpy()
        codes, errors = np.zeros((HOME, parts), np.int64), np.zeros(HOME, np.int64)
        for row in zip(*(reports.column(c) for c in ("position", "at", "entry", "error"))):
            position, where, entry, error = row[0].as_py(), *(x.values.to_numpy() for x in row[1:])
            codes[where, position] = entry
            errors[where] += error
        digits = [f"{k:02x}" for k in range(int(codes.max(initial=0)) + 1)]
        text = ["".join(map(digits.__getitem__, row)) for row in codes[at].tolist()]
        return pa.table([vectors.column("vec_id"), vectors.column("label"), pa.array(text, pa.string()), pa.array(errors[at], pa.int64())], schema=schema)
    return run


def _dealt(blocks: DataFrame, name: str) -> DataFrame:
    """A generation: blocks shuffled to their owners and written."""
    return via_table(blocks.repartition(shuffle_partitions(blocks.sparkSession), "position", "entry", "salt"), name)


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    spark = rows.sparkSession
    uid = F.monotonically_increasing_id()  # fixed once written; a partition's ids start at a multiple of HOME
    vectors = via_table(integer_vectors(rows, id_col, vector_col, label_col)
                        .withColumns({"home": F.floor(uid / HOME).cast("long"), "at": F.pmod(uid, F.lit(HOME)).cast("int")}), "code-vectors")
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("longest")).first()
    width = -(-size.longest // parts)
    salts = -(-size.n // OWNER_MEMBERS) or 1
    # bounded: ``entries`` vectors
    seeds = vectors.select("vec_id", "vec").orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    books = _fill([r.vec for r in seeds], parts * width).reshape(len(seeds), parts, width).transpose(1, 0, 2)

    first = vectors.select("home", "at", "vec").mapInArrow(_first_blocks(books, width, salts), MEMBERS)
    generations, history = [_dealt(first, "residents-0")], []
    for k in range(1, rounds + 1):
        here = [g.mapInArrow(_sums(books, history[i:]), "position int, entry int, component int, members long, total long")
                for i, g in enumerate(generations)]
        sums = functools.reduce(DataFrame.unionByName, here).groupBy("position", "entry", "component").agg(F.sum("members").alias("members"), F.sum("total").alias("total"))
        books = books.copy()
        for r in sums.collect():  # at most parts x entries x width rows
            books[r.position, r.entry, r.component] = r.total // r.members
        if k < rounds:
            moved = [g.mapInArrow(_movers(books, history[i:], salts), MEMBERS) for i, g in enumerate(generations)]
            generations.append(_dealt(functools.reduce(DataFrame.unionByName, moved), f"residents-{k}"))
            history.append(books)
    reports = functools.reduce(DataFrame.unionByName, [g.mapInArrow(_reports(books, history[i:]), "home long, position int, at array<int>, entry array<int>, error array<long>")
                               for i, g in enumerate(generations)])
    types = {f.name: f.dataType.simpleString() for f in vectors.schema}
    named = vectors.select("home", "at", "vec_id", "label")
    out_schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    arrow = _arrow_schema(spark, out_schema)
    coded = via_table(named.groupBy("home").cogroup(reports.groupBy("home")).applyInArrow(_gather(parts, arrow), out_schema), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
