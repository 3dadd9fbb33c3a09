"""Operator 10: quality rules on documents and on the hosts they come from.

Every document is measured once in an Arrow stage (whole text, nothing kept between
documents); the narrow measures are written to the shared folder. Rule failures are then
counted per host by a partial and final aggregate, so a host with a third of all rows is
no hot task. A host's failure rate is shrunk towards the corpus rate with a beta prior
whose strength is fitted by the method of moments over all hosts, and hosts whose shrunk
rate exceeds ``max_host_rate`` lose their remaining documents through a join.

    m = failures / documents                     (all hosts)
    v = sum n (x/n - m)^2 / N  -  m (1 - m) H / N  (variance between hosts beyond sampling)
    k = m (1 - m) / v - 1, at least 1; without spread (v <= 0) k = N
    shrunk rate = (x + m k) / (n + k)

Defined results: a null text has no words and fails the base rule; a null host counts as
one host named ''; repeated rows count each; an empty table gives no rows; extra columns
are ignored; a rate equal to the threshold is kept.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import keep_rows, sliced, text_digest, via_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SALTS = 32  # parts of a host's rows in the join with the verdicts
MAX_HOST_RATE = 0.8
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more; hashes find candidates, words decide."""
    n = len(words) - 2
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    code = h[:-2] * _MIX[0] + h[1:-1] * _MIX[1] + h[2:] * _MIX[2]
    ordered = np.sort(code)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(code, again)).tolist()
    windows = [(words[i], words[i + 1], words[i + 2]) for i in at]
    seen = Counter(windows)
    covered = np.zeros(len(words), bool)
    for i, w in zip(at, windows):
        if seen[w] > 1:
            covered[i:i + 3] = True
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    spaces = len(text) - sum(map(len, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(text.decode()) - spaces, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def _measures(batches):
    for batch in sliced(batches):
        rows = [measure(t or b"") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
            + [batch.column(k) for k in range(2, batch.num_columns)],
            names=["doc_id", *MEASURES, *batch.schema.names[2:]])


def document_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                      digest: bool = False) -> DataFrame:
    """doc_id, the five measures, host, base_failed and rule_failed (base or a further rule); with
    ``digest`` also text_sha256."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        *([text_digest(text_col).alias("text_sha256")] if digest else []))
    out = rows.mapInArrow(_measures, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", host string"
                          + (", text_sha256 string" if digest else ""))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumns({"base_failed": base,
                            "rule_failed": base | (10 * F.col("n_symbols") > F.col("word_chars"))})


def host_rates(measures: DataFrame) -> DataFrame:
    """host, n, x, shrunk rate: the empirical beta prior is fitted over all hosts."""
    hosts = measures.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("rule_failed"), 1)).alias("x"))
    total = hosts.agg((F.sum("x") / F.sum("n")).alias("m"), F.sum("n").cast("double").alias("N"),
                      F.count(F.lit(1)).alias("H"), F.sum(F.col("x") * F.col("x") / F.col("n")).alias("s2"))
    # sum n (x/n - m)^2 = sum x^2/n - N m^2
    v = (F.col("s2") - F.col("N") * F.col("m") * F.col("m")) / F.col("N") - F.col("m") * (1 - F.col("m")) * F.col("H") / F.col("N")
    prior = total.withColumn("v", v).select(F.struct(
        "m", F.when(F.col("v") > 0, F.greatest(F.lit(1.0), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))
        .otherwise(F.col("N")).alias("k")).alias("p")).scalar()
    return hosts.withColumn("p", prior).select(
        "host", "n", "x", ((F.col("x") + F.col("p.m") * F.col("p.k")) / (F.col("n") + F.col("p.k"))).alias("rate"))


def _verdicts(table: DataFrame, max_host_rate: float) -> DataFrame:
    """The measures with host_rejected: true or null. A host's rows are dealt over ``SALTS`` tasks;
    of the other side, rejected hosts alone, each has a row for every salt."""
    bad = (host_rates(table).filter(F.col("rate") > max_host_rate)
           .select("host", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("host_rejected")))
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    return table.withColumn("salt", salt).join(bad, ["host", "salt"], "left").drop("salt")


def apply_host_rules(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE, id_col: str = "doc_id",
                     text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: the measures, base_failed, and kept (base and host verdict)."""
    table = _verdicts(via_table(document_measures(docs, id_col, text_col, host_col), "host-measures"), max_host_rate)
    rejected = F.col("host_rejected").isNotNull()
    return table.select("doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"),
                        rejected.alias("host_rejected"))


def keep_good(docs: DataFrame, max_host_rate: float = MAX_HOST_RATE, id_col: str = "doc_id",
              text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows, all columns as they are, that pass the base rules and whose host is not rejected.
    Decisions hold for id, text and host, so rows that repeat an id, null included, pass each by itself."""
    table = via_table(document_measures(docs, id_col, text_col, host_col, digest=True), "host-measures")
    good = _verdicts(table, max_host_rate).filter(~F.col("base_failed") & F.col("host_rejected").isNull())
    return keep_rows(docs, good, id_col, text_sha256=text_digest(text_col),
                     host=F.coalesce(F.col(host_col).cast("string"), F.lit("")))
