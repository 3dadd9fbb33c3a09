"""Corpus pipeline: toxicity -> quality rules -> exact dedup -> near-duplicate dedup -> packing.

Each stage calls one operator of ``cohortlens.llm`` on all documents its predecessor kept. All
but the last return the columns of ``documents``; the last returns packed pieces. Between
stages the documents are written to the shared folder and read again, so a lost executor
costs at most one stage's tasks; a stage's own tables, and the documents it read, are deleted
once its result is written. The last stage's stay, since the result reads them: call ``run``
inside ``cohortlens.session.scratch_scope`` and write its result there to leave none.
"""

from __future__ import annotations

from cohortlens.llm import exact_dedup, host_rules, near_dup, packing, toxicity
from cohortlens.llm.common import keep_rows, load, new_table_path, text_digest
from cohortlens.session import drop_path, scratch_scope

NEAR_PERCENT = 80  # least shingle similarity of near copies in the stage
ORACLE_SQL = None  # the classifier is trained; the stages are tested against brute force


def drop_toxic(spark, docs, sf_dir):
    """Documents that the classifier, trained on the labelled part of ``docs``, does not reject."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_low_quality(spark, docs, sf_dir):
    """Documents that pass the base rules and whose host is not rejected."""
    return host_rules.keep_good(docs)


def drop_exact_copies(spark, docs, sf_dir):
    """One row of each distinct text: the one with the largest doc_id."""
    kept = keep_rows(docs, exact_dedup.exact_dedup(docs).filter("kept"), text_sha256=text_digest())
    return kept.withColumn("_digest", text_digest()).dropDuplicates(["doc_id", "_digest"]).select(docs.columns)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each near-duplicate component: the one with the least doc_id. The operator
    decides on ids, so rows go by id; null ids stay."""
    return keep_rows(docs, near_dup.near_duplicates(docs, percent=NEAR_PERCENT).filter("kept"))


def pack_sequences(spark, docs, sf_dir):
    """Pieces of the remaining documents with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs, path = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        read, path = path, new_table_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if read:
            drop_path(spark, read)
    return STAGES[-1][1](spark, docs, sf_dir)
