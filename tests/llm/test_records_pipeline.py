"""Operator 1, the registered queries' SQL, and the pipeline against brute force."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from cohortlens.llm import toxicity, warc_revisits
from cohortlens.llm.common import keep_rows
from cohortlens.sources.tables import DRIVER_TABLES
from tests.conftest import SF001
from tests.llm.conftest import DOCS, docs_rows, words
from tests.llm.test_dedup import near_brute
from tests.llm.test_text import measures_brute
from tests.test_entry import _norm

RECORD = "record_id long, kind string, url string, ts long, etag string, last_modified string, headers map<string,string>, payload_sha256 string"


@pytest.mark.parametrize("url,want", [
    ("http://Www.Example.com:80/a/?b=1&utm_x=2#f", "example.com/a?b=1"), ("https://example.com", "example.com"),
    ("example.com/a?ref=x", "example.com/a"), ("https://e.com:443/A?x=1&ref=2&y=3", "e.com/A?x=1&y=3"), ("", "")])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(warc_revisits.canonical_url(F.col("url"))).first()[0] == want


def records():
    h = {"etag": '"1"', "server": "o", "date": "1"}
    return [
        (1, "response", "http://a.com/x", 10, '"1"', "m", h, "p1"), (2, "response", "https://www.a.com/x#f", 20, '"2"', "n", None, "p2"),
        (3, "revisit", "http://a.com/x/", 15, '"1"', None, {"date": "15", "server": "edge", "set-cookie": "c"}, None),
        (4, "revisit", "http://a.com/x", 25, 'W/"2"', None, None, None), (5, "revisit", "http://a.com/x", 25, '"1"', None, h, None),
        (6, "revisit", "http://a.com/x", 10, '"1"', None, h, None),          # same time: not earlier
        (7, "revisit", "http://a.com/x", 9_000_000, None, "n", {}, None), (8, "revisit", "http://a.com/x", 30, None, None, h, None),
        (9, "revisit", "http://b.com/", 30, '"1"', None, h, None), (10, "revisit", None, 30, '"1"', None, h, None),
        (11, "revisit", "http://a.com/x", None, '"1"', None, h, None), (11, "revisit", "http://a.com/x", None, '"1"', None, h, None),
        (12, "response", "http://c.com", 5, '"5"', None, h, "p12"), (13, "response", "http://c.com", 5, '"6"', None, h, "p13"),
        (14, "revisit", "http://c.com", 6, '"6"', None, None, None), (15, None, "http://c.com", 6, '"6"', None, None, None),
    ]


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_revisits(spark, buckets):
    df = spark.createDataFrame(records(), RECORD).withColumn("bucket", F.lit("clash"))
    got = {(r.record_id, r.ts): r for r in warc_revisits.resolve_revisits(df, buckets).collect()}
    status = {k[0]: (r.status, r.refers_to) for k, r in got.items()}
    assert status == {3: ("resolved", 1), 4: ("resolved", 2), 5: ("validator_mismatch", None), 6: ("no_earlier_response", None),
                      7: ("resolved", 2), 8: ("no_validator", None), 9: ("no_earlier_response", None),
                      10: ("no_earlier_response", None), 11: ("no_earlier_response", None), 14: ("resolved", 13)}
    assert got[3, 15].headers == {"etag": '"1"', "server": "o", "date": "15"} and got[3, 15].payload_sha256 == "p1"
    assert warc_revisits.resolve_revisits(df, buckets).count() == 11  # the repeated record is answered twice
    assert warc_revisits.resolve_revisits(df.limit(0)).count() == 0


def test_a_burst_of_one_url_is_split(spark):
    """A URL with most records, all of one moment or repeated: buckets of like size, right answers."""
    h = {"etag": '"1"'}
    rows = [(1, "response", "http://a.com/x", 10, '"1"', None, h, "p1")]
    rows += [(k, "revisit", "http://a.com/x", 20, '"1"', None, h, None) for k in range(2, 1202)]
    rows += [(5000, "revisit", "http://a.com/x", 30, '"2"', None, h, None)] * 800
    rows += [(5001, "response", "http://a.com/x", 30, '"2"', None, h, "p2"), (5002, "revisit", "http://a.com/x", 31, '"2"', None, h, None)]
    rows += [(6000 + k, "revisit", f"http://b.com/{k}", 20, '"1"', None, h, None) for k in range(100)]
    df = spark.createDataFrame(rows, RECORD)
    cut = warc_revisits.bucketed(df.select("record_id", (F.col("kind") == "response").alias("full"),
                                           warc_revisits.canonical_url(F.col("url")).alias("canonical_url"), "ts"), 16)
    sizes = [r["count"] for r in cut.groupBy("canonical_url", "bucket").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 3 * len(rows) / 16
    got = [(r.record_id, r.status, r.refers_to) for r in warc_revisits.resolve_revisits(df, 16).collect()]
    want = [(k, "resolved", 1) for k in range(2, 1202)] + [(5000, "validator_mismatch", None)] * 800 + [(5002, "resolved", 5001)]
    assert sorted(got, key=str) == sorted(want + [(6000 + k, "no_earlier_response", None) for k in range(100)], key=str)


def test_header_names_ignore_case(spark):
    df = spark.createDataFrame([
        (1, "response", "u.com", 1, '"1"', None, {"ETag": '"1"', "Date": "a", "Server": "o", "date": "b"}, "p"),
        (2, "revisit", "u.com", 2, '"1"', None, {"DATE": "c", "ETAG": '"1"', "Set-Cookie": "x", "date": "d"}, None)], RECORD)
    assert warc_revisits.resolve_revisits(df).first().headers == {"etag": '"1"', "date": "d", "server": "o"}


@pytest.mark.parametrize("name", sorted(E.LLM_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    cur = con.execute(E.LLM_SQL[name])
    cols = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted(tuple(_norm(r[k]) for k in at) for r in cur.fetchall())
    df = E.queries()[name](spark, SF001)
    assert sorted(df.columns) == cols
    assert sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect()) == want


def test_every_operator_is_registered():
    names = list(E.LLM_QUERIES)
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_stages_against_brute_force(spark, awkward, empty_docs):
    stages = dict(corpus_pipeline.STAGES)
    rows = docs_rows()
    kept = stages["quality_rules"](spark, awkward, SF001)
    ok = [r for r in rows if (m := measures_brute(r[1]))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    assert kept.schema == awkward.schema and sorted(map(tuple, kept.collect()), key=str) == sorted(ok, key=str)
    once = stages["exact_dedup"](spark, awkward, SF001)
    last = {}
    for r in rows:
        k = r[1] or ""
        if k not in last or (r[0] or -1) >= (last[k][0] or -1):
            last[k] = r
    assert sorted(r.doc_id or -1 for r in once.collect()) == sorted(r[0] or -1 for r in last.values())
    near = stages["near_dedup"](spark, once, SF001)
    brute = near_brute([tuple(r) for r in once.collect()])
    assert sorted(str(r.doc_id) for r in near.collect()) == sorted(str(r[0]) for r in brute if r[3])
    assert {r.doc_id for r in stages["packing"](spark, near, SF001).collect()} == {r.doc_id for r in near.collect()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_docs, SF001).count() == 0


def test_pipeline_runs_all_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = corpus_pipeline.run(spark, SF001)
    step = docs
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SF001)
    assert sorted(map(tuple, out.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, step.select("doc_id", "piece", "ids_crc32").collect()))
    assert 0 < out.select("doc_id").distinct().count() < docs.count()


def test_keep_rows_keeps_null_ids(awkward):
    assert keep_rows(awkward, awkward.filter("doc_id is null or doc_id = 1")).count() == 2


def test_stages_decide_on_rows_that_repeat_an_id(spark):
    stages = dict(corpus_pipeline.STAGES)
    good, other, third = (words(80, s) for s in (21, 22, 23))
    rows = [(None, good, "en", "h", 0), (None, "short", "en", "h", 1), (4, other, "en", "h", 2), (4, "a b c\n" * 200, "en", "h", 3)]
    kept = stages["quality_rules"](spark, spark.createDataFrame(rows, DOCS), SF001)
    assert sorted(r.n_chars for r in kept.collect()) == [0, 2]
    rows = [(None, good, "en", "h", 0), (None, other, "en", "h", 1), (7, good, "en", "h", 2),  # other alone has a null id only
            (8, third, "en", "h", 3), (8, words(80, 24), "en", "h", 4), (9, third, "en", "h", 5),
            (None, good, "en", "h", 6), (3, None, "en", "h", 7), (3, "", "en", "h", 7)]
    once = stages["exact_dedup"](spark, spark.createDataFrame(rows, DOCS), SF001)
    assert sorted(r.n_chars for r in once.collect()) == [1, 2, 4, 5, 7]


def test_a_rejected_host_takes_only_its_own_rows(spark):
    good = words(80)
    rows = [(i, "short", "en", "bad", 0) for i in range(100)] + [(1000 + i, words(80, i), "en", f"h{i % 20}", 1) for i in range(400)]
    rows += [(None, good, "en", "bad", 0), (None, good, "en", "h1", 1), (None, good, "en", None, 1)]
    kept = corpus_pipeline.drop_low_quality(spark, spark.createDataFrame(rows, DOCS), SF001)
    assert sorted(r.n_chars for r in kept.collect()) == [1] * 402


def test_toxic_documents_go_and_clean_ones_stay(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    left = corpus_pipeline.drop_toxic(spark, docs, SF001)
    seen = toxicity.score(docs, toxicity.fit(docs, labels)).filter("predicted = 0")
    assert left.count() == seen.count()
