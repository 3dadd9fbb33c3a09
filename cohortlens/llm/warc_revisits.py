"""Operator 1: not-modified revisits resolved by an as-of join.

Records (responses and revisits) meet by canonical URL: a revisit takes the latest earlier
full response. The as-of join has two levels, so that a URL with a third of all records is
spread over many tasks, also if they all fall on one moment: a range exchange on (URL, time,
kind, id) cuts the ordered records into buckets of about equal size, which are written to the
shared folder; a window inside each (URL, bucket) carries the last response forward, and the
buckets' last responses are carried over the buckets of a URL, one row a bucket. Bodies never
move: only validators and headers do.

A revisit is resolved if its validators agree with the response's: the entity tag by weak
comparison if it has one, else Last-Modified. Headers that a not-modified answer may update
replace the response's; all others stay. Field names ignore case and come out in lower case; a
validator that a 304 updates is not carried to later revisits, which meet the full response's.

Defined results: a response at the revisit's own time is not earlier; of responses at one
time the greatest record id counts; a null URL or time matches nothing; null headers are
none; texts (URLs, headers) of any length are whole; repeated rows are records each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import shuffle_partitions, via_table

#: FIXED VALUES: header fields that a 304 answer updates in a stored response (RFC 9110, 9111)
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without end slash, no fragment,
    no tracking parameters; the scheme does not count."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(u, "^([^/?]*)", 1)), "^www[.]", ""), ":(80|443)$", "")
    rest = F.regexp_replace(u, "^[^/?]*", "")
    query = F.regexp_extract(rest, "[?](.*)$", 1)
    path = F.regexp_replace(F.regexp_replace(rest, "[?].*$", ""), "/+$", "")
    query = F.regexp_replace(query, "(^|&)(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&]*", "")
    query = F.regexp_replace(query, "^&+", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def lower_names(headers: Column) -> Column:
    """Fields by lower-case name: names ignore case; of fields that then share a name the one of
    greatest spelling stays (maps have no order)."""
    fields = F.transform(F.array_sort(F.map_entries(F.coalesce(headers, F.expr("map()").cast("map<string,string>")))),
                         lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(fields, lambda e: e["key"])
    last = F.filter(fields, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]))
    return F.map_from_entries(last)


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored fields, with those replaced that the update may change, under lower-case names."""
    allowed = F.map_filter(lower_names(update), lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(lower_names(stored), lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def bucketed(records: DataFrame, buckets: int) -> DataFrame:
    """Records in order (URL, time, responses last, id) with the bucket of each, about equally many in
    each; equal records are told apart by their place in the input, so they are split like others.
    The input is read from files, or is a frame whose tasks give the same order when run again."""
    return via_table(records.withColumn("place", F.monotonically_increasing_id())
                     .repartitionByRange(buckets, "canonical_url", "ts", "full", "record_id", "place")
                     .withColumn("bucket", F.spark_partition_id()).drop("place"), "revisit-records")


def resolve_revisits(records: DataFrame, buckets: int | None = None) -> DataFrame:
    """records (record_id, kind, url, ts, etag, last_modified, headers, payload_sha256) -> one row
    per revisit: record_id, canonical_url, ts, status, refers_to, headers, payload_sha256.
    ``buckets``: as many as shuffle partitions unless given."""
    r = records.select(
        F.col("record_id").cast("long").alias("record_id"), (F.col("kind") == "response").alias("full"),
        canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("long").alias("ts"), "etag", "last_modified",
        F.col("headers").cast("map<string,string>").alias("headers"), "payload_sha256").filter(F.col("full").isNotNull())
    lost = r.filter(~F.col("full") & (F.col("canonical_url").isNull() | F.col("ts").isNull()))
    r = bucketed(r.filter(F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()), buckets or shuffle_partitions(r.sparkSession))
    stored = F.when(F.col("full"), F.struct("record_id", "etag", "last_modified", "headers", "payload_sha256"))
    # revisits come before responses of their own time
    inside = Window.partitionBy("canonical_url", "bucket").orderBy("ts", "full", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    local = r.withColumn("found", F.last(stored, ignorenulls=True).over(inside))
    # greatest (time, id) of each bucket: a partial and final aggregate
    ends = (r.filter("full").groupBy("canonical_url", "bucket")
            .agg(F.max_by(F.struct("record_id", "etag", "last_modified", "headers", "payload_sha256"), F.struct("ts", "record_id")).alias("end")))
    marks = r.filter(~F.col("full")).select("canonical_url", "bucket").distinct().join(ends, ["canonical_url", "bucket"], "full_outer")
    over = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("carried", F.last("end", ignorenulls=True).over(over)).select("canonical_url", "bucket", "carried")
    found = (local.filter(~F.col("full")).join(carried, ["canonical_url", "bucket"], "left")
             .withColumn("found", F.coalesce("found", "carried")))
    out = found.unionByName(lost.withColumns({"bucket": F.lit(None).cast("int"), "found": F.lit(None).cast(found.schema["found"].dataType),
                                              "carried": F.lit(None).cast(found.schema["carried"].dataType)}))
    f = F.col("found")
    agrees = F.when(F.col("etag").isNotNull(), _weak(F.col("etag")) == _weak(f["etag"])).otherwise(F.col("last_modified") == f["last_modified"])
    status = (F.when(f.isNull(), "no_earlier_response")
              .when(F.col("etag").isNull() & F.col("last_modified").isNull(), "no_validator")
              .when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("validator_mismatch"))
    ok = F.col("status") == "resolved"
    return (out.withColumn("status", status)
            .select("record_id", "canonical_url", "ts", "status", F.when(ok, f["record_id"]).alias("refers_to"),
                    F.when(ok, merged_headers(f["headers"], F.col("headers"))).alias("headers"),
                    F.when(ok, f["payload_sha256"]).alias("payload_sha256")))


def crawl_records(pages: DataFrame) -> DataFrame:
    """A crawl log derived from pages: each page is fetched, and asked again some hours later
    with a validator that is right, weak, stale, only a date, or missing."""
    sha = F.sha2(F.coalesce("html", F.lit("")), 256)
    tag = F.concat(F.lit('"'), F.substring(sha, 1, 16), F.lit('"'))
    p = pages.select(F.col("page_id").alias("p"), "url", sha.alias("sha"), tag.alias("tag"),
                     (F.lit(1600000000) + (F.col("page_id") * 7919) % 10000000).alias("t")) \
        .withColumn("day", F.concat(F.lit("day "), F.floor(F.col("t") / 86400).cast("string")))
    first = p.select((F.col("p") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("t").alias("ts"),
                     F.col("tag").alias("etag"), F.col("day").alias("last_modified"),
                     F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.col("t").cast("string"),
                                  F.lit("etag"), F.col("tag"), F.lit("last-modified"), F.col("day"),
                                  F.lit("server"), F.lit("origin")).alias("headers"), F.col("sha").alias("payload_sha256"))
    again = F.col("t") + 3600 * (1 + F.col("p") % 50)
    kind = F.col("p") % 10
    etag = F.when(kind == 0, F.lit('"stale"')).when(kind.isin(1, 3), F.lit(None)).when(kind == 2, F.concat(F.lit("W/"), "tag")).otherwise(F.col("tag"))
    second = p.select((F.col("p") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", again.alias("ts"),
                      etag.alias("etag"), F.when(kind == 3, F.lit(None)).otherwise(F.col("day")).alias("last_modified"),
                      F.create_map(F.lit("date"), again.cast("string"), F.lit("cache-control"), F.lit("max-age=60"),
                                   F.lit("content-length"), F.lit("0"), F.lit("server"), F.lit("edge")).alias("headers"),
                      F.lit(None).cast("string").alias("payload_sha256"))
    return first.unionByName(second)


def revisit_table(pages: DataFrame) -> DataFrame:
    """Digest of the resolved revisits: headers as sorted name: value lines, hashed."""
    lines = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return resolve_revisits(crawl_records(pages)).select(
        "record_id", "canonical_url", "ts", "status", "refers_to", F.sha2(lines, 256).alias("headers_sha256"), "payload_sha256")
