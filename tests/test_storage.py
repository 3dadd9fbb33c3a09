"""Incremental landing, bucketed tables, content digests and sort-free permutation."""

from __future__ import annotations

import hashlib
import shutil

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import explain as X
from cohortlens.operators import groupagg as G
from cohortlens.plans.q_storage import bucketed_lookup
from cohortlens.sources import buckets as BK
from cohortlens.sources import content, landing


# ------------------------------------------------------------------ landing
def _land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def test_files_enter_once_and_columns_are_added(spark, tmp_path):
    landed, table, ck = (str(tmp_path / p) for p in ("landed", "table", "ck"))
    _land(spark, landed, [(1, "a"), (2, "b")], "id long, x string")
    assert landing.consolidate(spark, landed, table, ck) == 2
    assert landing.consolidate(spark, landed, table, ck) == 0
    _land(spark, landed, [(3, "c", 0.5), (3, "c", 0.5)], "id long, x string, z double")
    assert landing.consolidate(spark, landed, table, ck) == 2
    assert landing.consolidate(spark, landed, table, ck) == 0
    got = landing.read_consolidated(spark, table)
    assert sorted((r.id, r.x, r.z) for r in got.collect()) == [(1, "a", None), (2, "b", None), (3, "c", 0.5), (3, "c", 0.5)]


def test_a_run_lost_before_its_commit_is_not_written_twice(spark, tmp_path):
    landed, table, ck = (str(tmp_path / p) for p in ("landed", "table", "ck"))
    for k in range(2):
        _land(spark, landed, [(k, "a")], "id long, x string")
        landing.consolidate(spark, landed, table, ck)
    # the state of a driver that was lost after the files were written, before the batch was marked done
    lost = str(tmp_path / "lost")
    shutil.copytree(ck, lost, ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.strip(".").startswith("1")])
    _land(spark, landed, [(2, "a")], "id long, x string")
    landing.consolidate(spark, landed, table, lost)
    assert sorted(r.id for r in landing.read_consolidated(spark, table).collect()) == [0, 1, 2]


def test_files_of_an_unfinished_run_are_not_read(spark, tmp_path):
    landed, table, ck = (str(tmp_path / p) for p in ("landed", "table", "ck"))
    _land(spark, landed, [(1, "a")], "id long, x string")
    landing.consolidate(spark, landed, table, ck)
    spark.createDataFrame([(9, "z")], "id long, x string").coalesce(1).write.parquet(str(tmp_path / "stray"))
    for f in (tmp_path / "stray").glob("*.parquet"):
        shutil.copy(f, table)
    assert [r.id for r in landing.read_consolidated(spark, table).collect()] == [1]


def test_a_changed_type_is_an_error(spark, tmp_path):
    landed = str(tmp_path / "landed")
    _land(spark, landed, [(1, "a")], "id long, x string")
    _land(spark, landed, [(1, 2.5)], "id long, x double")
    with pytest.raises(Exception, match="(?i)merge"):
        landing.consolidate(spark, landed, str(tmp_path / "table"), str(tmp_path / "ck"))


def test_json_pages_land_as_strings(spark, tmp_path):
    landed, table, ck = (str(tmp_path / p) for p in ("landed", "table", "ck"))
    spark.createDataFrame([(1, "a")], "id long, x string").write.json(landed)
    landing.consolidate(spark, landed, table, ck, "json", ["id", "x", "later"])
    assert [tuple(r) for r in landing.read_consolidated(spark, table).collect()] == [("1", "a", None)]


# ------------------------------------------------------------------ buckets
@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_sides_join_without_exchange(spark, students, no_broadcast):
    rows, lookup, depto = bucketed_lookup(spark, students, buckets=4)
    joined = rows.join(lookup.withColumnRenamed(BK.SALT, "s"), (F.col(G.MCPIO) == F.col("key")) & (F.col(BK.SALT) == F.col("s")), "left")
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    m, d = G.fit_lookups(students)
    assert "Exchange" in _plan(students.join(m, F.col(G.MCPIO) == F.col("key"), "left"))
    cols = ["estu_consecutivo", "n_estudiantes_mcpio", *G.PCT, "pct_calendario_b_depto"]
    for loo in (False, True):
        got = G.apply_lookups(rows, lookup, depto, leave_one_out=loo, salt=BK.SALT).select(*cols)
        want = G.apply_lookups(students, m, d, leave_one_out=loo).select(*cols)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_hot_key_is_dealt_over_buckets(spark, tmp_path):
    hot = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise("hot").alias("k"))
    df = BK.write_bucketed(BK.with_salt(hot, "id"), "hot_rows", str(tmp_path / "hot"), ["k", BK.SALT], 32)
    sizes = [r.n for r in df.where("k = 'hot'").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert df.count() == 2000 and len(sizes) > 2 and max(sizes) < 1000
    again = BK.open_bucketed(spark, "hot_rows_again", str(tmp_path / "hot"), df.schema, ["k", BK.SALT], 32)
    assert "Exchange" not in _plan(again.groupBy("k", BK.SALT).count())
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ content digests
def _brute(data: bytes, size: int) -> str:
    parts = [data[a:a + size] for a in range(0, len(data), size)]
    return hashlib.sha256("".join(hashlib.sha256(p).hexdigest() for p in parts).encode()).hexdigest()


def test_digests_equal_hashlib_by_both_readers(spark, tmp_path):
    files = {"empty": b"", "one": b"x", "even": bytes(range(256)) * 4, "odd": b"\xef\xbb\xbf\r\n\x00" * 333}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    for through in (None, False, True):
        got = content.content_fingerprints(spark, [str(tmp_path)], 512, through).collect()
        files.pop("empty", None)  # Spark's readers pass over empty files
        assert {r.name: (r.n_bytes, r.content_sha256) for r in got} == {n: (len(d), _brute(d, 512)) for n, d in files.items()}
        assert {r.name: r.n_ranges for r in got} == {n: -(-len(d) // 512) for n, d in files.items()}


def test_a_changed_byte_or_order_is_seen(spark, tmp_path):
    one, two = tmp_path / "a", tmp_path / "b"
    one.mkdir(), two.mkdir()
    (one / "f").write_bytes(b"r1\nr2\n" * 1000)
    (one / "same").write_bytes(b"s")
    (two / "f").write_bytes(b"r2\nr1\n" * 1000)
    (two / "same").write_bytes(b"s")
    (two / "new").write_bytes(b"n")
    by_name = [content.content_fingerprints(spark, [str(d)], 64).withColumn("path", F.col("name")) for d in (one, two)]
    assert {tuple(r) for r in content.changed_files(*by_name).collect()} == {("f", "changed"), ("new", "added")}
    assert {tuple(r) for r in content.changed_files(*reversed(by_name)).collect()} == {("f", "changed"), ("new", "removed")}


# ------------------------------------------------------------------ permutation
def test_every_column_is_permuted_by_its_bijection(spark):
    n = 1000
    df = spark.range(n).select("id", F.col("id").alias("a"), F.concat(F.lit("s"), F.col("id")).alias("b"),
                               F.when(F.col("id") % 2 == 0, F.col("id")).alias("c"))
    out = X.permuted_variants(df, ["a", "b", "c"], "id").collect()
    assert len(out) == 4 * n
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"{i}#perm{X.K.SEED}".encode()).hexdigest(), i))
    for name, at in (("a", 1), ("b", 2), ("c", 3)):
        off = X.permutation_offset(name)
        source = {order[(k * X.PERMUTATION_PRIMES[0] + off) % n]: order[k] for k in range(n)}
        plain = {r.id: tuple(r)[:4] for r in out if r["__variant"] == ""}
        for r in (r for r in out if r["__variant"] == name):
            want = list(plain[r.id])
            want[at] = plain[source[r.id]][at]
            assert tuple(r)[:4] == tuple(want)


def test_permutation_of_few_or_no_rows(spark):
    df = spark.range(1).select("id", F.col("id").alias("a"))
    assert [tuple(r) for r in X.permuted_variants(df, ["a"], "id").select("id", "a").collect()] == [(0, 0), (0, 0)]
    assert X.permuted_variants(df.where("id > 5"), ["a"], "id").count() == 0


def test_a_column_without_use_has_no_importance(spark):
    df = spark.range(500).select("id", (F.col("id") * 1.0).alias("x"), F.rand(1).alias("z"))
    score = lambda f: f.select(F.col("id").cast("double").alias("y_true"), F.col("x").alias("y_pred"), "__variant")
    got = {r.feature: r.delta_rmse for r in X.permutation_rmse(score, df, ["x", "z"], "id").collect()}
    assert got["z"] == 0 and got["x"] > 100
