"""Driver contract and oracle parity (sf0.001) for every query with SQL."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from cohortlens.sources.tables import DRIVER_TABLES
from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "cohens_d" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    """Type-tagged, order-comparable value (floats rounded to 4 dp)."""
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, round(v, 4))
    if isinstance(v, (list, tuple)):
        return (3, tuple(_norm(x) for x in v))
    if isinstance(v, int) and not isinstance(v, bool):
        return (2, float(v))
    return (4, str(v))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
            "string": "VARCHAR", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]",
            "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sdf.columns
    rel = duck.sql(E.oracle_sql()[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: TYPE_MAP.get(t, t) for c, t in sdf.dtypes} == duck_types
    got = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in sdf.collect())
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    idx = [dcols.index(c) for c in sorted(cols)]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == exp
