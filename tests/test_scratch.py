"""Intermediate tables of the shared folder go with their scope."""

from __future__ import annotations

import os

import pytest

from cohortlens.plans import queries as _queries  # noqa: F401  (registers queries)
from cohortlens.plans.registry import REGISTRY
from cohortlens.session import drop_path, scratch_path, scratch_scope, written
from tests.conftest import SF001


def test_tables_go_at_the_end_of_their_scope(spark, tmp_path):
    kept = written(spark.range(3).toDF("n"), "outside")
    with scratch_scope(spark) as outer:
        a = written(kept.selectExpr("n + 1 AS n"), "a")
        with scratch_scope(spark) as inner:
            written(a, "b").write.parquet(str(tmp_path / "result"))
            assert os.path.dirname(inner) == outer and len(os.listdir(inner)) == 1
        assert not os.path.exists(inner) and a.count() == 3
    assert not os.path.exists(outer) and kept.count() == 3
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "result")).collect()) == [1, 2, 3]


def test_tables_go_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), scratch_scope(spark) as folder:
        written(spark.range(1).toDF("n"), "a")
        1 / 0
    assert not os.path.exists(folder) and "scope-" not in scratch_path(spark, "x")
    drop_path(spark, folder)  # nothing there any more


@pytest.mark.parametrize("name", ["numeric_profile", "median_impute"])
def test_a_query_leaves_no_table_behind(spark, name):
    base = os.path.dirname(scratch_path(spark, "x"))
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    with scratch_scope(spark) as folder:
        rows = REGISTRY[name].build(spark, SF001).collect()
        assert os.listdir(folder) and rows
    assert set(os.listdir(base)) == before
