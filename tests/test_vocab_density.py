"""Table-backed vocabularies as a pipeline stage; kernel densities against numpy; the eight-feature composition."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from cohortlens.functions import features as FX
from cohortlens.operators import diagnostics as D
from cohortlens.operators.vocab import VocabIndexer
from cohortlens.session import scratch_path


def test_a_million_values_through_save_and_load(spark):
    train = spark.range(1_000_000).select(F.format_string("v%07d", "id").alias("a"), (F.col("id") % 3).cast("string").alias("b"))
    path = scratch_path(spark, f"vocab-test-{spark.sparkContext.applicationId}")
    Pipeline(stages=[VocabIndexer(inputCols=["a", "b"], suffix="_k")]).fit(train).write().overwrite().save(path)
    model = PipelineModel.load(path)
    rows = spark.createDataFrame([(1, "v0000007", "2"), (2, "v0999999", None), (3, "new", "9"), (4, None, "0"), (4, None, "0")], "id int, a string, b string")
    got = sorted(tuple(r) for r in model.transform(rows).select("id", "a_k", "b_k").collect())
    assert got == [(1, 7.0, 2.0), (2, 999_999.0, -1.0), (3, -1.0, -1.0), (4, -1.0, 0.0), (4, -1.0, 0.0)]


def test_the_vocabulary_is_not_collected_and_any_column_type_is_coded(spark):
    df = spark.createDataFrame([(5, 2.5), (3, None), (None, 1.5)], "n int, x double")
    got = VocabIndexer(inputCols=["n", "x"]).fit(df).transform(df).select("n__code", "x__code").collect()
    assert sorted(tuple(r) for r in got) == [(-1.0, 0.0), (0.0, -1.0), (1.0, 1.0)]
    assert VocabIndexer(inputCols=["n"]).fit(df.limit(0)).transform(df).where("n__code <> -1").count() == 0


def test_kernel_density_is_close_to_the_sum_over_all_values(spark):
    rng = np.random.default_rng(4)
    values = {"a": rng.normal(10, 2, 700), "b": rng.gamma(2, 3, 500), None: rng.normal(0, 1, 60), "one": np.array([3.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None)], "g string, v double")
    got = D.kernel_density(df, "g", "v", cells=2000, steps=50).collect()
    for g, v in values.items():
        own = sorted((r.step, r.x, r.density, r.bandwidth, r.n_group) for r in got if r.g == g)
        assert len(own) == 51 and own[0][4] == len(v)
        if len(v) == 1:
            assert all(d is None for _, _, d, _, _ in own)
            continue
        q1, q3 = np.quantile(v, [0.25, 0.75])
        h = 1.06 * min(v.std(ddof=1), (q3 - q1) / 1.34) * len(v) ** -0.2
        x = np.array([o[1] for o in own])
        want = np.exp(-((x[:, None] - v) / h) ** 2 / 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert own[0][3] == pytest.approx(h) and np.allclose([o[2] for o in own], want, atol=2e-3 * want.max())
    assert D.kernel_density(df.limit(0), "g", "v").count() == 0


def test_eight_features_replace_three_columns(students):
    got = FX.add_early_features(students)
    assert got.columns == [c for c in students.columns if c not in ("estu_fechanacimiento", "fami_personashogar", "fami_cuartoshogar")] + FX.EARLY_EIGHT
    wide = FX.add_deterministic_features(students)
    assert sorted(map(str, got.select(*FX.EARLY_EIGHT).collect())) == sorted(map(str, wide.select(*FX.EARLY_EIGHT).collect()))
