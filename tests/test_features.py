"""Deterministic features (F1-F25): columns, drops, clip, null semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import features as FX
from tests.conftest import STUDENT_COLS

EXPECTED = set(K.DETERMINISTIC_NUMERIC_COLS)


def test_transformer_is_stateless(students):
    t = FX.DeterministicFeatures()
    before = {p.name: t.getOrDefault(p) for p in t.params}
    t.transform(students).collect()
    after = {p.name: t.getOrDefault(p) for p in t.params}
    assert before == after


def test_creates_expected_features(students):
    out = FX.DeterministicFeatures().transform(students)
    assert EXPECTED <= set(out.columns)
    assert out.count() == students.count()


def test_drops_replaced_sources(students):
    out = FX.add_deterministic_features(students)
    for c in FX.REPLACED_SOURCES:
        assert c not in out.columns


def _one(spark, schema, **over):
    base = {c: None for c in STUDENT_COLS}
    base.update({"estu_consecutivo": 1, "periodo": "20201", "punt_global": 250.0})
    base.update(over)
    return spark.createDataFrame([tuple(base[c] for c in STUDENT_COLS)], schema)


def test_age_clip_and_nulls(spark, student_schema):
    old = FX.add_deterministic_features(_one(spark, student_schema,
                                             estu_fechanacimiento="01/01/1850")).first()
    assert old["edad_estudiante_aprox"] == K.AGE_CLIP[1]
    young = FX.add_deterministic_features(_one(spark, student_schema,
                                               estu_fechanacimiento="01/01/2019")).first()
    assert young["edad_estudiante_aprox"] == K.AGE_CLIP[0]
    missing = FX.add_deterministic_features(_one(spark, student_schema)).first()
    assert missing["edad_estudiante_aprox"] is None and missing["extra_edad"] is None
    bad = FX.add_deterministic_features(_one(spark, student_schema,
                                             estu_fechanacimiento="15/06/19x8")).first()
    assert bad["edad_estudiante_aprox"] is None


def test_unmapped_labels_and_equality_with_null(spark, student_schema):
    r = FX.add_deterministic_features(_one(
        spark, student_schema, fami_personashogar="Una", fami_cuartoshogar="Dos",
        fami_educacionmadre="Postgrado", estu_mcpio_reside=None,
        estu_mcpio_presentacion=None)).first()
    assert r["fami_personashogar_num"] is None          # "Una" is not in the map
    assert r["hacinamiento"] is None
    assert r["max_educacion_padres"] == 9 and r["min_educacion_padres"] == 9  # skip null side
    assert r["brecha_educativa_padres"] is None
    assert r["padres_universitarios"] == 1 and r["padres_sin_educacion"] == 0
    assert r["presenta_donde_reside_mcpio"] == 0          # null == null is false
    assert r["indice_socioeconomico"] == 0                 # null stratum -> 0


def test_crowding_float32(spark, student_schema):
    r = FX.add_deterministic_features(_one(spark, student_schema, fami_personashogar="Cinco",
                                           fami_cuartoshogar="Dos")).first()
    assert abs(r["hacinamiento"] - 2.5) < 1e-6


def test_helpers(spark):
    df = spark.createDataFrame([("a3b",), ("none",), (None,)], "s string")
    got = [r[0] for r in df.select(FX.regex_digit("s")).collect()]
    assert got == ["3", "0", "0"]
    df2 = spark.createDataFrame([("Dos",), ("7",), ("x",)], "c string")
    got2 = [r[0] for r in df2.select(FX.replace_then_cast(K.ROOMS_MAP, "c")).collect()]
    assert got2 == [2, 7, None]
    lo, hi = FX.clamp_band(F.lit(10.0), 36.5)
    assert spark.range(1).select(lo, hi).first() == (0.0, 46.5)
