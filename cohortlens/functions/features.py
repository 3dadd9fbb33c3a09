"""Deterministic row-level features (F1-F25) as pure Column expressions.

Everything here is a JVM-side expression inside whole-stage codegen: no Python
UDF. Null semantics follow the reference: equality with null is false (0),
unmapped labels become null, the age clip keeps nulls null.
"""

from __future__ import annotations

from itertools import chain

from pyspark.ml import Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import constants as K


def map_label(mapping: dict, c: Column | str) -> Column:
    """Label -> value via a literal map; unmapped and null keys give null."""
    c = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, c)


def is_eq(c: Column | str, value) -> Column:
    """Null-safe 0/1 indicator of ``c == value`` (null compares false)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c == value, F.lit(False)).cast("int")


def is_eq_cols(a: str, b: str) -> Column:
    """0/1 indicator of column equality; two nulls compare unequal."""
    return F.coalesce(F.col(a) == F.col(b), F.lit(False)).cast("int")


def period_year(period: str = "periodo") -> Column:
    """strict int of the first four characters (raises on bad input, like the reference)."""
    return F.substring(F.col(period), 1, 4).cast("int")


def birth_year_lenient(birth: str = "estu_fechanacimiento") -> Column:
    """Characters 7-10 of ``dd/MM/yyyy`` coerced to int (bad -> null)."""
    return F.substring(F.col(birth), 7, 4).try_cast("int")


def clip_keep_null(x: Column, lo: int, hi: int) -> Column:
    """Clip that keeps null (``greatest``/``least`` alone would skip the null)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def approx_age(period: str = "periodo", birth: str = "estu_fechanacimiento",
               clip: tuple[int, int] = K.AGE_CLIP) -> Column:
    """period year minus birth year, clipped, null stays null."""
    return clip_keep_null(period_year(period) - birth_year_lenient(birth), *clip)


def eda_age(period: str = "periodo", birth: str = "estu_fechanacimiento") -> Column:
    """full-date parse (invalid -> null), year difference, no clip."""
    return period_year(period) - F.year(F.try_to_date(F.col(birth), "dd/MM/yyyy"))


def crowding(persons: Column, rooms: Column) -> Column:
    """float32 persons / rooms, zero rooms -> null."""
    return (persons.cast("float") / F.nullif(rooms.cast("float"), F.lit(0.0))).cast("float")


def replace_then_cast(mapping: dict, c: str) -> Column:
    """mapped value if known, else the original string; then lenient int cast."""
    return F.coalesce(map_label(mapping, c).cast("string"), F.col(c)).try_cast("int")


def regex_digit(c: str, missing: str = "0") -> Column:
    """first digit in a label; no digit -> ``missing``."""
    d = F.regexp_extract(F.col(c), r"(\d)", 1)
    return F.coalesce(F.nullif(d, F.lit("")), F.lit(missing))


def indicator_cols() -> dict[str, Column]:
    """group-aggregate indicators as double."""
    return {
        "estrato_alto": F.coalesce(F.col("fami_estratovivienda").isin(K.HIGH_STRATA),
                                   F.lit(False)).cast("double"),
        "internet_si": is_eq("fami_tieneinternet", "Si").cast("double"),
        "oficial": is_eq("cole_naturaleza", "OFICIAL").cast("double"),
        "calendario_b": is_eq("cole_calendario", "B").cast("double"),
    }


def clamp_band(est: Column, band: Column | float) -> tuple[Column, Column]:
    """``max(0, est - band)``, ``min(500, est + band)``."""
    band = band if isinstance(band, Column) else F.lit(float(band))
    return (F.greatest(F.lit(K.SCORE_MIN), est - band),
            F.least(F.lit(K.SCORE_MAX), est + band))


def deterministic_columns(persons_map: dict = K.PERSONS_MAP, rooms_map: dict = K.ROOMS_MAP,
                          age_clip: tuple[int, int] = K.AGE_CLIP) -> dict[str, Column]:
    """F1-F16 as named expressions (order = reference output order)."""
    internet = is_eq("fami_tieneinternet", "Si")
    computer = is_eq("fami_tienecomputador", "Si")
    car = is_eq("fami_tieneautomovil", "Si")
    washer = is_eq("fami_tienelavadora", "Si")
    tech = internet + computer
    mom = map_label(K.EDUCATION_LEVEL, "fami_educacionmadre")
    dad = map_label(K.EDUCATION_LEVEL, "fami_educacionpadre")
    persons = map_label(persons_map, "fami_personashogar")
    rooms = map_label(rooms_map, "fami_cuartoshogar")
    age = approx_age(clip=age_clip)
    stratum = F.coalesce(map_label(K.STRATUM_LEVEL, "fami_estratovivienda"), F.lit(0))
    return {
        "edad_estudiante_aprox": age,
        "anio_periodo": period_year(),
        "fami_personashogar_num": persons,
        "fami_cuartos_num": rooms,
        "hacinamiento": crowding(persons, rooms),
        "capital_tecnologico": tech,
        "proxy_riqueza_total": tech + car + washer,
        "max_educacion_padres": F.greatest(mom, dad),
        "min_educacion_padres": F.least(mom, dad),
        "brecha_educativa_padres": F.abs(mom - dad),
        "padres_universitarios": (F.coalesce(mom >= K.UNIVERSITY_LEVEL, F.lit(False))
                                  | F.coalesce(dad >= K.UNIVERSITY_LEVEL, F.lit(False))).cast("int"),
        "padres_sin_educacion": (F.coalesce(mom <= K.NO_EDUCATION_LEVEL, F.lit(False))
                                 & F.coalesce(dad <= K.NO_EDUCATION_LEVEL, F.lit(False))).cast("int"),
        "extra_edad": age - K.EXPECTED_AGE,
        "presenta_donde_reside_mcpio": is_eq_cols("estu_mcpio_reside", "estu_mcpio_presentacion"),
        "presenta_donde_reside_depto": is_eq_cols("estu_depto_reside", "estu_depto_presentacion"),
        "indice_socioeconomico": 3 * stratum + 2 * tech + car + washer,
    }


REPLACED_SOURCES = ["estu_fechanacimiento", "fami_personashogar", "fami_cuartoshogar"]


#: the earlier composition's eight features
EARLY_EIGHT = ["edad_estudiante_aprox", "anio_periodo", "fami_personashogar_num", "fami_cuartos_num", "hacinamiento",
               "capital_tecnologico", "max_educacion_padres", "indice_socioeconomico"]


def add_early_features(df: DataFrame, **kw) -> DataFrame:
    """the input less the three replaced columns, with eight of the deterministic features."""
    wide = add_deterministic_features(df, **kw)
    return wide.select(*[c for c in df.columns if c in wide.columns], *EARLY_EIGHT)


def add_deterministic_features(df: DataFrame, **kw) -> DataFrame:
    """One ``select`` adding 16 columns and dropping the 3 replaced sources."""
    cols = deterministic_columns(**kw)
    keep = [c for c in df.columns if c not in REPLACED_SOURCES and c not in cols]
    return df.select(*keep, *[e.alias(n) for n, e in cols.items()])


class DeterministicFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless ML stage wrapping ``add_deterministic_features``."""

    ageLow = Param(Params._dummy(), "ageLow", "lower age clip", TypeConverters.toInt)
    ageHigh = Param(Params._dummy(), "ageHigh", "upper age clip", TypeConverters.toInt)

    def __init__(self, ageLow: int = K.AGE_CLIP[0], ageHigh: int = K.AGE_CLIP[1]):
        super().__init__()
        self._setDefault(ageLow=K.AGE_CLIP[0], ageHigh=K.AGE_CLIP[1])
        self._set(ageLow=ageLow, ageHigh=ageHigh)

    def _transform(self, df: DataFrame) -> DataFrame:
        return add_deterministic_features(
            df, age_clip=(self.getOrDefault(self.ageLow), self.getOrDefault(self.ageHigh)))
