"""Registry of named queries: a Spark plan plus (optionally) its DuckDB oracle SQL.

Aggregate float outputs (``floats``) are rounded to ``DIGITS`` decimals on both
sides so engines that sum in a different order still hash equal. Row-level float
outputs are left unrounded: both engines run the same IEEE operations on them,
and rounding values that sit on a decimal tie would split them (T23).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 4


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    floats: list[str] = field(default_factory=list)
    row_id: str = ""


REGISTRY: dict[str, Query] = {}


def _round_spark(df: DataFrame, floats: list[str]) -> DataFrame:
    fl = set(floats)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in fl:
            out.append(F.round(c.cast("double"), DIGITS).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def _round_sql(sql: str, floats: list[str]) -> str:
    if not floats:
        return sql
    rep = ", ".join(f"round(cast({c} AS double), {DIGITS}) AS {c}" for c in floats)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _q"


def register(name: str, sql: str | None = None, floats: list[str] | None = None):
    """Decorator: ``@register("name", sql=..., floats=[...])`` on ``fn(spark, sf_dir)``."""
    floats = list(floats or [])

    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _round_spark(fn(spark, sf_dir), floats)
        REGISTRY[name] = Query(name, build, _round_sql(sql, floats) if sql else None, floats)
        return fn
    return deco
