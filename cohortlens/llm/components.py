"""Connected components of a link table by alternating stars (large star, small star).

Every node of a star takes the least id it sees; both steps are a partial and final
aggregate and a join, so a node with very many links is split by Spark like any hot key.
Rounds are cut at a table in the shared folder; only a row count and a hash sum per round
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import via_table


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                          F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b").filter(F.col("a") != F.col("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (node, component): component is the least id reachable.

    Only nodes with a link appear; self links, repeated links and nulls are ignored.
    """
    e = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a != b")
    e = via_table(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == state:
            break
        state = mark
        e = via_table(_small_star(_large_star(e)), "links")
    # every node now points at its least id; the least ids point at themselves
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
