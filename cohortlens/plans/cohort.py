"""Role-mapped views over the driver tables (Spark side).

``cohort``  : cleaned student table, one row per order
              (orders ⋈ customer ⋈ nation ⋈ region).
``raw_records``: raw, all-string-ish records at lineitem grain, with duplicated
              ids, null targets and malformed scores (input of the cleaning step).

Join strategy: ``orders ⋈ customer`` is a shuffled equi-join on the customer
key (both sides grow with the data); AQE splits a hot customer key on the
orders side. ``nation``/``region`` are dimension tables whose file size is far
below ``autoBroadcastJoinThreshold``, so Spark's size check broadcasts them;
if they ever grew past it the planner falls back to a shuffled join by itself.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.plans import roles as R
from cohortlens.sources.tables import read_table


def _map_lookup(mapping: dict, key: Column) -> Column:
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, key)


def _pick(labels: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (idx + 1).cast("int"))


def _ddmmyyyy(day: Column, month: Column, year: Column) -> Column:
    return F.concat(F.lpad(day.cast("string"), 2, "0"), F.lit("/"),
                    F.lpad(month.cast("string"), 2, "0"), F.lit("/"), year.cast("string"))


def period_of(ts: Column) -> Column:
    """``YYYYq`` period string (lexicographically ordered)."""
    return F.concat(F.year(ts).cast("string"), F.quarter(ts).cast("string"))


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus",
                                             "o_totalprice", "o_orderdate", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal",
                                               "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])

    df = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))

    prio, status, seg = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("c_mktsegment")
    stratum = _map_lookup(R.PRIORITY_TO_STRATUM, prio)
    for p, s, label in reversed(R.STRATUM_OVERRIDES):
        stratum = F.when((prio == p) & (seg == s), F.lit(label)).otherwise(stratum)

    birth_year = F.when(F.col("o_custkey") % 97 == 0, F.lit(R.ABSURD_BIRTH_YEAR)) \
        .otherwise(F.year("o_orderdate") - 14 - F.col("o_custkey") % 9)
    medium = prio == "3-MEDIUM"
    birth = (F.when(medium & (status == "P"), F.lit(None).cast("string"))
             .when(medium & (status == "O"), F.lit(R.MALFORMED_BIRTH))
             .otherwise(_ddmmyyyy(F.dayofmonth("o_orderdate"), F.month("o_orderdate"), birth_year)))

    yes_no = lambda cond: F.when(cond, F.lit("Si")).otherwise(F.lit("No"))
    target = (F.lit(100.0)
              + 15 * (6 - F.substring(prio, 1, 1).cast("int"))
              + 20 * (status == "F").cast("int")
              + 10 * (F.col("c_nationkey") % 5)
              + F.col("o_totalprice") / 5000)

    return df.select(
        F.col("o_orderkey").alias("estu_consecutivo"),
        F.col("o_custkey").alias("cole_codigo_icfes"),
        period_of(F.col("o_orderdate")).alias("periodo"),
        birth.alias("estu_fechanacimiento"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("estu_genero"),
        F.col("n_name").alias("estu_mcpio_reside"),
        F.col("r_name").alias("estu_depto_reside"),
        F.when(status == "F", F.col("n_name"))
         .when(status == "O", F.concat(F.col("n_name"), F.lit("_B"))).alias("estu_mcpio_presentacion"),
        F.when(medium, F.lit("OTRO")).otherwise(F.col("r_name")).alias("estu_depto_presentacion"),
        stratum.alias("fami_estratovivienda"),
        _map_lookup(R.SEGMENT_TO_MOTHER_EDU, seg).alias("fami_educacionmadre"),
        _map_lookup(R.STATUS_TO_FATHER_EDU, status).alias("fami_educacionpadre"),
        _pick(R.PERSONS_LABELS, F.col("o_custkey") % len(R.PERSONS_LABELS)).alias("fami_personashogar"),
        _pick(R.ROOMS_LABELS, F.col("o_orderkey") % len(R.ROOMS_LABELS)).alias("fami_cuartoshogar"),
        yes_no(status == "F").alias("fami_tieneinternet"),
        yes_no(status != "P").alias("fami_tienecomputador"),
        yes_no(F.col("c_acctbal") > R.CAR_BALANCE).alias("fami_tieneautomovil"),
        yes_no(F.col("o_totalprice") > R.WASHER_PRICE).alias("fami_tienelavadora"),
        F.when(seg == "BUILDING", "OFICIAL").otherwise("NO OFICIAL").alias("cole_naturaleza"),
        F.when(seg == "MACHINERY", "B").when(seg == "AUTOMOBILE", "OTRO").otherwise("A")
         .alias("cole_calendario"),
        F.when(F.col("c_nationkey") % 3 == 0, "RURAL").otherwise("URBANO").alias("cole_area_ubicacion"),
        F.when(F.col("c_custkey") % 10 == 0, "S").otherwise("N").alias("cole_bilingue"),
        target.alias("punt_global"),
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lineitem-grain records with duplicated ids (input of cleaning)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", *R.RAW_ORDER_COLS])
    as_text = lambda c: c.cast("bigint").cast("string")
    math_ = F.when(F.col("l_quantity") == 1, F.lit("ABS")).otherwise(as_text(F.col("l_quantity")))
    reading = as_text(F.floor(F.col("l_discount") * 100))
    science = as_text(F.floor(F.col("l_tax") * 100))
    social = as_text(F.col("l_linenumber"))
    english = F.when(F.col("l_linestatus") == "O", F.lit(None).cast("string")) \
        .otherwise(as_text(F.floor(F.col("l_extendedprice") / 1000)))
    total = (F.coalesce(math_.try_cast("bigint"), F.lit(0)) + F.floor(F.col("l_discount") * 100)
             + F.floor(F.col("l_tax") * 100) + F.col("l_linenumber")
             + F.floor(F.col("l_extendedprice") / 1000) + F.col("l_partkey") % 3)
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("estu_consecutivo"),
        period_of(F.col("l_shipdate")).alias("periodo"),
        *R.RAW_ORDER_COLS,
        F.lit("ESTUDIANTE").alias("estu_estudiante"),
        F.col("l_suppkey").cast("string").alias("cole_codigo_icfes"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
         .otherwise(as_text(total)).alias("punt_global"),
        math_.alias("punt_matematicas"),
        reading.alias("punt_lectura_critica"),
        science.alias("punt_c_naturales"),
        social.alias("punt_sociales_ciudadanas"),
        english.alias("punt_ingles"),
    )


PRED_CELL = ["fami_estratovivienda", "fami_tieneinternet", "estu_mcpio_reside"]


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(y_true, y_pred) table for metric queries: y_pred = mean of y in the
    (stratum, internet, municipality) cell — an aggregate joined back (null-safe),
    so a hot cell is summed map-side instead of buffered by a window."""
    c = cohort(spark, sf_dir)
    cell = c.groupBy(*PRED_CELL).agg(F.avg("punt_global").alias("y_pred"))
    cell = cell.select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(PRED_CELL)], "y_pred")
    cond = [F.col(k).eqNullSafe(F.col(f"__c{i}")) for i, k in enumerate(PRED_CELL)]
    return c.join(cell, cond).select(
        "estu_consecutivo", "periodo", "fami_estratovivienda", "estu_genero",
        "cole_area_ubicacion", "cole_naturaleza", "estu_depto_reside", "fami_tieneinternet",
        "estu_mcpio_reside", F.col("punt_global").alias("y_true"), "y_pred")
