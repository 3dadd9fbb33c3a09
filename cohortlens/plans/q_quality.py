"""Registered queries: cleaning and data-quality audit (raw lineitem-grain records)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators import clean, profile
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort, raw_records
from cohortlens.plans.oracle import with_views
from cohortlens.plans.registry import register

KEY = "estu_consecutivo"
ORDER = R.RAW_ORDER_COLS
ORDER_SQL = ", ".join(ORDER)
SCORES = [K.TARGET, *R.PARTIAL_SCORES]


def _raw(body: str) -> str:
    return with_views(body, raw=True)


@register("dedupe_keep_first", sql=_raw(f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER_SQL}) AS rn
      FROM raw WHERE {KEY} IS NOT NULL) WHERE rn = 1"""))
def dedupe_keep_first(spark, sf_dir):
    return clean.dedupe_keep_first(raw_records(spark, sf_dir), KEY, ORDER)


@register("duplicate_rank", sql=_raw(f"""
    SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER_SQL}) AS duplicate_count
    FROM raw WHERE {KEY} IS NOT NULL"""))
def duplicate_rank(spark, sf_dir):
    return clean.duplicate_rank(raw_records(spark, sf_dir), KEY, ORDER)


@register("duplicate_rank_copies", sql=_raw(f"""
    , twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE {KEY} % 3 = 0 UNION ALL SELECT * FROM raw WHERE {KEY} % 6 = 0)
    SELECT {KEY}, duplicate_count, count(*) AS n FROM (
      SELECT {KEY}, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER_SQL}) AS duplicate_count
      FROM twice WHERE {KEY} IS NOT NULL) GROUP BY 1, 2"""))
def duplicate_rank_copies(spark, sf_dir):
    """W1 where rows are repeated exactly: k copies are numbered once each."""
    raw = raw_records(spark, sf_dir)
    copies = raw.unionByName(raw.where(F.col(KEY) % 3 == 0)).unionByName(raw.where(F.col(KEY) % 6 == 0))
    return clean.duplicate_rank(copies, KEY, ORDER).groupBy(KEY, "duplicate_count").agg(F.count(F.lit(1)).alias("n"))


@register("duplicate_report", sql=_raw(f"""
    SELECT '*' AS subset, n_rows, n_distinct, n_rows - n_distinct AS n_duplicates,
      100.0 * (n_rows - n_distinct) / n_rows AS pct_duplicates
    FROM (SELECT count(*) AS n_rows FROM raw) a,
         (SELECT count(*) AS n_distinct FROM (SELECT DISTINCT * FROM raw)) b"""),
          floats=["pct_duplicates"])
def duplicate_report(spark, sf_dir):
    return clean.duplicate_report(raw_records(spark, sf_dir))


@register("duplicate_report_by_id", sql=_raw(f"""
    SELECT '{KEY}' AS subset, n_rows, n_distinct, n_rows - n_distinct AS n_duplicates,
      100.0 * (n_rows - n_distinct) / n_rows AS pct_duplicates
    FROM (SELECT count(*) AS n_rows FROM raw) a,
         (SELECT count(*) AS n_distinct FROM (SELECT DISTINCT {KEY} FROM raw)) b"""),
          floats=["pct_duplicates"])
def duplicate_report_by_id(spark, sf_dir):
    return clean.duplicate_report(raw_records(spark, sf_dir), [KEY])


@register("duplicate_drilldown", sql=_raw(f"""
    , r AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER_SQL}) AS duplicate_count,
              count(*) OVER (PARTITION BY {KEY}) AS c
            FROM raw WHERE {KEY} IS NOT NULL)
    SELECT * EXCLUDE (c) FROM r
    WHERE duplicate_count = c AND c = (SELECT max(c) FROM r)"""))
def duplicate_drilldown(spark, sf_dir):
    return clean.most_repeated(raw_records(spark, sf_dir), KEY, ORDER)


@register("duplicated_rows_semi", sql=_raw(f"""
    SELECT * FROM raw WHERE {KEY} IN (
      SELECT {KEY} FROM raw GROUP BY {KEY} HAVING count(*) > 1)"""))
def duplicated_rows_semi(spark, sf_dir):
    return clean.rows_of_duplicated_ids(raw_records(spark, sf_dir), KEY)


_KEPT = [c for c in R.RAW_COLUMNS if c not in K.CLEAN_DROP_COLS]


@register("drop_and_filter_clean", sql=_raw(f"""
    SELECT {", ".join(_KEPT)} FROM (
      SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER_SQL}) AS rn
      FROM raw WHERE {KEY} IS NOT NULL)
    WHERE rn = 1 AND {K.TARGET} IS NOT NULL"""))
def drop_and_filter_clean(spark, sf_dir):
    return clean.clean_records(raw_records(spark, sf_dir), KEY, ORDER)


@register("coerce_numeric", sql=_raw(f"""
    SELECT {KEY}, {", ".join(f"try_cast({c} AS bigint) AS {c}" for c in SCORES)} FROM raw"""))
def coerce_numeric(spark, sf_dir):
    return clean.cast_numeric(raw_records(spark, sf_dir), SCORES).select(KEY, *SCORES)


def _missing_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
             f"100.0 * (count(*) - count({c})) / count(*) AS pct FROM raw" for c in R.RAW_COLUMNS]
    return " UNION ALL ".join(parts)


@register("missing_summary", sql=_raw(_missing_sql()), floats=["pct"])
def missing_summary(spark, sf_dir):
    return profile.missing_summary(raw_records(spark, sf_dir))


@register("top_missing", sql=_raw(
    f"SELECT * FROM ({_missing_sql()}) ORDER BY missing DESC, \"column\" LIMIT 15"), floats=["pct"])
def top_missing(spark, sf_dir):
    return profile.top_missing(raw_records(spark, sf_dir), 15)


@register("nulls_by_period", sql=_raw(f"""
    SELECT periodo, count(*) AS n, count(*) - count({K.TARGET}) AS nulls,
      100.0 * (count(*) - count({K.TARGET})) / count(*) AS pct_null
    FROM raw GROUP BY periodo"""), floats=["pct_null"])
def nulls_by_period(spark, sf_dir):
    return profile.nulls_by_period(raw_records(spark, sf_dir), K.TARGET)


def _schema_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", '{R.COHORT_DTYPES.get(c, 'string')}' AS dtype, "
             f"count(*) - count({c}) AS n_null, 100.0 * (count(*) - count({c})) / count(*) AS pct_null, "
             f"count(DISTINCT {c}) AS n_unique, {'true' if c == K.TARGET else 'false'} AS is_target "
             f"FROM cohort" for c in R.COHORT_COLUMNS]
    return with_views(" UNION ALL ".join(parts))


@register("schema_summary", sql=_schema_sql(), floats=["pct_null"])
def schema_summary(spark, sf_dir):
    return profile.schema_summary(cohort(spark, sf_dir), K.TARGET)


def _low_var_sql(threshold: float = 99.0) -> str:
    parts = [f"SELECT '{c}' AS \"column\", cast({c} AS string) AS value, count(*) AS cnt "
             f"FROM raw WHERE {c} IS NOT NULL GROUP BY 2" for c in R.RAW_STRING_COLS]
    return _raw(f"""
    , cnt AS ({" UNION ALL ".join(parts)}),
    top AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS rk FROM cnt)
    SELECT "column", value AS top_value, 100.0 * cnt / (SELECT count(*) FROM raw) AS pct,
      100.0 * cnt / (SELECT count(*) FROM raw) >= {threshold} AS "drop"
    FROM top WHERE rk = 1""")


@register("low_variance", sql=_low_var_sql(), floats=["pct"])
def low_variance(spark, sf_dir):
    return profile.low_variance(raw_records(spark, sf_dir), 99.0, R.RAW_STRING_COLS)


def _profile_sql() -> str:
    parts = [f"""SELECT '{c}' AS "column", count(x) AS n, count(*) - count(x) AS nulls, avg(x) AS mean,
        stddev_samp(x) AS std, min(x) AS min, quantile_cont(x, 0.25) AS p25,
        quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, max(x) AS max,
        skewness(x) * (count(x) - 2) / sqrt(count(x) * (count(x) - 1)) AS skew
      FROM (SELECT cast(try_cast({c} AS bigint) AS double) AS x FROM raw)""" for c in SCORES]
    return _raw(" UNION ALL ".join(parts))


PROFILE_FLOATS = ["mean", "std", "min", "p25", "p50", "p75", "max", "skew"]


@register("numeric_profile", sql=_profile_sql(), floats=PROFILE_FLOATS)
def numeric_profile(spark, sf_dir):
    df = clean.cast_numeric(raw_records(spark, sf_dir), SCORES)
    return profile.numeric_profile(df, SCORES)


@register("describe_scores", sql=_raw(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(x) AS count, avg(x) AS mean, stddev_samp(x) AS std,
        min(x) AS min, max(x) AS max
      FROM (SELECT cast(try_cast({c} AS bigint) AS double) AS x FROM raw)""" for c in SCORES)),
          floats=["mean", "std", "min", "max"])
def describe_scores(spark, sf_dir):
    df = clean.cast_numeric(raw_records(spark, sf_dir), SCORES)
    return profile.describe(df, SCORES)


@register("target_histogram", sql=with_views(f"""
    , s AS (SELECT {K.TARGET} AS x FROM cohort WHERE {K.TARGET} IS NOT NULL),
    m AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n_all FROM s),
    b AS (SELECT cast(coalesce(least(floor((x - lo) / nullif((hi - lo) / 30, 0)), 29), 0) AS int) AS bin
          FROM s, m)
    SELECT bin, lo + bin * ((hi - lo) / 30) AS bin_start, lo + (bin + 1) * ((hi - lo) / 30) AS bin_end,
      n, n / nullif(n_all * ((hi - lo) / 30), 0) AS density
    FROM (SELECT bin, count(*) AS n FROM b GROUP BY bin) g, m"""),
          floats=["bin_start", "bin_end", "density"])
def target_histogram(spark, sf_dir):
    return profile.histogram(cohort(spark, sf_dir), K.TARGET, 30)


@register("group_size_summary", sql=with_views("""
    SELECT count(*) AS n_groups, avg(n) AS mean_size, quantile_cont(n, 0.5) AS median_size
    FROM (SELECT cole_codigo_icfes, count(*) AS n FROM cohort GROUP BY 1)"""),
          floats=["mean_size", "median_size"])
def group_size_summary(spark, sf_dir):
    return profile.group_size_summary(cohort(spark, sf_dir), "cole_codigo_icfes")
