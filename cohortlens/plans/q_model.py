"""Registered queries: group lookups / leave-one-out, splits, metrics and diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators import diagnostics as D
from cohortlens.operators import groupagg as G
from cohortlens.operators import split as S
from cohortlens.operators import tune as T
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import PRED_CELL, cohort, predictions
from cohortlens.plans.oracle import q, with_views
from cohortlens.plans.registry import register

ID = "estu_consecutivo"
CUT = R.TRAIN_UNTIL
HASH_SQL = f"md5(concat(cast({ID} AS string), '#{K.SEED}'))"
GROUP_COLS = K.GROUP_NUMERIC_COLS

IND_SQL = f"""cast(coalesce(fami_estratovivienda IN ({", ".join(q(s) for s in K.HIGH_STRATA)}), false) AS double) AS ea,
  cast(coalesce(fami_tieneinternet = 'Si', false) AS double) AS it,
  cast(coalesce(cole_naturaleza = 'OFICIAL', false) AS double) AS ofi,
  cast(coalesce(cole_calendario = 'B', false) AS double) AS cb"""

LOOKUP_SQL = f"""
, ind AS (SELECT *, {IND_SQL} FROM cohort),
tr AS (SELECT * FROM ind WHERE periodo <= '{CUT}'),
ml AS (SELECT estu_mcpio_reside AS mk, cast(count(*) AS double) AS n,
          sum(ea) AS s_ea, sum(ea) / count(ea) AS p_ea, sum(it) AS s_it, sum(it) / count(it) AS p_it,
          sum(ofi) AS s_of, sum(ofi) / count(ofi) AS p_of
       FROM tr WHERE estu_mcpio_reside IS NOT NULL GROUP BY 1),
dl AS (SELECT estu_depto_reside AS dk, avg(cb) AS p_cb FROM tr
       WHERE estu_depto_reside IS NOT NULL GROUP BY 1),
g AS (SELECT avg(n) AS gn, avg(p_ea) AS g_ea, avg(p_it) AS g_it, avg(p_of) AS g_of FROM ml),
gd AS (SELECT avg(p_cb) AS g_cb FROM dl),
j AS (SELECT ind.*, ml.*, dl.*, g.*, gd.* FROM ind
      LEFT JOIN ml ON ind.estu_mcpio_reside = ml.mk
      LEFT JOIN dl ON ind.estu_depto_reside = dl.dk, g, gd)"""


def _lookup_select(loo: bool) -> str:
    def pct(s, p, own, gl):
        if loo:
            return f"cast(CASE WHEN n >= {K.MIN_N_LOO} THEN ({s} - {own}) / (n - 1) ELSE {gl} END AS float)"
        return f"cast(coalesce({p}, {gl}) AS float)"
    return f"""SELECT {ID}, cast(coalesce(n, gn) AS float) AS n_estudiantes_mcpio,
      {pct('s_ea', 'p_ea', 'ea', 'g_ea')} AS pct_estrato_alto_mcpio,
      {pct('s_it', 'p_it', 'it', 'g_it')} AS pct_internet_mcpio,
      {pct('s_of', 'p_of', 'ofi', 'g_of')} AS pct_oficial_mcpio,
      cast(coalesce(p_cb, g_cb) AS float) AS pct_calendario_b_depto FROM j"""


def _fit_train(spark, sf_dir):
    c = cohort(spark, sf_dir)
    m, d = G.fit_lookups(c.where(F.col("periodo") <= CUT))
    return c, m, d


@register("group_lookup_plain", sql=with_views(LOOKUP_SQL + _lookup_select(False)
                                               + f" WHERE periodo > '{CUT}'"), floats=GROUP_COLS)
def group_lookup_plain(spark, sf_dir):
    c, m, d = _fit_train(spark, sf_dir)
    return G.apply_lookups(c.where(F.col("periodo") > CUT), m, d).select(ID, *GROUP_COLS)


@register("group_lookup_loo", sql=with_views(LOOKUP_SQL + _lookup_select(True)
                                             + f" WHERE periodo <= '{CUT}'"), floats=GROUP_COLS)
def group_lookup_loo(spark, sf_dir):
    c, m, d = _fit_train(spark, sf_dir)
    return G.apply_lookups(c.where(F.col("periodo") <= CUT), m, d, leave_one_out=True) \
        .select(ID, *GROUP_COLS)


@register("group_lookup_unseen_fallback", sql=with_views(
    LOOKUP_SQL.replace("LEFT JOIN ml ON ind.estu_mcpio_reside = ml.mk",
                       "LEFT JOIN ml ON ind.estu_mcpio_presentacion = ml.mk")
    + _lookup_select(False)), floats=GROUP_COLS)
def group_lookup_unseen_fallback(spark, sf_dir):
    """Lookups keyed by the sitting municipality: '_B' variants and nulls are unseen."""
    c, m, d = _fit_train(spark, sf_dir)
    keyed = c.drop("estu_mcpio_reside").withColumnRenamed("estu_mcpio_presentacion",
                                                         "estu_mcpio_reside")
    return G.apply_lookups(keyed, m, d).select(ID, *GROUP_COLS)


@register("group_lookup_table", sql=with_views(LOOKUP_SQL + """
    SELECT mk AS key, n, s_ea AS sum_estrato_alto, p_ea AS pct_estrato_alto_mcpio,
      s_it AS sum_internet_si, p_it AS pct_internet_mcpio, s_of AS sum_oficial,
      p_of AS pct_oficial_mcpio FROM ml"""),
          floats=["pct_estrato_alto_mcpio", "pct_internet_mcpio", "pct_oficial_mcpio"])
def group_lookup_table(spark, sf_dir):
    _, m, _ = _fit_train(spark, sf_dir)
    return m


@register("group_lookup_globals", sql=with_views(LOOKUP_SQL + """
    SELECT gn AS n_estudiantes_mcpio, g_ea AS pct_estrato_alto_mcpio, g_it AS pct_internet_mcpio,
      g_of AS pct_oficial_mcpio, g_cb AS pct_calendario_b_depto FROM g, gd"""), floats=GROUP_COLS)
def group_lookup_globals(spark, sf_dir):
    _, m, d = _fit_train(spark, sf_dir)
    g = G.global_fallbacks(m, d)
    return spark.range(1).select(*[g[k].alias(k) for k in GROUP_COLS])


# ---------------------------------------------------------------- splits
@register("stratified_split", sql=with_views(f"""
    SELECT {ID}, periodo, CASE WHEN rk <= round(0.2 * ns) THEN 'test' ELSE 'train' END AS role
    FROM (SELECT {ID}, periodo,
            row_number() OVER (PARTITION BY periodo ORDER BY {HASH_SQL}, {ID}) AS rk,
            count(*) OVER (PARTITION BY periodo) AS ns FROM cohort)"""))
def stratified_split(spark, sf_dir):
    return S.stratified_split(cohort(spark, sf_dir).select(ID, "periodo"), ID, "periodo", 0.2)


@register("kfold_assign", sql=with_views(f"""
    SELECT {ID}, cast((row_number() OVER (ORDER BY {HASH_SQL}, {ID}) - 1) % 5 AS int) AS fold
    FROM cohort"""))
def kfold_assign(spark, sf_dir):
    return S.kfold_assign(cohort(spark, sf_dir).select(ID), ID, 5)


@register("contiguous_kfold", sql=with_views(f"""
    , r AS (SELECT {ID}, row_number() OVER (ORDER BY {ID}) - 1 AS i, count(*) OVER () AS n FROM cohort),
    p AS (SELECT *, n // 3 AS qq, n % 3 AS rr FROM r)
    SELECT {ID}, cast(CASE WHEN i < rr * (qq + 1) THEN i // (qq + 1)
                       ELSE rr + (i - rr * (qq + 1)) // qq END AS int) AS fold FROM p"""))
def contiguous_kfold(spark, sf_dir):
    return S.contiguous_kfold(cohort(spark, sf_dir).select(ID), ID, 3)


def greedy_folds_sql(groups: str, name: str = "fo") -> str:
    """CTEs from ``groups`` (g, sz) to ``name`` (g, fold): one group after another, by size, to the
    lightest of five folds."""
    least = "least(l0, l1, l2, l3, l4)"
    pick = " ".join(f"WHEN l{k} = {least} THEN {k}" for k in range(5))
    add = ", ".join(f"l{k} + CASE WHEN pick = {k} THEN sz ELSE 0 END AS l{k}" for k in range(5))
    return f"""{name}_r AS (SELECT g, sz, row_number() OVER (ORDER BY sz DESC, g) AS rk FROM {groups}),
    {name}_w AS (SELECT CAST(0 AS BIGINT) AS rk, '' AS g, 0 AS fold, {", ".join(f"CAST(0 AS BIGINT) AS l{k}" for k in range(5))}
      UNION ALL SELECT rk, g, pick AS fold, {add} FROM (
        SELECT r.rk, r.g, r.sz, l0, l1, l2, l3, l4, CASE {pick} END AS pick FROM {name}_w w JOIN {name}_r r ON r.rk = w.rk + 1)),
    {name} AS (SELECT g, cast(fold AS int) AS fold FROM {name}_w WHERE rk > 0)"""


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("group_kfold_assign", sql=recursive(with_views(f"""
    , k AS (SELECT {ID}, coalesce(cast(cole_codigo_icfes AS string), '{K.MISSING_GROUP}') AS g FROM cohort),
    s AS (SELECT g, count(*) AS sz FROM k GROUP BY g),
    {greedy_folds_sql("s", "f")}
    SELECT {ID}, k.g AS group_key, fold FROM k JOIN f ON k.g = f.g""")))
def group_kfold_assign(spark, sf_dir):
    return S.group_kfold_assign(cohort(spark, sf_dir).select(ID, "cole_codigo_icfes"),
                                "cole_codigo_icfes", 5).select(ID, "group_key", "fold")


@register("temporal_holdout_split", sql=with_views(f"""
    SELECT {ID}, periodo, CASE WHEN periodo <= '{CUT}' THEN 'train' ELSE 'test' END AS role
    FROM cohort"""))
def temporal_holdout_split(spark, sf_dir):
    return S.temporal_split(cohort(spark, sf_dir).select(ID, "periodo"), "periodo", CUT, check=True)


@register("seeded_sample", sql=with_views(f"""
    SELECT {ID}, periodo, punt_global FROM cohort ORDER BY {HASH_SQL}, {ID} LIMIT 1000"""))
def seeded_sample(spark, sf_dir):
    return S.seeded_sample(cohort(spark, sf_dir).select(ID, "periodo", "punt_global"), ID, 1000)


# ---------------------------------------------------------------- metrics
PRED_SQL = f"""
, pred AS (SELECT {ID}, periodo, fami_estratovivienda, estu_genero, cole_area_ubicacion,
     cole_naturaleza, estu_depto_reside, fami_tieneinternet, estu_mcpio_reside,
     punt_global AS y_true,
     avg(punt_global) OVER (PARTITION BY {", ".join(PRED_CELL)}) AS y_pred FROM cohort)"""
METRICS_SQL = ("count(*) AS n, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, "
               "avg(abs(y_true - y_pred)) AS mae, 1 - sum((y_true - y_pred) * (y_true - y_pred)) "
               "/ nullif(var_pop(y_true) * count(y_true), 0) AS r2")
MF = ["rmse", "mae", "r2"]


@register("regression_report", sql=with_views(PRED_SQL + f" SELECT {METRICS_SQL} FROM pred"),
          floats=MF)
def regression_report(spark, sf_dir):
    return D.regression_report(predictions(spark, sf_dir))


_P = [50, 75, 90, 95, 99]


@register("residual_summary", sql=with_views(PRED_SQL + f"""
    SELECT {METRICS_SQL}, avg(y_true - y_pred) AS residual_mean,
      stddev_pop(y_true - y_pred) AS residual_std,
      {", ".join(f"quantile_cont(abs(y_true - y_pred), {p / 100}) AS abs_error_p{p}" for p in _P)}
    FROM pred"""), floats=MF + ["residual_mean", "residual_std"] + [f"abs_error_p{p}" for p in _P])
def residual_summary(spark, sf_dir):
    return D.residual_summary(predictions(spark, sf_dir))


@register("calibration_by_bucket", sql=with_views(PRED_SQL + f"""
    , e AS (SELECT list_sort(list_distinct(quantile_cont(y_true, [{", ".join(str(i / 10) for i in range(11))}]))) AS edges FROM pred),
    b AS (SELECT pred.*, edges, cast(greatest(len(list_filter(edges, lambda x: x < y_true)), 1) - 1 AS int) AS bucket
          FROM pred, e)
    SELECT bucket, edges[bucket + 1] AS lower_edge, edges[bucket + 2] AS upper_edge, count(*) AS n,
      avg(y_true) AS mean_true, avg(y_pred) AS mean_pred, avg(y_true - y_pred) AS bias,
      sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse
    FROM b GROUP BY bucket, edges"""),
          floats=["lower_edge", "upper_edge", "mean_true", "mean_pred", "bias", "rmse"])
def calibration_by_bucket(spark, sf_dir):
    return D.calibration_by_bucket(predictions(spark, sf_dir))


def _group_metrics_sql(dim_expr: str, dims: list[str], min_n: int) -> str:
    parts = [f"""SELECT {dim_expr.format(d=d)} cast({d} AS string) AS "group", {METRICS_SQL},
        min(y_true) AS ymin, max(y_true) AS ymax, avg(y_true) AS mean_true, avg(y_pred) AS mean_pred,
        avg(y_true - y_pred) AS bias FROM pred GROUP BY {d} HAVING count(*) >= {min_n}"""
             for d in dims]
    keys = "dimension, " if "dimension" in dim_expr else ""
    return with_views(PRED_SQL + f"""
    SELECT {keys}"group", n, rmse, mae, CASE WHEN ymin < ymax THEN r2 END AS r2, mean_true,
      mean_pred, bias FROM ({" UNION ALL ".join(parts)})""")


GM = MF + ["mean_true", "mean_pred", "bias"]


@register("metrics_by_group", sql=_group_metrics_sql("", ["fami_estratovivienda"], 30), floats=GM)
def metrics_by_group(spark, sf_dir):
    return D.metrics_by_group(predictions(spark, sf_dir), "fami_estratovivienda", min_n=30)


@register("fairness_report", sql=_group_metrics_sql("'{d}' AS dimension,", K.FAIRNESS_COLS, 100),
          floats=GM)
def fairness_report(spark, sf_dir):
    return D.fairness_report(predictions(spark, sf_dir), min_n=100)


@register("residual_histogram", sql=with_views(PRED_SQL + """
    , s AS (SELECT y_true - y_pred AS x FROM pred),
    m AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n_all FROM s),
    b AS (SELECT cast(coalesce(least(floor((x - lo) / nullif((hi - lo) / 80, 0)), 79), 0) AS int) AS bin
          FROM s, m)
    SELECT bin, lo + bin * ((hi - lo) / 80) AS bin_start, lo + (bin + 1) * ((hi - lo) / 80) AS bin_end,
      n, n / nullif(n_all * ((hi - lo) / 80), 0) AS density
    FROM (SELECT bin, count(*) AS n FROM b GROUP BY bin) g, m"""),
          floats=["bin_start", "bin_end", "density"])
def residual_histogram(spark, sf_dir):
    return D.residual_histogram(predictions(spark, sf_dir))


@register("pred_vs_true_sample", sql=with_views(PRED_SQL + f"""
    SELECT {ID}, y_true, y_pred, y_true - y_pred AS residual FROM pred
    ORDER BY {HASH_SQL}, {ID} LIMIT 20000"""), floats=["y_pred", "residual"])
def pred_vs_true_sample(spark, sf_dir):
    return D.scatter_sample(predictions(spark, sf_dir), ID)


@register("density_by_group", sql=with_views(f"""
    , s AS (SELECT {ID}, estu_genero, punt_global FROM cohort ORDER BY {HASH_SQL}, {ID} LIMIT 20000),
    m AS (SELECT min(punt_global) AS lo, max(punt_global) AS hi FROM s),
    b AS (SELECT estu_genero, cast(coalesce(least(floor((punt_global - lo) / nullif((hi - lo) / 40, 0)), 39), 0) AS int) AS bin FROM s, m),
    c AS (SELECT estu_genero, bin, count(*) AS n FROM b GROUP BY 1, 2),
    t AS (SELECT estu_genero, count(*) AS n_group FROM s GROUP BY 1)
    SELECT c.estu_genero, bin, lo + bin * ((hi - lo) / 40) AS bin_start, n,
      n / (n_group * ((hi - lo) / 40)) AS density
    FROM c JOIN t ON c.estu_genero = t.estu_genero, m"""), floats=["bin_start", "density"])
def density_by_group(spark, sf_dir):
    return D.density_by_group(cohort(spark, sf_dir), ID, "estu_genero", "punt_global")


@register("naive_baseline_metrics", sql=with_views(f"""
    , m AS (SELECT avg(punt_global) AS mu FROM cohort WHERE periodo <= '{CUT}'),
    pred AS (SELECT punt_global AS y_true, mu AS y_pred FROM cohort, m WHERE periodo > '{CUT}')
    SELECT {METRICS_SQL} FROM pred"""), floats=MF)
def naive_baseline_metrics(spark, sf_dir):
    c = cohort(spark, sf_dir)
    mu = c.where(F.col("periodo") <= CUT).agg(F.avg("punt_global")).scalar()
    test = c.where(F.col("periodo") > CUT).select(F.col("punt_global").alias("y_true"),
                                                  mu.alias("y_pred"))
    return D.regression_report(test)


# ---------------------------------------------------------------- E7 with a closed-form learner
CV_CELL = ["fami_estratovivienda", "fami_tieneinternet"]
_CV_SQL = f"""
    , kk AS (SELECT coalesce(cast(estu_mcpio_reside AS string), '{K.MISSING_GROUP}') AS g,
               coalesce(fami_estratovivienda, '{K.MISSING_GROUP}') AS c1,
               coalesce(fami_tieneinternet, '{K.MISSING_GROUP}') AS c2, punt_global AS y FROM cohort),
    s AS (SELECT g, count(*) AS sz FROM kk GROUP BY g),
    {greedy_folds_sql("s")},
    f AS (SELECT kk.*, fold FROM kk JOIN fo ON kk.g = fo.g),
    cf AS (SELECT c1, c2, fold, sum(y) AS scf, count(*) AS ncf FROM f GROUP BY 1, 2, 3),
    ct AS (SELECT c1, c2, sum(y) AS sc, count(*) AS nc FROM f GROUP BY 1, 2),
    gf AS (SELECT fold, sum(y) AS sf, count(*) AS nf, count(DISTINCT g) AS gfc FROM f GROUP BY 1),
    tt AS (SELECT sum(y) AS st, count(*) AS nt, count(DISTINCT g) AS gt FROM f),
    p AS (SELECT f.fold, y AS y_true, gfc, nt, gt,
            CASE WHEN nc - ncf > 0 THEN (sc - scf) / (nc - ncf) ELSE (st - sf) / (nt - nf) END AS y_pred
          FROM f JOIN cf ON f.c1 = cf.c1 AND f.c2 = cf.c2 AND f.fold = cf.fold
                 JOIN ct ON f.c1 = ct.c1 AND f.c2 = ct.c2
                 JOIN gf ON f.fold = gf.fold, tt),
    folds AS (SELECT cast(fold + 1 AS int) AS fold,
                sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
                avg(abs(y_true - y_pred)) AS mae,
                1 - sum((y_true - y_pred) * (y_true - y_pred)) / nullif(var_pop(y_true) * count(y_true), 0) AS r2,
                nt - count(*) AS n_train, count(*) AS n_val, gt - gfc AS n_groups_train, gfc AS n_groups_val
              FROM p GROUP BY fold, nt, gt, gfc)"""


@register("group_kfold_cell_mean", sql=recursive(with_views(_CV_SQL + " SELECT * FROM folds")),
          floats=["rmse", "mae", "r2"])
def group_kfold_cell_mean(spark, sf_dir):
    return T.group_kfold_cell_mean(cohort(spark, sf_dir), "estu_mcpio_reside", CV_CELL)


@register("fold_summary_cell_mean", sql=recursive(with_views(_CV_SQL + """
    SELECT count(*) AS n_splits, avg(rmse) AS rmse_mean, stddev_samp(rmse) AS rmse_std,
      avg(mae) AS mae_mean, avg(r2) AS r2_mean FROM folds""")),
          floats=["rmse_mean", "rmse_std", "mae_mean", "r2_mean"])
def fold_summary_cell_mean(spark, sf_dir):
    folds = T.group_kfold_cell_mean(cohort(spark, sf_dir), "estu_mcpio_reside", CV_CELL)
    return D.fold_summary(folds)
