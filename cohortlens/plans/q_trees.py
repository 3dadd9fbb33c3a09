"""Registered queries: trees by split search over prefix sums and their Shapley values, with SQL.

All complete rows are read. The SQL repeats the search with window sums, and takes Shapley values from
their definition, over all subsets of three features.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.functions import features as FX
from cohortlens.operators import diagnostics as D
from cohortlens.operators import histree as H
from cohortlens.operators import shapley as SH
from cohortlens.plans.cohort import cohort
from cohortlens.plans.oracle import with_views
from cohortlens.plans.registry import register
from cohortlens.session import cut_lineage

ID, Y = "estu_consecutivo", K.TARGET
NUM = ["fami_cuartos_num", "fami_personashogar_num", "indice_socioeconomico"]
CAT = ["fami_educacionpadre", "fami_estratovivienda"]
STEP = 0.1
M = ["rmse", "mae", "r2"]
TREE = "node int, feature string, threshold double, categories string, gain double, n_left bigint, mean_left double, n_right bigint, mean_right double"


def _rows(spark, sf_dir):
    df = FX.add_deterministic_features(cohort(spark, sf_dir)).select(ID, *NUM, *CAT, Y)
    return cut_lineage(df.na.drop(subset=[*NUM, Y]))


# ---------------------------------------------------------------- SQL
ROWS = f""", d AS (SELECT {ID}, {", ".join(f"cast({c} AS double) AS {c}" for c in NUM)},
      {", ".join(f"coalesce({c}, '') AS {c}" for c in CAT)}, cast({Y} AS double) AS y
    FROM feat WHERE {" AND ".join(f"{c} IS NOT NULL" for c in [*NUM, Y])})"""


def _cuts_sql(name: str, src: str, cats: list[str], label: str = "y") -> str:
    """CTE ``name``: the best cut of every node of ``src`` (node, features, label)."""
    hist = [f"SELECT node, '{c}' AS feature, {c} AS value, '' AS cat, count(*) AS n, sum({label}) AS s FROM {src} GROUP BY node, {c}" for c in NUM]
    hist += [f"SELECT node, '{c}', NULL, {c}, count(*), sum({label}) FROM {src} GROUP BY node, {c}" for c in cats]
    whole, along = "PARTITION BY node, feature", "PARTITION BY node, feature ORDER BY ord, cat"
    return f"""{name}_h AS ({" UNION ALL ".join(hist)}),
    {name}_o AS (SELECT *, coalesce(value, s / n) AS ord FROM {name}_h),
    {name}_w AS (SELECT *, sum(n) OVER ({along}) AS nl, sum(s) OVER ({along}) AS sl, lead(ord) OVER ({along}) AS nxt,
      sum(n) OVER ({whole}) AS nt, sum(s) OVER ({whole}) AS st FROM {name}_o),
    {name}_g AS (SELECT *, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gain FROM {name}_w WHERE nl < nt),
    {name}_r AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, ord, cat) AS place FROM {name}_g),
    {name}_b AS (SELECT * FROM {name}_r WHERE place = 1),
    {name} AS (SELECT node, feature, (value + nxt) / 2 AS threshold, gain, nl, sl, nt, st,
      (SELECT string_agg(o.cat, ',' ORDER BY o.cat) FROM {name}_o o WHERE o.node = b.node AND o.feature = b.feature AND b.value IS NULL
         AND (o.ord < b.ord OR o.ord = b.ord AND o.cat <= b.cat)) AS categories FROM {name}_b b)"""


def _left_sql(cats: list[str], row: str = "d", cut: str = "t") -> str:
    whens = " ".join(f"WHEN '{c}' THEN {row}.{c} <= {cut}.threshold" for c in NUM)
    whens += " " + " ".join(f"WHEN '{c}' THEN list_contains(string_split({cut}.categories, ','), {row}.{c})" for c in cats)
    return f"CASE {cut}.feature {whens} END"


def _two_levels(cats: list[str], label: str = "y", src: str = "d") -> str:
    return f"""d1 AS (SELECT *, 1 AS node FROM {src}), {_cuts_sql("t1", "d1", cats, label)},
    d2 AS (SELECT d.* REPLACE (CASE WHEN {_left_sql(cats, "d", "t")} THEN 2 ELSE 3 END AS node) FROM d1 d, t1 t), {_cuts_sql("t2", "d2", cats, label)},
    nodes AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2),
    leaf AS (SELECT d.*, 2 * d.node + CASE WHEN {_left_sql(cats, "d", "t")} THEN 0 ELSE 1 END AS leaf FROM d2 d JOIN t2 t ON d.node = t.node)"""


_NODES = """SELECT CAST(node AS INTEGER) AS node, feature, threshold, categories, gain, CAST(nl AS BIGINT) AS n_left, sl / nl AS mean_left,
      CAST(nt - nl AS BIGINT) AS n_right, (st - sl) / (nt - nl) AS mean_right FROM {}"""
_FLOATS = ["threshold", "mean_left", "mean_right"]


def _table(spark, tree: H.Tree):
    rows = []
    for k, t in sorted(tree.nodes.items()):
        if t.feature:
            lo, hi = tree.nodes[t.left], tree.nodes[t.right]
            rows.append((k, t.feature, t.threshold, None if t.categories is None else ",".join(t.categories), t.gain, lo.n, lo.mean, hi.n, hi.mean))
    return spark.createDataFrame(rows, TREE).drop("gain")


def _sql(body: str) -> str:
    return with_views(ROWS + ", " + body, features=True)


# ---------------------------------------------------------------- R5: trees
@register("tree_depth1", sql=_sql(f"d1 AS (SELECT *, 1 AS node FROM d), {_cuts_sql('t1', 'd1', CAT)} SELECT * EXCLUDE (gain) FROM ({_NODES.format('t1')})"),
          floats=_FLOATS)
def tree_depth1(spark, sf_dir):
    """The best cut of all rows, numbers and categories."""
    return _table(spark, H.fit_tree(_rows(spark, sf_dir), NUM, CAT, Y, depth=1))


@register("tree_depth2", sql=_sql(f"{_two_levels(CAT)} SELECT * EXCLUDE (gain) FROM ({_NODES.format('nodes')})"), floats=_FLOATS)
def tree_depth2(spark, sf_dir):
    """A tree of two levels."""
    return _table(spark, H.fit_tree(_rows(spark, sf_dir), NUM, CAT, Y, depth=2))


@register("tree_importance", sql=_sql(f"""{_two_levels(CAT)}
    SELECT feature, sum(gain) / (SELECT sum(gain) FROM nodes) AS importance FROM nodes GROUP BY feature"""), floats=["importance"])
def tree_importance(spark, sf_dir):
    """Gain importance of a tree of two levels."""
    tree = H.fit_tree(_rows(spark, sf_dir), NUM, CAT, Y, depth=2)
    return spark.createDataFrame(list(tree.importance().items()), "feature string, importance double")


@register("boosting_round", sql=_sql(f"""mu AS (SELECT avg(y) AS mu FROM d), r AS (SELECT d.*, y - mu AS e FROM d, mu),
    {_two_levels(CAT, "e", "r")}, p AS (SELECT y AS y_true, mu + {STEP} * avg(e) OVER (PARTITION BY leaf) AS y_pred FROM leaf, mu)
    SELECT sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, avg(abs(y_true - y_pred)) AS mae,
      1 - sum((y_true - y_pred) * (y_true - y_pred)) / nullif(var_pop(y_true) * count(y_true), 0) AS r2, count(*) AS n FROM p"""), floats=M)
def boosting_round(spark, sf_dir):
    """One boosting round over the mean."""
    rows = _rows(spark, sf_dir)
    model = H.fit_boosted(rows, NUM, CAT, Y, rounds=1, depth=2, step=STEP)
    return D.regression_report(rows.select(F.col(Y).cast("double").alias("y_true"), model.predict().alias("y_pred"))).select(*M, "n")


# ---------------------------------------------------------------- I1: Shapley values
def _known(mask: int) -> str:
    """Expected prediction of a two-level tree (columns of ``w``) when the features of ``mask`` are known."""
    inside = lambda f: "CASE " + f + " " + " ".join(f"WHEN '{c}' THEN {str(bool(mask >> j & 1)).lower()}" for j, c in enumerate(NUM)) + " ELSE false END"
    side = lambda k: (f"CASE WHEN {inside(f'f{k}')} THEN CASE WHEN go{k} THEN ml{k} ELSE mr{k} END "  # noqa: E731
                      f"ELSE (nl{k} * ml{k} + nr{k} * mr{k}) / (nl{k} + nr{k}) END")
    return (f"CASE WHEN {inside('f1')} THEN CASE WHEN go1 THEN {side(2)} ELSE {side(3)} END "
            f"ELSE (nl1 * ({side(2)}) + nr1 * ({side(3)})) / (nl1 + nr1) END")


def _phi(j: int) -> str:
    weight = {0: "1.0 / 3", 1: "1.0 / 6", 2: "1.0 / 3"}
    return " + ".join(f"{weight[bin(m).count('1')]} * (v{m | 1 << j} - v{m})" for m in range(8) if not m >> j & 1)


_SHAP = _two_levels([]) + ", " + ", ".join(
    f"""w{k} AS (SELECT feature AS f{k}, threshold AS h{k}, CAST(nl AS DOUBLE) AS nl{k}, CAST(nt - nl AS DOUBLE) AS nr{k}, sl / nl AS ml{k}, (st - sl) / (nt - nl) AS mr{k}
    FROM nodes WHERE node = {k})""" for k in (1, 2, 3)) + f""",
    w AS (SELECT d.*, w1.*, w2.*, w3.*, {", ".join(f"CASE f{k} " + " ".join(f"WHEN '{c}' THEN {c} <= h{k}" for c in NUM) + f" END AS go{k}" for k in (1, 2, 3))} FROM d, w1, w2, w3),
    v AS (SELECT {ID}, {", ".join(f"{_known(m)} AS v{m}" for m in range(8))} FROM w),
    phi AS (SELECT {ID}, v0 AS base, {", ".join(f"{_phi(j)} AS phi{j}" for j in range(3))} FROM v)"""


def _number_tree(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    tree = H.as_arrays(H.fit_tree(rows, NUM, None, Y, depth=2), NUM)
    return rows.select(ID, F.array(*[F.col(c).cast("double") for c in NUM]).alias("x")), tree


@register("shapley_ranking", sql=_sql(_SHAP + " " + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(abs(phi{j})) AS mean_abs FROM phi" for j, c in enumerate(NUM))),
          floats=["mean_abs"])
def shapley_ranking(spark, sf_dir):
    """Mean |Shapley value| of every feature over all rows."""
    rows, tree = _number_tree(spark, sf_dir)
    return SH.shapley_ranking(rows, [tree], [1.0], NUM)


@register("shapley_values", sql=_sql(_SHAP + f" SELECT {ID}, base, {', '.join(f'phi{j}' for j in range(3))} FROM phi"),
          floats=["base", "phi0", "phi1", "phi2"])
def shapley_values(spark, sf_dir):
    """The values of every row and the expected prediction."""
    rows, tree = _number_tree(spark, sf_dir)
    got = SH.shapley_rows(rows, [tree], [1.0], ID)
    return got.select(ID, "base", *[F.col("phi")[j].alias(f"phi{j}") for j in range(3)])
