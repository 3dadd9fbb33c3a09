"""Registered queries: incremental landing, co-partitioned tables, content digests, permutation without sorts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cohortlens import constants as K
from cohortlens.operators import explain as X
from cohortlens.operators import gram
from cohortlens.operators import groupagg as G
from cohortlens.plans import q_linear as L
from cohortlens.plans import roles as R
from cohortlens.plans.cohort import cohort
from cohortlens.plans.oracle import with_views
from cohortlens.plans.q_model import GROUP_COLS, LOOKUP_SQL, _lookup_select
from cohortlens.plans.registry import register
from cohortlens.session import scratch_path
from cohortlens.sources import buckets as BK
from cohortlens.sources import content, landing
from cohortlens.sources import tables as S

ID = "estu_consecutivo"
CUT = R.TRAIN_UNTIL
LATE = "cole_bilingue"   # a column that the first landed files do not have


def _new(spark, kind: str) -> str:
    return scratch_path(spark, f"{kind}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- S1, S5: landing
@register("incremental_landing", sql=with_views(f"""
    SELECT * REPLACE (CASE WHEN periodo > '{CUT}' THEN {LATE} END AS {LATE}) FROM cohort"""))
def incremental_landing(spark, sf_dir):
    """Early periods land without one column, later periods with it; two consolidations and a
    repeat give every record once, the column null where its file lacked it."""
    base = _new(spark, "increments")
    into = [f"{base}/{part}" for part in ("landed", "table", "checkpoint")]
    c = cohort(spark, sf_dir)
    c.where(F.col("periodo") <= CUT).drop(LATE).write.mode("append").parquet(into[0])
    landing.consolidate(spark, *into)
    c.where(F.col("periodo") > CUT).write.mode("append").parquet(into[0])
    landing.consolidate(spark, *into)
    landing.consolidate(spark, *into)
    return landing.read_consolidated(spark, into[1]).select(*c.columns)


# ---------------------------------------------------------------- S4, J1, J2, W4: co-partitioned tables
@register("bucketed_lookup_loo", sql=with_views(LOOKUP_SQL + _lookup_select(True) + f" WHERE periodo <= '{CUT}'"),
          floats=GROUP_COLS)
def bucketed_lookup_loo(spark, sf_dir):
    """S4 with J2/W4: the training rows and the salted lookup in the same buckets, joined without an exchange."""
    train, lookup, depto = bucketed_lookup(spark, cohort(spark, sf_dir).where(F.col("periodo") <= CUT))
    return G.apply_lookups(train, lookup, depto, leave_one_out=True, salt=BK.SALT).select(ID, *GROUP_COLS)


def bucketed_lookup(spark, rows, buckets: int = BK.BUCKETS):
    """(rows, municipality lookup, department lookup): the first two as bucketed tables."""
    run = uuid.uuid4().hex
    needed = [ID, G.MCPIO, G.DEPTO, "fami_estratovivienda", "fami_tieneinternet", "cole_naturaleza", "cole_calendario"]
    train = BK.write_bucketed(BK.with_salt(rows.select(*needed), ID), f"rows_{run}", _new(spark, "bucketed-rows"),
                              [G.MCPIO, BK.SALT], buckets)
    m, d = G.fit_lookups(train)
    lookup = BK.write_bucketed(BK.replicated(m), f"lookup_{run}", _new(spark, "bucketed-lookup"),
                               ["key", BK.SALT], buckets)
    return train, lookup, d


# ---------------------------------------------------------------- S9: content digests
@register("dataset_content_digest")
def dataset_content_digest(spark, sf_dir):
    """Digest of the bytes of every file behind the cohort (SQL sees no files; tests use hashlib)."""
    return content.content_fingerprints(spark, [S.table_path(sf_dir, t) for t in ("region", "nation", "customer", "orders")]) \
        .select("name", "n_bytes", "n_ranges", "content_sha256")


# ---------------------------------------------------------------- I5: permutation importance
def _permutation_sql() -> str:
    to = ", ".join(f"cast((cast(k AS hugeint) * {X.PERMUTATION_PRIMES[0]} + {X.permutation_offset(c)}) % n AS bigint) AS t{i}"
                   for i, c in enumerate(L.XS, 1))
    order = f"md5(concat(cast({ID} AS string), '#perm{K.SEED}'))"
    return L._sql(L.HOLDOUT + f""", s AS (SELECT {L.SUMS}, 0 AS a FROM tr), {L._fit("m", "s")},
    p0 AS (SELECT *, row_number() OVER (ORDER BY {order}, {ID}) - 1 AS k, count(*) OVER () AS n FROM te),
    p AS (SELECT *, {to} FROM p0),
    v AS (SELECT p.y, p.x1, p.x2, a.x1 AS q1, b.x2 AS q2 FROM p JOIN p a ON a.t1 = p.k JOIN p b ON b.t2 = p.k),
    e AS (SELECT sqrt(avg((y - x1 * w1 - x2 * w2 - b) ** 2)) AS r0, sqrt(avg((y - q1 * w1 - x2 * w2 - b) ** 2)) AS r1,
      sqrt(avg((y - x1 * w1 - q2 * w2 - b) ** 2)) AS r2 FROM v, m)
    SELECT '{L.XS[0]}' AS feature, r1 - r0 AS delta_rmse FROM e UNION ALL SELECT '{L.XS[1]}', r2 - r0 FROM e""")


@register("permutation_linear", sql=_permutation_sql(), floats=["delta_rmse"])
def permutation_linear(spark, sf_dir):
    """I5 of the linear learner: both features permuted by their bijections, scored in one plan."""
    tr, te = L._holdout(L._rows(spark, sf_dir))
    w, b = gram.solve(gram.total(gram.collect_grams(tr, L.XS, L.Y)), "linear")
    return X.permutation_rmse(lambda df: gram.predictions(df, L.XS, {0: (w, b)}, L.Y, keep=["__variant"]), te, L.XS, ID)
