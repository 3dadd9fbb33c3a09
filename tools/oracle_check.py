"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cohortlens.plans import queries  # noqa: E402,F401
from cohortlens.plans.registry import REGISTRY  # noqa: E402
from cohortlens.session import get_session  # noqa: E402
from cohortlens.sources.tables import DRIVER_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 4))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (list, tuple)):
        return (3, tuple(norm(x) for x in v))
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return (2, float(v))
    return (4, str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(REGISTRY)
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        qy = REGISTRY[name]
        t0 = time.time()
        try:
            sdf = qy.build(spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if not qy.sql:
            print(f"ROWS {name}: {len(srows)} rows ({dt:.1f}s, no oracle)")
            continue
        try:
            cur = con.execute(qy.sql)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            bad += 1
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}")
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diff:
                print("   spark", x)
                print("   duck ", y)
        else:
            print(f"OK   {name}: {len(a)} rows ({dt:.1f}s)")
    print(f"{bad} failing of {len(names)}")


if __name__ == "__main__":
    main()
