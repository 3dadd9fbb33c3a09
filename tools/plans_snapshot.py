"""Write PLANS.md: formatted physical plans of a few key queries at a given scale."""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.plans import queries  # noqa: E402,F401
from cohortlens.plans.registry import REGISTRY  # noqa: E402
from cohortlens.session import get_session  # noqa: E402

KEY = ["equity_gap_by_period", "dedupe_keep_first", "group_lookup_loo", "fairness_report",
       "duplicate_rank"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    out = ["# Physical plans (explain formatted, before execution)\n",
           f"Scale: `{sf}`. Regenerate with `python tools/plans_snapshot.py <sf_dir>`.\n",
           "These are the plans before execution. Joins against fitted lookup tables\n"
           "(one row per group) appear as SortMergeJoin because their size is unknown\n"
           "until the aggregate runs; AQE re-plans them into broadcast joins at runtime\n"
           "when the materialised side is small, and keeps the shuffled join otherwise.\n"
           "Identical exchanges across branches (the cohort join feeding both a lookup\n"
           "and the rows it is applied to) are reused, so the source is shuffled once.\n"]
    for name in KEY:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            REGISTRY[name].build(spark, sf).explain("formatted")
        plan = "\n".join(ln for ln in buf.getvalue().splitlines()
                         if not ln.startswith("Location:"))
        out.append(f"\n## {name}\n\n```\n{plan.strip()}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
