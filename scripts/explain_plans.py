"""Write PLANS.md: the formatted physical plan of every prediction job.

Usage: python scripts/explain_plans.py [sf_dir]   (default /root/testdata/sf0.1)
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallycast.plans import jobs  # noqa: E402
from tallycast.plans.session import local_session  # noqa: E402
from tallycast.sources import fixtures as fx  # noqa: E402

JOBS = [
    ("prediction_hour", fx.stat_events, "hour", {}),
    ("prediction_day", fx.stat_shipments, "day", {}),
    ("prediction_week", fx.stat_orders, "week", {}),
    ("prediction_week_iso", fx.stat_shipments, "week", {"iso_year": True}),
    ("prediction_month", fx.stat_orders, "month", {}),
    ("prediction_legacy_day", fx.stat_events, "legacy_day", {}),
]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = ["# Physical plans", "",
           f"`scripts/explain_plans.py` on `{sf}`, `local[8]`, AQE on. Each plan is taken after",
           "execution (`isFinalPlan=true`), so AQE's coalescing is visible. Expression ids are",
           "stripped.", ""]
    for name, fixture, grain, opts in JOBS:
        df = jobs.predict(fixture(spark, sf), grain, **opts)
        rows = df._jdf.queryExecution().toRdd()
        rows.count()  # runs this QueryExecution where the rows are, so its AQE plan becomes final
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
