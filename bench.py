"""Benchmark the headline prediction jobs.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints one JSON line.  Each query is
executed in full through the ``noop`` sink (every row is produced, nothing is
collected to the driver); the reported time per query is the median of
``$BENCH_REPEATS`` (default 5) runs after one warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tallycast.operators import rollup as R  # noqa: E402
from tallycast.plans import jobs  # noqa: E402
from tallycast.plans.session import local_session  # noqa: E402
from tallycast.sources import fixtures as fx  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _all_grains(spark, sf):
    """Every prediction table of the events fixture from one scan (refresh_all:
    one checkpoint of the hourly partials, then five writes from 5 threads)."""
    jobs.refresh_all(fx.stat_events(spark, sf), {g: g for g in jobs.GRAINS}, fmt="noop", parallel=5)


QUERIES = {
    "prediction_hour": lambda s, sf: _run(jobs.predict(fx.stat_events(s, sf), "hour")),
    "prediction_day": lambda s, sf: _run(jobs.predict(fx.stat_shipments(s, sf), "day")),
    "prediction_week": lambda s, sf: _run(jobs.predict(fx.stat_orders(s, sf), "week")),
    "prediction_month": lambda s, sf: _run(jobs.predict(fx.stat_orders(s, sf), "month")),
    "prediction_legacy_day": lambda s, sf: _run(jobs.predict(fx.stat_events(s, sf), "legacy_day")),
    "prediction_week_iso": lambda s, sf: _run(jobs.predict(fx.stat_shipments(s, sf), "week", iso_year=True)),
    "rollup_day": lambda s, sf: _run(R.rollup_day(fx.stat_shipments(s, sf))),
    "predict_all_events": _all_grains,
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, scratch=scratch)
    for q in QUERIES.values():  # warm-up: JIT, file listing, codegen caches
        q(spark, sf)
    times = {}
    for name, q in QUERIES.items():
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            q(spark, sf)
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_label, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
