"""Lost tasks are recomputed to the same result.

Runs in its own process: local mode only retries tasks with a ``local[N,F]``
master, and the session fixture's context is already running.  A task is made
to fail on its first attempt (i) in the scan stage, below the rollup, and (ii)
downstream of the forecast window, so the retried task recomputes from shuffle
output; both runs must equal a clean run.
"""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys, tempfile
    sys.path.insert(0, {root!r})
    from pyspark.sql import SparkSession
    from tallycast.plans import jobs
    from tallycast.sources import fixtures as fx

    spark = (SparkSession.builder.master("local[4,2]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    def flaky(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
            raise RuntimeError("injected task failure")
        yield from batches

    stat = fx.stat_shipments(spark, "/root/testdata/sf0.001")
    rows = lambda df: sorted(map(tuple, df.collect()))
    for grain in ("hour", "day", "week", "month", "legacy_day"):
        clean = rows(jobs.predict(stat, grain))
        upstream = rows(jobs.predict(stat.mapInPandas(flaky, stat.schema), grain))
        table = jobs.predict(stat, grain)
        downstream = rows(table.mapInPandas(flaky, table.schema))
        assert clean == upstream == downstream, grain
        print("ok", grain, len(clean))
    spark.stop()
""")


def test_failed_tasks_recompute_identically():
    proc = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], capture_output=True,
                          text=True, timeout=600, cwd=ROOT)
    assert proc.returncode == 0, proc.stderr[-3000:]
    assert [line.split()[1] for line in proc.stdout.splitlines() if line.startswith("ok ")] == \
        ["hour", "day", "week", "month", "legacy_day"]
