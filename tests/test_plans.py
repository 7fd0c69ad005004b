"""Physical plan shape: one scan, pruned columns, pushed key filter, two
shuffles (rollup, series) and no join for any grain."""

import pytest

from tallycast.operators import rollup as R
from tallycast.plans import jobs
from tallycast.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("grain,options", [
    ("hour", {}), ("day", {}), ("week", {}), ("week", {"iso_year": True}), ("month", {}),
    ("legacy_day", {}),
])
def test_prediction_plan_shape(spark, grain, options):
    plan = _plan(jobs.predict(fx.stat_orders(spark, SF_SMALL), grain, **options))
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert plan.count("FileScan parquet") == 1, plan
    assert "Join" not in plan and "BroadcastExchange" not in plan, plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan, plan  # JVM-side only
    assert "PushedFilters: [IsNotNull(o_orderpriority)]" in plan, plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan


def test_rollup_is_partial_then_final(spark):
    plan = _plan(R.rollup_day(fx.stat_events(spark, SF_SMALL)))
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_series_filter_reads_two_columns_less(spark):
    plan = _plan(R.rollup_hour(R.series_filter(fx.stat_events(spark, SF_SMALL), "view")))
    assert "user_id" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_predict_all_shares_one_scan(spark):
    tables = jobs.predict_all(fx.stat_events(spark, SF_SMALL))
    assert set(tables) == set(jobs.GRAINS)
    for g, df in tables.items():
        plan = _plan(df)
        # the raw table was reduced and checkpointed once; grains read the checkpoint
        assert "events.parquet" not in plan, (g, plan)
        assert df.count() >= 0


def test_day_range_prunes_partitions(spark, scratch):
    import os
    from tallycast.sources.tables import read_stat_parquet, restrict_days
    path = os.path.join(scratch, "stat_by_year")
    fx.stat_shipments(spark, SF_SMALL).write.mode("overwrite").partitionBy("year").parquet(path)
    st = restrict_days(read_stat_parquet(spark, path), "1997-03-01", "1998-02-28")
    plan = _plan(jobs.predict(st, "day"))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan, plan
    days = [r["time_day"] for r in jobs.backfill(st, "day").collect()]
    assert min(days) == "1997-03-01" and max(days) <= "1998-03-01"


@pytest.mark.parametrize("kind", ["string", "int"])
def test_day_range_is_pushed_to_the_scan(spark, scratch, kind):
    """The year bound is a pushed filter for the text parts of the contract and for integer parts."""
    import os
    from pyspark.sql import functions as F
    from tallycast.sources.tables import read_stat_parquet, restrict_days
    path = os.path.join(scratch, f"stat_year_{kind}")
    stat = fx.stat_shipments(spark, SF_SMALL)
    parts = {c: F.lpad(F.col(c).cast("string"), n, "0") if kind == "string" else F.col(c)
             for c, n in (("year", 4), ("month", 2), ("day", 2), ("hour", 2))}
    stat.withColumns(parts).write.mode("overwrite").parquet(path)
    st = restrict_days(read_stat_parquet(spark, path), "1997-03-01", "1998-02-28")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(jobs.predict(st, "day"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(year,1997)" in pushed and "LessThanOrEqual(year,1998)" in pushed, plan
    days = [r["time_day"] for r in jobs.backfill(st, "day").collect()]
    assert min(days) == "1997-03-01" and max(days) <= "1998-03-01"


def test_week_rollup_has_no_series_exchange(spark):
    plan = _plan(R.rollup_week(fx.stat_orders(spark, SF_SMALL)))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan, plan
    keys = plan.split("Exchange hashpartitioning(")[1].split("\n")[0]
    assert keys.startswith("attack_type") and keys.count("_groupingexpression") == 2, keys  # series, year, week


def test_grains_reduce_the_partials_before_they_move(spark):
    tables = jobs.predict_all(fx.stat_events(spark, SF_SMALL), ("hour", "day", "week", "month"))
    for g, df in tables.items():
        plan = _plan(df)
        assert plan.count("Exchange") == plan.count("Exchange hashpartitioning") == 2, (g, plan)
        assert "partial_sum" in plan.split("Exchange hashpartitioning")[-1], (g, plan)  # below the first exchange
    tables.release()


def test_one_grain_shares_nothing(spark):
    tables = jobs.predict_all(fx.stat_orders(spark, SF_SMALL), ("month",))
    assert _plan(tables["month"]).count("Exchange hashpartitioning") == 2
    assert "orders.parquet" in _plan(tables["month"])


def test_day_partials_suffice_without_hours(spark):
    stat = fx.stat_orders(spark, SF_SMALL)
    tables = jobs.predict_all(stat, ("day", "week", "month", "legacy_day"), iso_year=True)
    for g, df in tables.items():
        want = jobs.predict(stat, g, **({"iso_year": True} if g == "week" else {}))
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect())), g
    tables.release()


def test_refresh_all_leaves_no_partials_and_no_cache_behind(spark, scratch):
    import os
    from tallycast.plans.session import checkpoint_dir
    stat = fx.stat_events(spark, SF_SMALL)
    own = R.hour_partials(stat).persist()
    root = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    try:
        jobs.refresh_all(stat, {g: os.path.join(scratch, "left", g) for g in ("day", "month")})
        assert {x for x in os.listdir(root)} <= before | {x for x in os.listdir(root) if not x.startswith(("partials-", "rdd-"))}
        assert own.storageLevel.useMemory and "InMemoryTableScan" in _plan(R.hour_partials(stat))
    finally:
        own.unpersist()


def test_jdbc_write_keeps_the_compute_partitions(spark, monkeypatch):
    """Only the inserts run in max_connections tasks: an exchange parts them from the window stage."""
    from pyspark.sql import DataFrameWriter
    from tallycast.sources import sinks
    seen = {}
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, **k: seen.update(k, df=self._df))
    sinks.write_table(jobs.predict(fx.stat_orders(spark, SF_SMALL), "day"), "t", fmt="jdbc", url="jdbc:mysql://db/x", max_connections=2)
    frame = seen["df"]
    assert frame.rdd.getNumPartitions() == 2 and seen["properties"]["numPartitions"] == "2"
    lines = _plan(frame).split("\n")
    deal = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(time_day" in x and ", attack_type" in x and ", 2)" in x)
    window = next(i for i, x in enumerate(lines) if "Window [" in x)
    assert deal < window and "Coalesce" not in _plan(frame)
    series = next(x for x in lines[window:] if "Exchange hashpartitioning(attack_type" in x)
    assert f", {spark.conf.get('spark.sql.shuffle.partitions')})" in series


def test_integer_partition_parts_are_padded(spark, scratch):
    import os
    from tallycast.sources.tables import read_stat_parquet
    path = os.path.join(scratch, "stat_by_month")
    fx.stat_orders(spark, SF_SMALL).write.mode("overwrite").partitionBy("year", "month").parquet(path)
    st = read_stat_parquet(spark, path)
    got = sorted(map(tuple, jobs.predict(st, "month").collect()))
    want = sorted(map(tuple, jobs.predict(fx.stat_orders(spark, SF_SMALL), "month").collect()))
    assert got == want


def test_series_filter_reaches_the_scan(spark, scratch):
    """A filter on one series, applied to the finished table, is moved below the
    window and the aggregation; with trimmed stored keys Parquet evaluates it."""
    import os
    from pyspark.sql import functions as F
    from tallycast.sources.tables import read_stat_parquet
    path = os.path.join(scratch, "stat_trimmed")
    fx.stat_shipments(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    st = read_stat_parquet(spark, path, trim_keys=False)
    one = jobs.predict(st, "day").where(F.col("attack_type") == "R")
    plan = _plan(one)
    assert "EqualTo(attack_type,R)" in plan.split("PushedFilters: [")[1].split("]")[0], plan
    full = {tuple(r) for r in jobs.predict(read_stat_parquet(spark, path), "day").collect() if r["attack_type"] == "R"}
    assert {tuple(r) for r in one.collect()} == full


def _exchanges(plan):
    """(partitioning text, records written) of every shuffle in an executed plan."""
    out, stack = [], [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):  # shuffle and result stages
            stack.append(node.plan())
            continue
        if name == "Exchange":
            m = node.metrics()
            out.append((node.outputPartitioning().toString(), m.apply("shuffleRecordsWritten").value()))
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return out


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A key holding ~40% of the rows crosses the first exchange as partial
    aggregates: one row per (map task, series, hour), not one per raw row."""
    from tests.conftest import SF_ORACLE
    stat = fx.stat_events_hot(spark, SF_ORACLE)
    raw = stat.count()
    keys = stat.select("attack_type", "year", "month", "day", "hour").distinct().count()
    maps = stat.rdd.getNumPartitions()
    df = jobs.predict(stat, "hour")
    df.collect()
    shuffles = _exchanges(df._jdf.queryExecution().executedPlan())
    first = [n for p, n in shuffles if p.count(",") >= 4]  # keyed on (series, y, m, d, h)
    assert len(first) == 1 and first[0] <= keys * maps < raw, (shuffles, keys, maps, raw)
    # the second exchange (series only) carries exactly one row per (series, hour)
    second = [n for p, n in shuffles if p.count(",") == 1]
    assert second == [keys], (shuffles, keys)


@pytest.mark.parametrize("grain", ["hour", "day", "month"])
def test_forecast_window_computes_each_lag_once(spark, grain):
    plan = _plan(jobs.predict(fx.stat_orders(spark, SF_SMALL), grain))
    window = [line for line in plan.split("\n") if "Window [" in line]
    assert len(window) == 1, plan
    assert window[0].count("lag(") == 3 and window[0].count("lead(") == 2, window[0]


def test_predict_all_without_checkpoint_dir_caches_partials(spark, monkeypatch):
    """With no shared checkpoint folder the partials are cached, not re-read per grain."""
    monkeypatch.setattr(jobs, "checkpoint_dir", lambda s: None)
    stat = fx.stat_events(spark, SF_SMALL)
    tables = jobs.predict_all(stat, ("day", "month"))
    try:
        for g, df in tables.items():
            assert "InMemoryTableScan" in _plan(df), g
            assert sorted(map(tuple, df.collect())) == sorted(map(tuple, jobs.predict(stat, g).collect())), g
    finally:
        spark.catalog.clearCache()
