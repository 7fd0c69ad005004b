import os


import __spark_entry__ as entry
from tallycast.operators import rollup as R
from tallycast.plans import jobs
from tallycast.sources import fixtures as fx
from tallycast.sources.tables import normalize, select_series, spellings
from tests.conftest import SF_SMALL

SCHEMA = "attack_type string, sum double, year string, month string, day string, hour string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spellings_of_a_key_reach_the_scan(spark, scratch):
    path = os.path.join(scratch, "spelled")
    raw = [(k, 1.0, "2024", "01", "01", f"{i:02d}") for i, k in enumerate(("dos", " dos", "dos ", "scan", " scan ", "dosx", None, ""))]
    spark.createDataFrame(raw, SCHEMA).write.parquet(path)
    table = spark.read.parquet(path)
    df = R.rollup_hour(normalize(select_series(table, ["dos", "scan"])))
    assert "In(attack_type, [" in plan_of(df)
    assert sorted((r.attack_type, r.hour) for r in df.collect()) == [("dos", "00"), ("dos", "01"), ("dos", "02"), ("scan", "03"), ("scan", "04")]
    stored = os.path.join(scratch, "spellings")
    spellings(table).write.parquet(stored)
    again = select_series(table, ["dos"], spark.read.parquet(stored))
    assert "In(attack_type, [" in plan_of(again) and again.count() == 3
    assert select_series(table, ["none"]).count() == 0 and select_series(table, [""]).count() == 1
    assert select_series(table, ["dos", "scan"], most=2).count() == 5  # too many spellings: tested on the trimmed key


def test_catalog_partitions_are_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        plan = plan_of(entry.queries()["rollup_day_catalog"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    found = plan[plan.index("PartitionFilters: ["):plan.index("PushedFilters")]
    assert "month#" in found and ">= 1994" in found and "<= 1996" in found and str(1994 * 12 + 3) in found


def test_counts_cost_no_job_of_their_own(spark, scratch):
    rows = [("a", 1.0, "2024", "02", "30", "00"), ("a", None, "2024", "02", "29", "00"), ("b", 2.0, "2024", "02", "29", "01"), ("b", 2.0, "2024", "2", "29", "x")]
    stat = normalize(spark.createDataFrame(rows, SCHEMA))
    for grain, rejected in (("hour", 2), ("day", 1), ("week", 1), ("month", 0), ("legacy_day", 1)):
        found = jobs.refresh_counted(stat, grain, os.path.join(scratch, "counted", grain))
        out = spark.read.parquet(os.path.join(scratch, "counted", grain)).count()
        assert found == {"input_rows": 4, "measured_rows": 3, "rejected_rows": rejected, "output_rows": out}, grain
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    stat, used = fx.stat_events(spark, SF_SMALL), []
    for name, job in (("plain", jobs.refresh), ("counted", jobs.refresh_counted)):
        sc.setJobGroup(name, name)
        job(stat, "day", os.path.join(scratch, "jobs", name))
        used.append(len(tracker.getJobIdsForGroup(name)))
    sc._jsc.clearJobGroup()
    assert used[0] == used[1] > 0


def test_no_selection_gives_no_rows(spark):
    for grain in jobs.GRAINS:
        assert jobs.predict(R.series_filter(fx.stat_shipments(spark, SF_SMALL), "no such series"), grain).count() == 0
