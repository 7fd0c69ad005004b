import os

import pytest
from pyspark.sql import DataFrameWriter

from tallycast.plans import jobs
from tallycast.sources import fixtures as fx
from tallycast.sources import sinks
from tests.conftest import SF_SMALL


def test_parquet_refresh_is_idempotent(spark, scratch):
    table = jobs.predict(fx.stat_events(spark, SF_SMALL), "day")
    path = os.path.join(scratch, "prediction_day")
    sinks.write_table(table, path)
    once = sorted(map(tuple, spark.read.parquet(path).collect()))
    sinks.write_table(table, path)
    twice = sorted(map(tuple, spark.read.parquet(path).collect()))
    assert once == twice == sorted(map(tuple, table.collect()))


def test_parquet_partitioned(spark, scratch):
    table = jobs.predict(fx.stat_shipments(spark, SF_SMALL), "week")
    path = os.path.join(scratch, "prediction_week")
    sinks.write_table(table, path, partition_by=["year"])
    back = spark.read.schema(table.schema).parquet(path).select(*table.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def test_jdbc_options(spark, monkeypatch):
    """The JDBC writer is called with truncate-overwrite and batching options.

    No database is started in tests; the call is captured instead."""
    seen = {}

    def fake_jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties)

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    df = spark.range(3)
    sinks.write_table(df, "prediction_hourly_stat", fmt="jdbc", url="jdbc:mysql://db/x",
                      properties={"user": "u", "password": "p"}, max_connections=4)
    assert seen["mode"] == "overwrite" and seen["table"] == "prediction_hourly_stat"
    assert seen["properties"]["truncate"] == "true"
    assert seen["properties"]["numPartitions"] == "4"
    assert seen["properties"]["user"] == "u"


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), "x", fmt="csvx")


def test_refresh_jobs_write_prediction_tables(spark, scratch):
    stat = fx.stat_events(spark, SF_SMALL)
    root = os.path.join(scratch, "refresh")
    one = jobs.refresh(stat, "hour", os.path.join(root, "hour_only"))
    assert sorted(map(tuple, spark.read.parquet(os.path.join(root, "hour_only")).collect())) == \
        sorted(map(tuple, one.collect()))
    targets = {g: os.path.join(root, g) for g in ("day", "month", "legacy_day")}
    jobs.refresh_all(stat, targets, parallel=3)
    for g, path in targets.items():
        back = sorted(map(tuple, spark.read.parquet(path).collect()))
        assert back == sorted(map(tuple, jobs.predict(stat, g).collect())), g


def test_unknown_option_is_rejected(spark):
    with pytest.raises(ValueError):
        jobs.predict_all(fx.stat_events(spark, SF_SMALL), ("day",), ratios="forward")


def test_catalog_table_refresh(spark):
    table = jobs.predict(fx.stat_events(spark, SF_SMALL), "month")
    sinks.write_table(table, "tc_prediction_monthly_stat", fmt="table")
    sinks.write_table(table, "tc_prediction_monthly_stat", fmt="table")  # refresh replaces
    back = spark.table("tc_prediction_monthly_stat")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))
