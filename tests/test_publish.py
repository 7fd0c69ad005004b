import os

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from tallycast.plans import jobs
from tallycast.sources import fixtures as fx
from tallycast.sources import publish as P
from tallycast.sources import sinks
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_readers_stay_on_the_old_table_until_the_new_one_is_whole(spark, scratch):
    path = os.path.join(scratch, "published")
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path)
    old, new = (jobs.predict(fx.stat_events(spark, SF_SMALL), g) for g in ("day", "hour"))
    assert P.publish_parquet(old, path) == old.count()
    before = P.read_published(spark, path)
    # a task fails in the middle of the write
    half = new.repartition(4).withColumn("id", F.when(F.col("predict_count") >= 0, F.raise_error(F.lit("lost"))).otherwise(0).cast("int"))
    with pytest.raises(Exception, match="lost"):
        P.publish_parquet(half, path)
    assert rows(P.read_published(spark, path)) == rows(old) and len(P.versions(spark, path)) == 1
    assert P.publish_parquet(new, path) == new.count()
    assert rows(P.read_published(spark, path)) == rows(new)
    assert rows(before) == rows(old)  # a reader that had begun


def test_a_wrong_row_count_is_not_published(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "counted")
    P.publish_parquet(spark.range(5), path)
    real = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *p, **o: real(self, *p, **o).limit(7))
    with pytest.raises(P.RowCountMismatch):
        P.publish_parquet(spark.range(9), path)
    monkeypatch.undo()
    assert rows(P.read_published(spark, path)) == [(i,) for i in range(5)] and len(P.versions(spark, path)) == 1


def test_versions_kept_partitions_and_no_rows(spark, scratch):
    path = os.path.join(scratch, "kept")
    for n in range(5):
        P.publish_parquet(spark.range(n).withColumn("p", F.col("id") % 2), path, partition_by=["p"], keep=3)
    assert len(P.versions(spark, path)) == 3
    assert rows(P.read_published(spark, path).select("id", "p")) == [(i, i % 2) for i in range(4)]
    P.publish_parquet(spark.range(0), path)
    assert P.read_published(spark, path).count() == 0


def test_refresh_can_publish(spark, scratch):
    stat, path = fx.stat_events(spark, SF_SMALL), os.path.join(scratch, "by_refresh")
    jobs.refresh(stat, "month", path, fmt="published")
    assert rows(P.read_published(spark, path)) == rows(jobs.predict(stat, "month"))
    targets = {g: os.path.join(scratch, "all", g) for g in ("day", "month")}
    back = jobs.refresh_all(stat, targets, fmt="published")
    assert set(back) == set(targets) and all(rows(back[g]) == rows(jobs.predict(stat, g)) for g in targets)


class Database:
    """Records what the driver's connection is asked."""

    def __init__(self, fail=None):
        self.said, self.fail = [], fail

    def setAutoCommit(self, on):  # noqa: N802
        self.said.append(f"autocommit {on}")

    def createStatement(self):  # noqa: N802
        return self

    def executeUpdate(self, sql):  # noqa: N802
        self.said.append(sql)
        if self.fail and self.fail in sql:
            raise RuntimeError("database error")

    def commit(self):
        self.said.append("commit")

    def rollback(self):
        self.said.append("rollback")

    def close(self):
        self.said.append("close")


@pytest.fixture
def jdbc(spark, monkeypatch):
    """The JDBC writer and reader, captured: no database is started in tests."""
    staged = {}

    def write(self, url, table, mode=None, properties=None):
        staged.update(url=url, table=table, mode=mode, properties=properties)
        self.format("noop").mode("overwrite").save()

    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, properties=None: spark.range(staged.get("rows", 3)))
    return staged


def test_jdbc_swaps_in_one_transaction(spark, jdbc):
    db = Database()
    sinks.write_table(spark.range(3).withColumn("time_day", F.lit("x")), "t", fmt="published_jdbc", url="jdbc:x", properties={"user": "u"}, connect=lambda: db)
    assert jdbc["table"] == "t__staging" and jdbc["mode"] == "overwrite" and jdbc["properties"]["user"] == "u"
    assert db.said == ["autocommit False", "DELETE FROM t", "INSERT INTO t (id, time_day) SELECT id, time_day FROM t__staging", "commit", "close", "close"]


def test_jdbc_failures_leave_the_target(spark, jdbc):
    db = Database(fail="INSERT")
    with pytest.raises(RuntimeError, match="database error"):
        P.publish_jdbc(spark.range(3), "jdbc:x", "t", connect=lambda: db)
    assert "rollback" in db.said and "commit" not in db.said
    jdbc["rows"] = 2
    db = Database()
    with pytest.raises(P.RowCountMismatch):
        P.publish_jdbc(spark.range(3), "jdbc:x", "t", connect=lambda: db)
    assert db.said == []


def test_encoding_options_reach_the_writer(spark, jdbc):
    """The connection's encoding (SNK-4) is the caller's property, or part of the url."""
    url = "jdbc:mysql://db/x?useUnicode=true&characterEncoding=UTF-8"
    sinks.write_table(spark.range(3), "t", fmt="jdbc", url=url, properties={"characterEncoding": "UTF-8", "useUnicode": "true"})
    assert jdbc["url"] == url and jdbc["properties"]["characterEncoding"] == "UTF-8" and jdbc["properties"]["useUnicode"] == "true"
