"""Two-phase publishing: readers see the old table or the new one, never part of either.

Parquet: a refresh is written to a folder of its own under ``versions/``, its rows are
counted from the written files and held against the count taken while writing, and
only then is the pointer file ``CURRENT`` replaced by one rename.  A job that
fails before that leaves readers on the old version.  Older versions stay for
readers that have begun, ``keep`` in all.

JDBC: the rows go to ``<table>__staging`` with the parallel writer, are counted there, and
one transaction empties the target and fills it by one ``INSERT ... SELECT``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..plans.session import drop_folder
from .sinks import write_jdbc

POINTER, VERSIONS = "CURRENT", "versions"


class RowCountMismatch(RuntimeError):
    """What was staged does not hold the rows that were computed; nothing was published."""


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the published version of the table at ``path``; None where nothing was published."""
    fs, pointer = _file_system(spark, f"{path}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, version: str) -> None:
    """Replace the pointer by one rename over it."""
    fresh = f"{path}/.{POINTER}-{uuid.uuid4().hex}"
    fs, file = _file_system(spark, fresh)
    stream = fs.create(file, False)
    stream.write(bytearray(version.encode()))
    stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(option, 1)
    how[0] = option.OVERWRITE
    files.rename(fs.makeQualified(file), fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")), how)


def versions(spark: SparkSession, path: str) -> list[str]:
    """The version folders of the table at ``path``, oldest first."""
    fs, folder = _file_system(spark, f"{path}/{VERSIONS}")
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def publish_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None, keep: int = 2) -> int:
    """Publish ``df`` as the table at ``path`` and return its number of rows; see the module doc.

    Names of versions sort by time.  Of two publishers at once the later rename
    wins, and the other's version is a past one.
    """
    spark = df.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    staged = f"{path}/{VERSIONS}/{version}"
    seen = Observation(f"staged-{version}")
    try:
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
        computed, written = seen.get["rows"], spark.read.schema(df.schema).parquet(staged).count()
        if computed != written:
            raise RowCountMismatch(f"{path}: {computed} rows computed, {written} staged")
        _point(spark, path, version)
    except BaseException:
        with suppress(Exception):  # the failure itself is what the caller must see
            drop_folder(spark, staged)
        raise
    before = [v for v in versions(spark, path) if v < version]
    for old in before[:max(0, len(before) - keep + 1)]:
        drop_folder(spark, f"{path}/{VERSIONS}/{old}")
    return written


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published version of the table at ``path``; a reader that has begun stays on its version."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no version is published at {path}")
    return spark.read.parquet(f"{path}/{VERSIONS}/{version}")


def _driver_connection(spark: SparkSession, url: str, properties: dict[str, str]):
    if "driver" in properties:
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    given = spark._jvm.java.util.Properties()
    for k, v in properties.items():
        given.setProperty(k, v)
    return spark._jvm.java.sql.DriverManager.getConnection(url, given)


def publish_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, *, batch_size: int = 10000,
                 max_connections: int = 8, connect: Callable[[], object] | None = None) -> int:
    """Publish ``df`` as the rows of ``table`` (whose columns it has) and return their number; see the module doc.

    ``connect`` gives a java.sql.Connection on the driver; by default one is
    opened with ``url`` and ``properties``.  The target keeps its definition.  Readers
    see the old rows until the commit, on databases that isolate a transaction.
    """
    spark, properties = df.sparkSession, dict(properties or {})
    staging = f"{table}__staging"
    seen = Observation(f"staged-{uuid.uuid4().hex}")
    write_jdbc(df.observe(seen, F.count(F.lit(1)).alias("rows")), url, staging, properties, batch_size=batch_size, max_connections=max_connections)
    computed, written = seen.get["rows"], spark.read.jdbc(url, staging, properties=properties).count()
    if computed != written:
        raise RowCountMismatch(f"{table}: {computed} rows computed, {written} staged")
    columns = ", ".join(df.columns)
    connection = connect() if connect else _driver_connection(spark, url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            statement.executeUpdate(f"DELETE FROM {table}")
            statement.executeUpdate(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}")
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            statement.close()
    finally:
        connection.close()
    return written
