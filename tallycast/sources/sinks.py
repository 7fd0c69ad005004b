"""Full-refresh sinks for prediction tables.

The statistics jobs replace the whole prediction table each run.  Here the
final rows are computed first and written once, in parallel from the
executors:

* JDBC: ``mode("overwrite")`` with ``truncate=true`` keeps the table definition
  (indexes, grants) and replaces its rows; inserts are batched per partition.
  The finished rows are dealt into ``max_connections`` partitions by an exchange
  first, so the database's limit bounds the inserts alone and the stages that
  compute the rows keep their own partitions.
* Parquet: ``mode("overwrite")`` of a directory; Spark's commit protocol makes
  a retried task (lost executor) write its output exactly once.

Both empty the target before it is filled.  ``publish`` has the two-phase forms,
which readers never see half-done.

Connection properties (user, password) are passed through and never logged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import TYPE_COL


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, *,
               batch_size: int = 10000, max_connections: int = 8) -> None:
    """Replace the rows of ``table`` with ``df`` (truncate, then batched inserts)."""
    props = dict(properties or {})
    props.setdefault("truncate", "true")
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("numPartitions", str(max_connections))
    keys = [c for c in df.columns if c == TYPE_COL or c.startswith("time_")]
    df.repartition(int(props["numPartitions"]), *keys).write.jdbc(url=url, table=table, mode="overwrite", properties=props)


def write_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    """Replace the Parquet table at ``path`` with ``df``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, target: str, *, fmt: str = "parquet") -> DataFrame | None:
    """What ``write_table`` wrote to ``target``, lazily; None for databases and 'noop'."""
    if fmt == "parquet":
        return spark.read.parquet(target)
    if fmt == "published":
        from .publish import read_published

        return read_published(spark, target)
    return spark.table(target) if fmt == "table" else None


def write_table(df: DataFrame, target: str, *, fmt: str = "parquet", **options) -> None:
    """Dispatch on ``fmt``: 'parquet' (target = path), 'jdbc' (target = table,
    options url/properties), 'published' and 'published_jdbc' (the same targets in
    two phases, see ``publish``), 'table' (catalog table, ``saveAsTable``) or 'noop'
    (benchmarks)."""
    from . import publish  # which builds on this module

    if fmt == "parquet":
        write_parquet(df, target, partition_by=options.get("partition_by"))
    elif fmt == "jdbc":
        write_jdbc(df, options["url"], target, options.get("properties"),
                   batch_size=options.get("batch_size", 10000),
                   max_connections=options.get("max_connections", 8))
    elif fmt == "published":
        publish.publish_parquet(df, target, partition_by=options.get("partition_by"), keep=options.get("keep", 2))
    elif fmt == "published_jdbc":
        publish.publish_jdbc(df, options["url"], target, options.get("properties"), batch_size=options.get("batch_size", 10000),
                             max_connections=options.get("max_connections", 8), connect=options.get("connect"))
    elif fmt == "table":
        df.write.mode("overwrite").saveAsTable(target)
    elif fmt == "noop":  # benchmarking: run the whole plan, keep nothing
        df.write.format("noop").mode("overwrite").save()
    else:
        raise ValueError(f"unknown sink format {fmt!r}")
