"""Shared helpers: tables in the shared folder, id filters whose broadcast is size-checked."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.plans.session import checkpoint_dir, drop_folder

#: Ids broadcast by ``filter_ids`` at most (16 MB of longs); more are joined by shuffle.
BROADCAST_IDS = 1_000_000


_PASSING: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("passing", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a folder of this machine only where none is set and all tasks run here (tests)."""
    root = checkpoint_dir(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallycast-llm-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def stored(df: DataFrame, name: str, passes: bool = True) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: cuts lineage and survives lost executors.

    Inside ``passing`` the table goes with it, unless ``passes`` is false.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if passes and (paths := _PASSING.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``stored`` inside are deleted at the end.  What outlives them must be stored outside."""
    token = _PASSING.set([])
    try:
        yield
    finally:
        paths = _PASSING.get()
        _PASSING.reset(token)
        for path in paths:
            drop_folder(spark, path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def filter_ids(df: DataFrame, ids: DataFrame, key: str, keep: bool) -> DataFrame:
    """Rows of ``df`` whose ``key`` is (``keep``) or is not in the one column of ``ids`` (distinct, stored).

    The ids are broadcast only when they are counted at ``BROADCAST_IDS`` or
    fewer, else joined by shuffle.  A null key is in no list.
    """
    right = ids.select(F.col(ids.columns[0]).alias("_id"))
    if ids.count() <= BROADCAST_IDS:
        right = F.broadcast(right)
    return df.join(right, df[f"`{key}`"] == right["_id"], "left_semi" if keep else "left_anti")


def small_side(df: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """A stored table of a few longs a row, to be broadcast in a join where it is counted at ``rows`` or fewer."""
    return F.broadcast(df) if df.count() <= rows else df


def hash_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The ``rows`` rows of smallest ``key``, a 64-bit hash of columns that no large group shares.

    All but some 4 * ``rows`` rows are put aside by the hash where they are read,
    so what a task sends on does not grow with the number of tasks.
    """
    n, place = df.count(), key.bitwiseAND(F.lit((1 << 63) - 1))
    if n > 8 * rows:
        df = df.where(place < F.lit(int(4 * rows / n * (1 << 63))))
    return df.orderBy(place, *df.columns).limit(rows)


def as_often(df: DataFrame, times: str, block: int = 4096) -> DataFrame:
    """Each row as often as its column ``times`` (a long, 1 or more) says, without that column.

    A row's copies are dealt out in blocks, so that those of one row are not all written by one task.
    """
    at, parts = unused(df, "block"), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = df.withColumn(at, F.explode(F.expr(f"sequence(0L, (`{times}` - 1) div {block})"))).repartition(parts)
    return blocks.withColumn(at, F.explode(F.expr(f"sequence(1L, least({block}L, `{times}` - `{at}` * {block}))"))).drop(at, times)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
