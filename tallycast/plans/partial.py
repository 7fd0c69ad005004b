"""Late days: recompute what they change and rewrite only the partitions that hold it.

Two tables are kept.  The *partials* (one row per series and hour, partitioned by day, or
by month for long histories) are brought up to date from the raw rows of the late days
(or their months) alone, which are found by predicates on the stored period parts.  The prediction table is partitioned by the
month of its labels (column ``period``); the months that a late day can change
follow from the order of the series:

* a forecast is made from three measured periods before its own, so a day reaches the
  labels of the periods whose look-back holds it, however far gaps put them;
* the day's own label and its successor's carry its measured value, or go with it;
* a day among a series' first periods moves its seeds and where its forecasts begin.

Those months are overwritten (Spark's dynamic partition overwrite, so a failed job
leaves the others untouched) and equal those of a full refresh.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact_sum import SUM_COLS
from ..operators import rollup as R
from ..sources.tables import PART_COLS, TYPE_COL, on_days
from .jobs import TIME_COL, predict, prepared_series
from .session import drop_folder, folder_exists

PERIOD = "period"
#: Grains whose tables are large enough to be refreshed in part; the others have a row per week or month.
GRAINS = ("hour", "day")
#: Measured periods before its own that a forecast is made from.
LOOK_BACK = 3
#: Folders of the partials, by the value of ``by``.
_FOLDERS = {"day": list(PART_COLS[:3]), "month": list(PART_COLS[:2])}


def _parsed(days: list[str]) -> list[date]:
    return [date.fromisoformat(d) for d in days]


def _dynamic(df: DataFrame, path: str, columns: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


# ------------------------------------------------------------------ partials

def write_partials(stat: DataFrame, path: str, by: str = "day") -> None:
    """Keep the hourly partials of ``stat`` (whose measure is a double) at ``path``, one folder per ``by`` (day or month)."""
    _dynamic(R.hour_partials(stat).repartition(*_FOLDERS[by]), path, _FOLDERS[by])


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The partials at ``path``, their parts as the zero-padded text that the folders are named by."""
    sums = [T.StructField(c, T.DoubleType() if c == SUM_COLS[-1] else T.LongType()) for c in SUM_COLS]
    fields = [T.StructField(TYPE_COL, T.StringType()), T.StructField("hour", T.StringType()), *sums, T.StructField(R.CNT, T.LongType())]
    return spark.read.schema(T.StructType(fields + [T.StructField(c, T.StringType()) for c in PART_COLS[:3]])).parquet(path)


def update_partials(stat: DataFrame, path: str, days: list[str], by: str = "day") -> None:
    """Bring the partials of ``days`` (``yyyy-MM-dd``) up to date from the rows that ``stat`` now has for them.

    Only those days (or their months) are read; one that has no row any more loses its folder.
    """
    seen, names = Observation(), _FOLDERS[by]
    periods = sorted({d if by == "day" else d[:7] for d in days})
    fresh = R.hour_partials(on_days(stat, periods)).repartition(*names)
    _dynamic(fresh.observe(seen, F.collect_set(F.concat_ws("-", *names)).alias("periods")), path, names)
    for gone in set(periods) - set(seen.get["periods"]):
        drop_folder(stat.sparkSession, "/".join([path, *(f"{c}={v}" for c, v in zip(names, gone.split("-"), strict=True))]))


# ------------------------------------------------------------------ prediction table

def _with_period(table: DataFrame, grain: str) -> DataFrame:
    return table.withColumn(PERIOD, F.substring(TIME_COL[grain], 1, 7))


def _check(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")


def write_periods(stat: DataFrame, grain: str, path: str, **options) -> None:
    """Full refresh of the prediction table at ``path``, one folder per month of its labels."""
    _check(grain)
    _with_period(predict(stat, grain, **options), grain).repartition(PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(path)


def read_periods(spark: SparkSession, grain: str, path: str) -> DataFrame:
    """The prediction table at ``path`` without the partition column."""
    _check(grain)
    columns = f"id int, busiess_sys string, {TIME_COL[grain]} string, {TYPE_COL} string, real_count int, predict_count int, {PERIOD} string"
    return spark.read.schema(columns).parquet(path).drop(PERIOD)


def touched_periods(partials: DataFrame, grain: str, days: list[str]) -> list[str]:
    """The months (``yyyy-MM``, sorted) that hold a label which a change in ``days`` can alter."""
    _check(grain)
    prep, spec, _ = prepared_series(partials, grain)
    series = Window.partitionBy(TYPE_COL)
    ordered = series.orderBy(spec.order[0])
    late = F.array(*[F.lit(d) for d in _parsed(days)])
    rows = prep.select(
        TYPE_COL, F.col(spec.order[0]).cast("date").alias("at"), F.col(spec.next_key).cast("date").alias("after"),
        F.substring(spec.label, 1, 7).alias("own"), F.substring(spec.next_label, 1, 7).alias("next"),
        F.lag(F.col(spec.order[0]).cast("date"), LOOK_BACK).over(ordered).alias("back"), F.row_number().over(ordered).alias("rn"))
    first = LOOK_BACK + 2  # rows whose seeds or first forecast move when the series begins elsewhere
    rows = rows.select("*", F.max(F.when(F.col("rn") == first, F.col("at"))).over(series).alias("settled"))
    reached = F.exists(late, lambda d: ((d >= F.col("back")) & (d <= F.col("at"))) | (d == F.col("after")))
    start = (F.col("rn") <= first) & (F.col("settled").isNull() | F.exists(late, lambda d: d <= F.col("settled")))
    found = rows.where(reached | start).select(F.explode(F.array("own", "next")).alias(PERIOD)).distinct()
    own = {d.isoformat()[:7] for day in _parsed(days) for d in (day, day + timedelta(days=1))}
    return sorted(own | {r[PERIOD] for r in found.collect()})  # one row a month at most


def refresh_days(partials: DataFrame, grain: str, path: str, days: list[str], **options) -> list[str]:
    """Bring the prediction table at ``path`` up to date with ``partials`` after a change in ``days``.

    Returns the months that were rewritten; a month without rows loses its folder.
    ``path`` is a table that ``write_periods`` wrote.
    """
    spark, months, seen = partials.sparkSession, touched_periods(partials, grain, days), Observation()
    table = _with_period(predict(partials, grain, **options), grain).where(F.col(PERIOD).isin(months))
    _dynamic(table.repartition(PERIOD).observe(seen, F.collect_set(PERIOD).alias("months")), path, [PERIOD])
    for month in set(months) - set(seen.get["months"]):
        if folder_exists(spark, folder := f"{path}/{PERIOD}={month}"):
            drop_folder(spark, folder)
    return months
