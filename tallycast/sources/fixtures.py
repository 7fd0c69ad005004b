"""Adapters that present the driver's generated tables as statistics tables.

Each adapter reads only the columns it needs (the scan's ReadSchema shows the
pruning) and maps them onto the statistics contract: series key, double
measure, period parts (integer calendar fields).  Timestamps are read as they are stored
(``timestamp_ntz``); parts are its calendar fields, so no zone shift applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import normalize


def _parts(ts: Column) -> list[Column]:
    """Calendar fields of the timestamp as integers; rollups render them as
    zero-padded text after aggregating."""
    return [F.year(ts).alias("year"), F.month(ts).alias("month"),
            F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _as_stat(df: DataFrame, key: Column, measure: Column, ts: Column) -> DataFrame:
    return normalize(df.select(key.alias("attack_type"), measure.cast("double").alias("sum"), *_parts(ts)))


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100)


# DataFrame -> statistics rows

def events_as_stat(ev: DataFrame) -> DataFrame:
    """``events``: key ``event_type``, measure ``round(value*100)`` (whole numbers)."""
    return _as_stat(ev, F.col("event_type"), _cents("value"), F.col("ts"))


def lineitem_as_stat(li: DataFrame) -> DataFrame:
    """``lineitem``: key ``l_returnflag``, measure ``l_quantity``, period ``l_shipdate``."""
    return _as_stat(li, F.col("l_returnflag"), F.col("l_quantity"), F.col("l_shipdate"))


def orders_as_stat(od: DataFrame) -> DataFrame:
    """``orders``: key ``o_orderpriority``, measure ``round(o_totalprice*100)``."""
    return _as_stat(od, F.col("o_orderpriority"), _cents("o_totalprice"), F.col("o_orderdate"))


def events_as_user_keys(ev: DataFrame) -> DataFrame:
    """``events`` keyed by ``user_id/k`` (``k`` from ``props``): thousands of short series.

    Most keys occur once or twice, so series of length 1, 2 and 3 arise from the
    whole table without any prefix or row cap.
    """
    key = F.concat_ws("/", F.col("user_id").cast("string"), F.get_json_object("props", "$.k"))
    return _as_stat(ev, key, _cents("value"), F.col("ts"))


def events_as_hot(ev: DataFrame) -> DataFrame:
    """``events`` with ``click`` and ``view`` merged into one series ``hot``
    (about 40% of all rows): a skewed key for the same plans."""
    key = F.when(F.col("event_type").isin("click", "view"), F.lit("hot")).otherwise(F.col("event_type"))
    return _as_stat(ev, key, _cents("value"), F.col("ts"))


def _text_parts(ts: Column, padded: Column) -> list[Column]:
    """The parts as text: four and two digits where ``padded``, else without leading zeros."""
    return [F.when(padded, F.lpad(p.cast("string"), n, "0")).otherwise(p.cast("string")).alias(name)
            for p, n, name in ((F.year(ts), 4, "year"), (F.month(ts), 2, "month"), (F.dayofmonth(ts), 2, "day"), (F.hour(ts), 2, "hour"))]


def events_as_guarded(ev: DataFrame) -> DataFrame:
    """``events`` in the text-parts layout with what the jobs guard against: null
    and blank-padded keys, null measures, days of nulls only (zero counts), days of
    zeros only (zero sums, zero divisors and predecessors)."""
    user, day = F.col("user_id"), F.dayofmonth("ts")
    key = F.when(user % 11 == 0, None).when(user % 5 == 0, F.concat(F.lit("  "), "event_type", F.lit(" "))).otherwise(F.col("event_type"))
    measure = F.when(day % 7 == 3, None).when(day % 5 == 2, 0.0).when(user % 13 == 0, None).otherwise(_cents("value"))
    return normalize(ev.select(key.alias("attack_type"), measure.cast("double").alias("sum"), *_text_parts(F.col("ts"), F.lit(True))))


def events_as_spelled(ev: DataFrame) -> DataFrame:
    """``events`` in the text-parts layout, the parts of odd users without leading zeros."""
    return normalize(ev.select(F.col("event_type").alias("attack_type"), _cents("value").alias("sum"),
                               *_text_parts(F.col("ts"), F.col("user_id") % 2 == 0)))


def events_as_exact(ev: DataFrame) -> DataFrame:
    """``events`` with the unrounded ``value``, summed as decimals of six digits."""
    ts = F.col("ts")
    return normalize(ev.select(F.col("event_type").alias("attack_type"), F.col("value").alias("sum"), *_parts(ts)), exact_scale=6)


def events_as_raw_values(ev: DataFrame) -> DataFrame:
    """``events`` with the unrounded ``value`` as a double."""
    return _as_stat(ev, F.col("event_type"), F.col("value"), F.col("ts"))


def events_as_raw_table(ev: DataFrame) -> DataFrame:
    """``events`` as a raw statistics table before ``normalize``: keys as stored, text parts."""
    return ev.select(F.col("event_type").alias("attack_type"), _cents("value").alias("sum"), *_text_parts(F.col("ts"), F.lit(True)))


def lineitem_as_raw_table(li: DataFrame) -> DataFrame:
    """``lineitem`` as a raw statistics table with text parts."""
    return li.select(F.col("l_returnflag").alias("attack_type"), F.col("l_quantity").cast("double").alias("sum"), *_text_parts(F.col("l_shipdate"), F.lit(True)))


# (spark, sf_dir) -> statistics rows over the driver's tables

def stat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_stat(_table(spark, sf_dir, "events"))


def stat_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_as_stat(_table(spark, sf_dir, "lineitem"))


def stat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_as_stat(_table(spark, sf_dir, "orders"))


def stat_user_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_user_keys(_table(spark, sf_dir, "events"))


def stat_events_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_hot(_table(spark, sf_dir, "events"))


def stat_events_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_guarded(_table(spark, sf_dir, "events"))


def stat_events_spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_spelled(_table(spark, sf_dir, "events"))


def stat_events_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_exact(_table(spark, sf_dir, "events"))


def stat_events_raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_raw_values(_table(spark, sf_dir, "events"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_raw_table(_table(spark, sf_dir, "events"))


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_as_raw_table(_table(spark, sf_dir, "lineitem"))


FIXTURES = {
    "stat_events": stat_events,
    "stat_shipments": stat_shipments,
    "stat_orders": stat_orders,
    "stat_user_keys": stat_user_keys,
    "stat_events_hot": stat_events_hot,
    "stat_events_guarded": stat_events_guarded,
    "stat_events_spelled": stat_events_spelled,
    "stat_events_exact": stat_events_exact,
    "stat_events_raw_values": stat_events_raw_values,
    "raw_events": raw_events,
    "raw_shipments": raw_shipments,
}
