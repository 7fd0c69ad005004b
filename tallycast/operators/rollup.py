"""Time rollups: one row per (series, period) with the summed measure.

Every rollup is a ``groupBy().agg()`` so Spark plans it as partial aggregation in
each scan task, one hash exchange on the group keys, and a final aggregation.
A hot series therefore never reaches one task as raw rows: at most one partial
row per (task, series, period) is shuffled.

Rollups accept either a normalised statistics frame (``tables.normalize``) or
*partials*, a frame already reduced to (keys..., sum columns, ``_cnt``).  Coarser
grains can then be rolled from a finer rollup instead of the raw rows, which is
what ``plans.jobs.predict_all`` does to read the raw table once for all grains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import calendar as cal
from ..functions.exact_sum import BIG, DIGITS, SUM_COLS, combined, digit_sums, with_digits
from ..sources.tables import MEASURE_COL, PART_COLS, RAW_MEASURE_COL, TYPE_COL, part_int, part_text

SUM, CNT = "_sum", "_cnt"


def _reduce(stat: DataFrame, *keys: Column) -> DataFrame:
    """One row per (series, *keys) of raw rows, or of partials to merge.

    Sums skip nulls and ``_cnt`` counts non-nulls.  Doubles are summed by
    ``exact_sum`` (columns ``SUM_COLS``), so the result does not depend on the
    layout; decimals, which are exact as they are, in ``_sum``.
    """
    if CNT in stat.columns:
        sums = digit_sums() if BIG in stat.columns else [F.sum(SUM).alias(SUM)]
        return stat.groupBy(TYPE_COL, *keys).agg(*sums, F.sum(CNT).alias(CNT))
    present = F.count(RAW_MEASURE_COL if RAW_MEASURE_COL in stat.columns else MEASURE_COL).alias(CNT)
    if isinstance(stat.schema[MEASURE_COL].dataType, DoubleType):
        return with_digits(stat, MEASURE_COL).groupBy(TYPE_COL, *keys).agg(*digit_sums(), present)
    return stat.groupBy(TYPE_COL, *keys).agg(F.sum(MEASURE_COL).alias(SUM), present)


def _sum_cols(reduced: DataFrame) -> tuple[str, ...]:
    return (*SUM_COLS, CNT) if BIG in reduced.columns else (SUM, CNT)


def partials(stat: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Reduce to one partial row per (series, *keys).

    Groups on the parts' integer values, so each period is one row however its
    parts are spelled; the padded text form is rendered on the reduced rows.
    """
    g = _reduce(stat, *[part_int(stat, k).alias(k) for k in keys])
    return g.select(TYPE_COL, *[part_text(k).alias(k) for k in keys], *_sum_cols(g))


def hour_partials(stat: DataFrame) -> DataFrame:
    """The finest rollup; every other grain can be derived from it."""
    return partials(stat, PART_COLS)


def _measured(p: DataFrame) -> DataFrame:
    """Groups with at least one numeric measure (their sum is not NULL); the sum
    (column ``_sum``) is the rollup value, selected as ``acc`` by the callers."""
    if BIG in p.columns:
        return combined(p.where(F.col(DIGITS[0]).isNotNull() | F.col(BIG).isNotNull()), SUM)
    return p.where(F.col(SUM).isNotNull())


def _acc():
    return F.col(SUM).cast("double").alias("acc")


# ------------------------------------------------------------------ TYP-1 / FLT-1

def series_types(stat: DataFrame) -> DataFrame:
    """Distinct series keys (trimmed at load)."""
    return stat.select(TYPE_COL).distinct()


def series_filter(stat: DataFrame, attack_type: str) -> DataFrame:
    """Rows of one series.

    On a normalised frame the key is ``trim(raw)``, which Parquet cannot filter
    on.  When the stored keys are known to be trimmed, ``normalize`` with
    ``trim_keys=False`` and the filter is pushed.
    """
    return stat.where(F.col(TYPE_COL) == F.lit(attack_type))


# ------------------------------------------------------------------ AGG-*

def rollup_hour(stat: DataFrame) -> DataFrame:
    """(attack_type, acc, year, month, day, hour, hour_time)."""
    r = _measured(partials(stat, PART_COLS))
    return r.select(TYPE_COL, _acc(), *PART_COLS,
                    cal.hour_label("year", "month", "day", "hour").alias("hour_time"))


def rollup_day(stat: DataFrame) -> DataFrame:
    """(attack_type, acc, day_time, year, month, day)."""
    r = _measured(partials(stat, ("year", "month", "day")))
    return r.select(TYPE_COL, _acc(), cal.day_label("year", "month", "day").alias("day_time"),
                    "year", "month", "day")


def rollup_week(stat: DataFrame, iso_year: bool = False) -> DataFrame:
    """(attack_type, week_time, acc, year).

    Default: calendar year with ISO week number, as the statistics jobs group
    it, so 2017-01-01 lands in (2017, 52).  ``iso_year=True`` groups by the ISO
    week itself (its Monday) and reports the ISO year, so (2016, 52).
    """
    day = cal.day_date(*[part_int(stat, k) for k in ("year", "month", "day")])
    if iso_year:
        r = _measured(_reduce(stat, cal.week_start(day).alias("week_start")))
        iso_y, iso_w = cal.iso_week_of("week_start")
        return r.select(TYPE_COL, iso_w.alias("week_time"), _acc(), iso_y.alias("year"), "week_start")
    g = _reduce(stat, part_int(stat, "year").alias("year"), F.weekofyear(day).alias("week_time"))
    return _measured(g).select(TYPE_COL, "week_time", _acc(), part_text("year").alias("year"))


def rollup_month(stat: DataFrame) -> DataFrame:
    """(attack_type, year, acc, month, month_time)."""
    r = _measured(partials(stat, ("year", "month")))
    return r.select(TYPE_COL, "year", _acc(), "month", cal.month_label("year", "month").alias("month_time"))


def rollup_day_count(stat: DataFrame) -> DataFrame:
    """Legacy daily rollup: number of non-null measures per day (a count, not a sum).

    (attack_type, acc bigint, year, month, day, time_hour) where ``time_hour``
    is the ``y-m-d 00:00:00`` label.  Days whose measures are all null keep a
    zero count.
    """
    r = partials(stat, ("year", "month", "day"))
    return r.select(TYPE_COL, F.col(CNT).alias("acc"), "year", "month", "day",
                    cal.midnight_label("year", "month", "day").alias("time_hour"))
