"""Period labels and calendar successors as Column expressions.

Labels are plain concatenations of the period parts ``year`` (yyyy), ``month``
(MM), ``day`` (dd) and ``hour`` (HH) as text.  Rollups hand them zero-padded
(integer parts are padded after aggregation), which is what makes a label equal
the successor label rendered from a real date.

Ordering and successors use ``timestamp_ntz``/``date`` values built from the
parts, and successors are rendered from those zone-free values with
``CAST(... AS STRING)``: ``date_format`` would first convert to a zoned
timestamp, and in a DST zone 02:00 on a spring-forward day does not exist, so
the label would come out as 03:00.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: week numbers advance modulo 52 (51 -> 0, 52 -> 1, 53 -> 2) and keep the year.
WEEK_MODULUS = 52


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int(c: Column | str) -> Column:
    return _c(c).cast("int")


# ---------------------------------------------------------------- labels

def hour_label(year, month, day, hour) -> Column:
    """``y-m-d h:00:00`` from the raw parts."""
    return F.concat(_c(year), F.lit("-"), _c(month), F.lit("-"), _c(day),
                    F.lit(" "), _c(hour), F.lit(":00:00"))


def day_label(year, month, day) -> Column:
    """``y-m-d`` from the raw parts."""
    return F.concat(_c(year), F.lit("-"), _c(month), F.lit("-"), _c(day))


def midnight_label(year, month, day) -> Column:
    """``y-m-d 00:00:00`` (legacy daily table)."""
    return F.concat(_c(year), F.lit("-"), _c(month), F.lit("-"), _c(day),
                    F.lit(" 00:00:00"))


def month_label(year, month) -> Column:
    """``ym`` from the raw parts."""
    return F.concat(_c(year), _c(month))


def week_label(week) -> Column:
    """Week number as text."""
    return _c(week).cast("string")


# ---------------------------------------------------------------- period values

# Parts that name no calendar date (month 2, day 30) give NULL whatever
# ``spark.sql.ansi.enabled`` says; the jobs leave such periods out of the series.

def hour_start(year, month, day, hour) -> Column:
    """The hour as a ``timestamp_ntz``."""
    return F.try_make_timestamp_ntz(_int(year), _int(month), _int(day), _int(hour), F.lit(0), F.lit(0))


def day_date(year, month, day) -> Column:
    return F.try_make_timestamp_ntz(_int(year), _int(month), _int(day), F.lit(0), F.lit(0), F.lit(0)).cast("date")


def month_start(year, month) -> Column:
    return day_date(year, month, F.lit(1))


def week_of_year(year, month, day) -> Column:
    """ISO-8601 week number (1..53) of the day."""
    return F.weekofyear(day_date(year, month, day))


# ---------------------------------------------------------------- successors

def next_hour(hour_ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of the next hour of a ``timestamp_ntz``."""
    return (_c(hour_ts) + F.expr("INTERVAL 1 HOUR")).cast("string")


def next_day(d: Column | str) -> Column:
    """``yyyy-MM-dd`` of the next day."""
    return F.date_add(_c(d), 1).cast("string")


def next_week_date(d: Column | str) -> Column:
    """Same weekday one week later, ``yyyy-MM-dd``."""
    return F.date_add(_c(d), 7).cast("string")


def next_week_number(week: Column | str) -> Column:
    """``(week + 1) % 52`` as an int; the year is not advanced."""
    return F.pmod(_c(week) + 1, F.lit(WEEK_MODULUS))


def next_month(month_d: Column | str) -> Column:
    """``yyyyMM`` of the month after the month starting on ``month_d``."""
    n = F.add_months(_c(month_d), 1)
    return F.concat(F.lpad(F.year(n).cast("string"), 4, "0"), F.lpad(F.month(n).cast("string"), 2, "0"))


def week_start(d: Column | str) -> Column:
    """Monday of the ISO week containing ``d`` (Spark's dayofweek: Sunday=1 .. Saturday=7)."""
    return F.date_sub(_c(d), F.pmod(F.dayofweek(_c(d)) + 5, F.lit(7)))


def iso_week_of(monday: Column | str) -> tuple[Column, Column]:
    """(ISO year as text, ISO week number) of a week given by its Monday."""
    m = _c(monday)
    return F.extract(F.lit("YEAROFWEEK"), m).cast("string"), F.weekofyear(m)


def next_iso_week(monday: Column | str) -> tuple[Column, Column]:
    """(ISO year as text, ISO week number) of the week after the given Monday."""
    return iso_week_of(F.date_add(_c(monday), 7))
