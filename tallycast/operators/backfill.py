"""Backfill: put each period's measured count next to its prediction.

The prediction table is first written with a provisional ``real_count`` (0, or
the last actual for months) and then every row whose label has a measured
period takes ``trunc(acc)`` of that period.  That is a left join of forecast
rows to rollup rows on (series, label).

For hour, day, month (and ISO weeks) the join is positional instead: rollups
hold one row per period (they group on integer parts), so a seed row's period is
its own rollup row, and a forecast row's successor period is either the very
next row of the series or absent (a gap).  The forecast window
already carries ``lead`` of the next row, so backfill is a projection: no join,
no shuffle.

Calendar weeks cannot use that: their label is a week number without a year
(``(w + 1) % 52``), and a label takes the value of the *latest* year that has
that week.  For them the forecast pass also emits one marker row per rollup
period, and a window over (series, label) hands the latest marker's value to
every row with that label.  The frame is already hash-partitioned by series,
which satisfies the (series, label) clustering, so this costs a local sort and
no shuffle; a (series, label) group holds at most two rows per year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import trunc_int
from ..sources.tables import TYPE_COL
from .forecast import ACTUAL, MARK_YEAR


def positional_real() -> Column:
    """real_count := trunc(_actual) where the label has a measured period."""
    return F.coalesce(trunc_int(ACTUAL), F.col("real_count"))


def with_latest_by_label(rows: DataFrame) -> DataFrame:
    """Forecast rows (markers dropped) with ``_latest``: the value of the
    latest-year marker carrying the same label."""
    same_label = Window.partitionBy(TYPE_COL, "time")
    latest = F.max_by(F.col(ACTUAL), F.col(MARK_YEAR)).over(same_label)
    return rows.select("*", latest.alias("_latest")).where(F.col(MARK_YEAR).isNull())


def label_real() -> Column:
    """real_count := trunc(_latest) where some year has the label's week."""
    return F.coalesce(trunc_int("_latest"), F.col("real_count"))
