"""Prediction jobs: rollup -> forecast -> backfill -> sink projection, per grain.

``predict(stat, grain)`` builds one lazy plan for every series of the table:
scan -> partial aggregate -> exchange(series, period) -> final aggregate ->
exchange(series) -> sort -> window -> generate -> project.  The only action is
the caller's (a write or a collect), so the number of Spark jobs does not grow
with the number of series.

``predict_all`` refreshes several grains from one scan: the raw table is reduced
once to partials of the finest grain asked for (one row per series and hour, or
day), which are written to the cluster's checkpoint directory (persisted where
none is set), and each grain rolls up from them: the tasks reduce the partials to
the grain's periods before anything moves.  A single grain goes straight to
``predict``.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.numeric import trunc_int
from ..operators import rollup as R
from ..operators.backfill import label_real, positional_real, with_latest_by_label
from ..operators.forecast import ACTUAL, SeriesSpec, growth_forecast, growth_terms, legacy_growth
from ..sources.sinks import read_table, write_table
from ..sources.tables import MEASURE_COL, PART_COLS, TYPE_COL, part_int
from .session import checkpoint_dir, drop_folder

GRAINS = ("hour", "day", "week", "month", "legacy_day")
TIME_COL = {"hour": "time_hour", "day": "time_day", "week": "time_week",
            "month": "time_month", "legacy_day": "time_hour"}


# ------------------------------------------------------------------ per-grain series

def prepared_series(stat: DataFrame, grain: str, *, iso_year: bool = False
                    ) -> tuple[DataFrame, SeriesSpec, DataFrame]:
    """(prepared frame, its SeriesSpec, the rollup it came from) for a grain.

    Series order is the period value; a rollup has one row per period, so the
    order is total and a recomputed task (lost executor) numbers the rows exactly
    as the first attempt did.  Periods that name no calendar date are left out
    of the series; ``rejected_periods`` lists them.
    """
    prep, spec, r = _ordered_series(stat, grain, iso_year)
    return _dated(prep, spec.order[-1]), spec, r


def _dated(prep: DataFrame, period: str) -> DataFrame:
    """The rows that have a period.  The test is on the summed value, or Catalyst
    would move it, and the calendar work with it, below the aggregation to every raw row."""
    acc = F.when(F.col(period).isNotNull(), F.col("acc"))
    counts = dict(prep.dtypes)["acc"] == "bigint"  # never null, so only a comparison holds on to the sum
    return prep.withColumn("acc", acc).where("acc >= 0" if counts else "acc IS NOT NULL")


def rejected_periods(stat: DataFrame, grain: str) -> DataFrame:
    """Rollup rows of a grain that no series holds, for their parts name no calendar date."""
    if grain == "legacy_day":
        r = R.rollup_day_count(stat)
        return r.where(cal.day_date("year", "month", "day").isNull())
    prep, spec, _ = _ordered_series(stat, grain, False)
    return prep.where(F.col(spec.order[-1]).isNull()).select(TYPE_COL, "acc", F.col(spec.label).alias("label"))


def _ordered_series(stat: DataFrame, grain: str, iso_year: bool) -> tuple[DataFrame, SeriesSpec, DataFrame]:
    if grain == "hour":
        r = R.rollup_hour(stat)
        period = cal.hour_start("year", "month", "day", "hour")
        prep = r.select(TYPE_COL, "acc", "hour_time", period.alias("_period"),
                        cal.next_hour(period).alias("_next"),
                        (period + F.expr("INTERVAL 1 HOUR")).alias("_next_key"))
        return prep, SeriesSpec(("_period",), "hour_time", "_next", "_next_key"), r
    if grain == "day":
        r = R.rollup_day(stat)
        period = cal.day_date("year", "month", "day")
        prep = r.select(TYPE_COL, "acc", "day_time", period.alias("_period"),
                        cal.next_day(period).alias("_next"), F.date_add(period, 1).alias("_next_key"))
        return prep, SeriesSpec(("_period",), "day_time", "_next", "_next_key"), r
    if grain == "month":
        r = R.rollup_month(stat)
        period = cal.month_start("year", "month")
        prep = r.select(TYPE_COL, "acc", "month_time", period.alias("_period"),
                        cal.next_month(period).alias("_next"), F.add_months(period, 1).alias("_next_key"))
        return prep, SeriesSpec(("_period",), "month_time", "_next", "_next_key"), r
    if grain == "week":
        r = R.rollup_week(stat, iso_year=iso_year)
        if iso_year:
            nxt_year, nxt_week = cal.next_iso_week("week_start")
            prep = r.select(TYPE_COL, "acc", "year", cal.week_label("week_time").alias("_label"),
                            "week_start", nxt_week.cast("string").alias("_next"),
                            nxt_year.alias("_next_year"), F.date_add("week_start", 7).alias("_next_key"))
            spec = SeriesSpec(("week_start",), "_label", "_next", "_next_key",
                              year="year", next_year="_next_year")
            return prep, spec, r
        prep = r.select(TYPE_COL, "acc", "year", "week_time",
                        cal.week_label("week_time").alias("_label"),
                        cal.next_week_number("week_time").cast("string").alias("_next"))
        spec = SeriesSpec(("year", "week_time"), "_label", "_next", year="year", seed_year_first=True)
        return prep, spec, r
    raise ValueError(f"no growth series for grain {grain!r}")


def forecast_rows(stat: DataFrame, grain: str, *, ratio: str | None = None,
                  dedupe_seeds: bool = False, iso_year: bool = False,
                  emit: tuple[str, ...] = ("seed", "forecast"),
                  markers: bool = False) -> tuple[DataFrame, DataFrame]:
    """(forecast rows with ``time`` and ``_actual``, rollup) for hour/day/week/month."""
    if grain != "hour" and ratio not in (None, "forward"):
        raise ValueError("ratio='inverse' exists for hours only")
    prep, spec, r = prepared_series(stat, grain, iso_year=iso_year)
    month = grain == "month"
    rows = growth_forecast(prep, spec, ratio=_ratio(grain, ratio),
                           seed3=not month or dedupe_seeds,
                           repeat_seeds=month and not dedupe_seeds,
                           provisional_actual=month, emit=emit, markers=markers)
    return rows, r


def growth(stat: DataFrame, grain: str, ratio: str | None = None) -> DataFrame:
    """Ratio sums behind every forecast row: (attack_type, time, growth, predict_count)."""
    prep, spec, _ = prepared_series(stat, grain)
    return growth_terms(prep, spec, ratio=_ratio(grain, ratio))


def unmatched_forecasts(stat: DataFrame, grain: str, **options) -> DataFrame:
    """Forecast rows whose label has no measured period (interior gaps, and the
    final successor of each series): (attack_type, time_<grain>, predict_count)."""
    rows, _ = forecast_rows(stat, grain, emit=("forecast",), **options)
    return rows.where(F.col(ACTUAL).isNull()).select(
        TYPE_COL, F.col("time").alias(TIME_COL[grain]), "predict_count")


def _legacy_rows(stat: DataFrame) -> DataFrame:
    r = R.rollup_day_count(stat)
    prep = r.withColumn("_day", cal.day_date("year", "month", "day"))
    return legacy_growth(_dated(prep, "_day"), order=("_day",))


# ------------------------------------------------------------------ public jobs

def _check(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")


def _ratio(grain: str, ratio: str | None) -> str:
    return ratio or ("inverse" if grain == "hour" else "forward")


def forecast(stat: DataFrame, grain: str, *, ratio: str | None = None,
             dedupe_seeds: bool = False, iso_year: bool = False) -> DataFrame:
    """Forecast rows as first written, before backfill.

    Columns: attack_type, time_<grain>, real_count, predict_count (+ year for weeks).
    Options: ``ratio`` ('inverse' default for hours, 'forward' otherwise; hours
    only), ``dedupe_seeds`` (months: seeds once, plus the fourth seed),
    ``iso_year`` (weeks: ISO week-year grouping, labels and backfill).
    """
    _check(grain)
    if grain == "legacy_day":
        return _legacy_rows(stat)
    rows, _ = forecast_rows(stat, grain, ratio=ratio, dedupe_seeds=dedupe_seeds, iso_year=iso_year)
    return _finish(rows, grain)


def _finish(rows: DataFrame, grain: str, real: Column | None = None, sink: bool = False) -> DataFrame:
    """One projection to the output layout: forecast/backfill columns, or with
    ``sink`` the prediction table's (id, busiess_sys, time_<grain>, ...)."""
    real = (F.col("real_count") if real is None else real).alias("real_count")
    time = F.col("time").alias(TIME_COL[grain])
    year = ["year"] if "year" in rows.columns else []
    if sink:
        return rows.select(F.lit(0).alias("id"), F.lit("0").alias("busiess_sys"), time, TYPE_COL,
                           real, "predict_count", *year)
    return rows.select(TYPE_COL, time, real, "predict_count", *year)


def _backfilled(stat: DataFrame, grain: str, *, sink: bool, ratio: str | None = None,
                dedupe_seeds: bool = False, iso_year: bool = False) -> DataFrame:
    _check(grain)
    if grain == "legacy_day":  # the legacy job never backfills
        rows = _legacy_rows(stat)
        return prediction_table(rows, grain) if sink else rows
    by_label = grain == "week" and not iso_year
    rows, _ = forecast_rows(stat, grain, ratio=ratio, dedupe_seeds=dedupe_seeds,
                            iso_year=iso_year, markers=by_label)
    if by_label:
        return _finish(with_latest_by_label(rows), grain, label_real(), sink)
    return _finish(rows, grain, positional_real(), sink)


def backfill(stat: DataFrame, grain: str, **options) -> DataFrame:
    """Forecast rows with actuals filled in (same columns as ``forecast``)."""
    return _backfilled(stat, grain, sink=False, **options)


def prediction_table(filled: DataFrame, grain: str) -> DataFrame:
    """Sink layout: id, busiess_sys, time_<grain>, attack_type, real_count, predict_count[, year]."""
    t = TIME_COL[grain]
    real = "real_count"
    if dict(filled.dtypes)[real] == "bigint":  # legacy counts: the sink's column is an int like the other grains'
        real = trunc_int(real).alias(real)
    cols = [F.lit(0).alias("id"), F.lit("0").alias("busiess_sys"), t, TYPE_COL, real, "predict_count"]
    if "year" in filled.columns:
        cols.append("year")
    return filled.select(*cols)


def predict(stat: DataFrame, grain: str, **options) -> DataFrame:
    """The full prediction table of one grain, ready for ``sinks.write_table``."""
    return _backfilled(stat, grain, sink=True, **options)


class Tables(dict):
    """Prediction tables by grain, and ``release()`` for the partials that they share."""

    def __init__(self, tables: dict[str, DataFrame], release=lambda: None):
        super().__init__(tables)
        self.release = release


def predict_all(stat: DataFrame, grains=GRAINS, *, materialize: bool = True, **options) -> Tables:
    """Prediction tables of several grains from a single scan of ``stat``.

    The partials are the only thing shared.  With a checkpoint directory
    configured (``spark.checkpoint.dir``) they are written there once (any
    executor can be lost) and every grain reads that small table instead of the
    raw rows; without one they are persisted (memory and disk).  Call
    ``release()`` when the tables have been written.  ``materialize=False``
    gives the plans alone.  One grain shares nothing: it is ``predict``.
    """
    grains = tuple(grains)
    chosen = {g: options_for(g, options) for g in grains}
    if len(grains) == 1:
        return Tables({g: predict(stat, g, **chosen[g]) for g in grains})
    base, release = R.partials(stat, PART_COLS if "hour" in grains else PART_COLS[:3]), lambda: None
    spark = stat.sparkSession
    if materialize and (root := checkpoint_dir(spark)) is not None:
        path = f"{root}/partials-{uuid.uuid4().hex}"
        base.write.parquet(path)
        base, release = spark.read.schema(base.schema).parquet(path), lambda: drop_folder(spark, path)
    elif materialize:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
        release = base.unpersist
    return Tables({g: predict(base, g, **chosen[g]) for g in grains}, release)


# which grain each option applies to
_OPTION_GRAIN = {"ratio": "hour", "dedupe_seeds": "month", "iso_year": "week"}


def options_for(grain: str, options: dict) -> dict:
    """The subset of ``options`` that applies to ``grain``."""
    unknown = set(options) - set(_OPTION_GRAIN)
    if unknown:
        raise ValueError(f"unknown options {sorted(unknown)}")
    return {k: v for k, v in options.items() if _OPTION_GRAIN[k] == grain}


def refresh(stat: DataFrame, grain: str, target: str, *, fmt: str = "parquet",
            sink_options: dict | None = None, **options) -> DataFrame:
    """One prediction job: every series of ``stat`` at ``grain``, written once to
    ``target`` (a Parquet path, a JDBC table with ``sink_options`` url/properties,
    or a catalog table).  Returns the written table's DataFrame."""
    table = predict(stat, grain, **options)
    write_table(table, target, fmt=fmt, **(sink_options or {}))
    return table


def refresh_counted(stat: DataFrame, grain: str, target: str, *, fmt: str = "parquet",
                    sink_options: dict | None = None, **options) -> dict[str, int]:
    """``refresh``, and the counts of what passed through it, taken on the way by the same job:
    ``input_rows``, ``measured_rows`` (with a measure), ``rejected_rows`` (in no
    series, for their parts name no calendar date) and ``output_rows``."""
    _check(grain)
    read, wrote = Observation(), Observation()
    parts = [part_int(stat, c) for c in PART_COLS]
    period = cal.hour_start(*parts) if grain == "hour" else cal.month_start(*parts[:2]) if grain == "month" else cal.day_date(*parts[:3])
    seen = stat.observe(read, F.count(F.lit(1)).alias("input_rows"), F.count(MEASURE_COL).alias("measured_rows"),
                        F.count_if(period.isNull()).alias("rejected_rows"))
    table = predict(seen, grain, **options).observe(wrote, F.count(F.lit(1)).alias("output_rows"))
    write_table(table, target, fmt=fmt, **(sink_options or {}))
    return {**read.get, **wrote.get}


def refresh_all(stat: DataFrame, targets: dict[str, str], *, fmt: str = "parquet",
                sink_options: dict | None = None, parallel: int = 1,
                **options) -> dict[str, DataFrame]:
    """Several grains from one scan (``predict_all``), each written to its target.

    The writes are independent Spark jobs; with ``parallel > 1`` they are
    submitted from that many driver threads and share the executors.  The shared
    partials and their files are removed at the end.  Returns lazy frames over what
    was written, for the targets that Spark reads without a connection.
    """
    tables = predict_all(stat, tuple(targets), **options)

    def write(g: str) -> None:
        write_table(tables[g], targets[g], fmt=fmt, **(sink_options or {}))

    try:
        if parallel > 1:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                list(pool.map(write, tables))
        else:
            for g in tables:
                write(g)
    finally:
        tables.release()
    spark = stat.sparkSession
    return {g: back for g, target in targets.items() if (back := read_table(spark, target, fmt=fmt)) is not None}
