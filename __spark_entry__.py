"""

``entry(spark)`` runs the flagship job (hourly prediction table) on sf0.001.
the driver's tables (whole tables, via the fixture adapters in
``tallycast.sources.fixtures``); ``oracle_sql()`` gives the same result as
and explicit joins rather than the positional tricks the Spark side uses).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallycast.functions import calendar as cal  # noqa: E402
from tallycast.operators import rollup as R  # noqa: E402
from tallycast.plans import jobs  # noqa: E402
from tallycast.sources import fixtures as fx  # noqa: E402
from tallycast.sources.tables import normalize, restrict_days, select_series  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the hourly prediction table of every event type (sf0.001)."""
    return jobs.predict(fx.stat_events(spark, SMOKE_DIR), "hour")


# ====================================================================== Spark side

def _q(fixture: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    make = fx.FIXTURES[fixture]
    return lambda spark, sf_dir: build(make(spark, sf_dir))


def _next_hour(st):
    r = R.rollup_hour(st)
    return r.select("attack_type", "hour_time",
                    cal.next_hour(cal.hour_start("year", "month", "day", "hour")).alias("next_hour"))


def _next_day(st):
    r = R.rollup_day(st)
    return r.select("attack_type", "day_time",
                    cal.next_day(cal.day_date("year", "month", "day")).alias("next_day"))


def _next_week_date(st):
    r = R.rollup_day(st)
    return r.select("attack_type", "day_time",
                    cal.next_week_date(cal.day_date("year", "month", "day")).alias("next_week_date"))


def _next_week_number(st):
    r = R.rollup_week(st)
    return r.select("attack_type", "year", "week_time",
                    cal.next_week_number("week_time").alias("next_week"))


def _next_month(st):
    r = R.rollup_month(st)
    return r.select("attack_type", "month_time",
                    cal.next_month(cal.month_start("year", "month")).alias("next_month"))


def _sql_view_daily(st):
    from tallycast.plans.views import register_views
    register_views(st, prefix="tc_shipments_", grains=("day",))
    return st.sparkSession.sql(
        "SELECT attack_type, time_day, real_count, predict_count FROM tc_shipments_prediction_day "
        "WHERE real_count > predict_count")


def _seed_rows(st):
    rows, _ = jobs.forecast_rows(st, "day", emit=("seed",))
    return rows.select("attack_type", F.col("time").alias("time_day"), "predict_count")


def _growth_classes(st):
    """How many of each series' forecast ratios are infinite, NaN or finite, by ratio."""
    out = None
    for ratio in ("forward", "inverse"):
        g = jobs.growth(st, "hour", ratio=ratio)
        inf, nan = F.col("growth").isin(float("inf"), float("-inf")), F.isnan("growth")
        part = g.groupBy("attack_type").agg(
            F.sum(inf.cast("long")).alias("n_infinite"), F.sum(nan.cast("long")).alias("n_nan"),
            F.sum((~inf & ~nan).cast("long")).alias("n_finite"), F.sum(F.col("predict_count").cast("long")).alias("predicted"),
        ).select("attack_type", F.lit(ratio).alias("ratio"), "n_infinite", "n_nan", "n_finite", "predicted")
        out = part if out is None else out.unionByName(part)
    return out


def _shared_path(spark, name):
    """A new folder's path in the folder that the driver and all executors share."""
    import uuid

    from tallycast.plans.session import checkpoint_dir
    return f"{checkpoint_dir(spark) or 'checkpoints'}/{name}-{uuid.uuid4().hex}"


def _published(st):
    """The monthly table, published after another version and read through the pointer."""
    from tallycast.sources.publish import publish_parquet, read_published
    path = _shared_path(st.sparkSession, "published")
    publish_parquet(jobs.predict(st, "day"), path)
    publish_parquet(jobs.predict(st, "month"), path)
    return read_published(st.sparkSession, path)


LATE_DAY = "1995-03-17"


def _late_day(raw):
    """The daily table as it is after a full refresh without one day, and a partial refresh when that day has come."""
    from tallycast.plans import partial
    spark, stat = raw.sparkSession, normalize(raw)
    partials, table = _shared_path(spark, "partials"), _shared_path(spark, "prediction")
    before = stat.where(~((F.col("year") == LATE_DAY[:4]) & (F.col("month") == LATE_DAY[5:7]) & (F.col("day") == LATE_DAY[8:])))
    partial.write_partials(before, partials, by="month")
    partial.write_periods(partial.read_partials(spark, partials), "day", table)
    partial.update_partials(stat, partials, [LATE_DAY], by="month")
    partial.refresh_days(partial.read_partials(spark, partials), "day", table, [LATE_DAY])
    return partial.read_periods(spark, "day", table)


def _catalog_days(raw):
    """A day range of a catalog table that is partitioned by text years and months."""
    import uuid

    from tallycast.sources.tables import read_stat_table
    spark, name = raw.sparkSession, f"tallycast_stat_{uuid.uuid4().hex}"
    raw.repartition("year", "month").write.partitionBy("year", "month").option("path", _shared_path(spark, "stat")).saveAsTable(name)
    return R.rollup_day(restrict_days(read_stat_table(spark, name), "1994-03-01", "1996-02-15"))


def _counts(st):
    """The counts of a refresh, taken by the job itself."""
    found = jobs.refresh_counted(st, "hour", "", fmt="noop")
    return st.sparkSession.createDataFrame([found], "input_rows long, measured_rows long, rejected_rows long, output_rows long")


def _growth(ratio):
    def build(st):
        return jobs.growth(st, "hour", ratio=ratio).withColumnRenamed("time", "time_hour")
    return build


def _optional(module: str):
    """A module of the training-data part, or None where that part is not installed.

    Only the absence of ``tallycast.llm`` or ``corpus_pipeline`` itself is
    passed over; an error inside either is raised.
    """
    import importlib

    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as e:
        if e.name not in ("tallycast.llm", "tallycast.llm.queries", "corpus_pipeline"):
            raise
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm, pipeline = _optional("tallycast.llm.queries"), _optional("corpus_pipeline")
    return (_engine_queries() | (llm.queries() if llm else {})
            | ({"pipeline": pipeline.run} if llm and pipeline else {}))


def _engine_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # TYP-1, SC-2 / FLT-1, PRJ-1
        "series_types": _q("stat_events", R.series_types),
        "series_filter": _q("stat_events", lambda st: R.rollup_hour(R.series_filter(st, "view"))),
        # SRC-3: temp views queried through Spark SQL
        "sql_view_daily": _q("stat_shipments", _sql_view_daily),
        # AGG-*, LBL-*, PRJ-2
        "rollup_hour": _q("stat_events", R.rollup_hour),
        "rollup_day": _q("stat_shipments", R.rollup_day),
        "rollup_week": _q("stat_shipments", R.rollup_week),
        "rollup_week_iso": _q("stat_shipments", lambda st: R.rollup_week(st, iso_year=True).drop("week_start")),
        "rollup_month": _q("stat_shipments", R.rollup_month),
        "rollup_day_count": _q("stat_events", R.rollup_day_count),
        # NXT-*, SC-4/5/8/10
        "next_hour": _q("stat_events", _next_hour),
        "next_day": _q("stat_shipments", _next_day),
        "next_week_date": _q("stat_shipments", _next_week_date),
        "next_week_number": _q("stat_shipments", _next_week_number),
        "next_month": _q("stat_shipments", _next_month),
        # SC-7 and the ratio halves of FC-*
        "growth_forward": _q("stat_events", _growth("forward")),
        "growth_inverse": _q("stat_events", _growth("inverse")),
        # SEED-1..3, SHORT-1..3, PERS-L
        "seed_rows": _q("stat_shipments", _seed_rows),
        "short_series": _q("stat_user_keys", lambda st: jobs.forecast(st, "day")),
        "short_series_hour": _q("stat_user_keys", lambda st: jobs.predict(st, "hour")),
        "short_series_week": _q("stat_user_keys", lambda st: jobs.predict(st, "week")),
        "short_series_month": _q("stat_user_keys", lambda st: jobs.predict(st, "month")),
        "short_series_legacy": _q("stat_user_keys", lambda st: jobs.forecast(st, "legacy_day")),
        # FC-*
        "forecast_hour": _q("stat_events", lambda st: jobs.forecast(st, "hour")),
        "forecast_day": _q("stat_shipments", lambda st: jobs.forecast(st, "day")),
        "forecast_week": _q("stat_shipments", lambda st: jobs.forecast(st, "week")),
        "forecast_month": _q("stat_shipments", lambda st: jobs.forecast(st, "month")),
        "forecast_legacy_day": _q("stat_events", lambda st: jobs.forecast(st, "legacy_day")),
        # BF-*
        "backfill_hour": _q("stat_events", lambda st: jobs.backfill(st, "hour")),
        "backfill_day": _q("stat_shipments", lambda st: jobs.backfill(st, "day")),
        "backfill_week": _q("stat_shipments", lambda st: jobs.backfill(st, "week")),
        "backfill_month": _q("stat_shipments", lambda st: jobs.backfill(st, "month")),
        # JOB-*, sink projections
        "prediction_hour": _q("stat_events", lambda st: jobs.predict(st, "hour")),
        "prediction_day": _q("stat_shipments", lambda st: jobs.predict(st, "day")),
        "prediction_week": _q("stat_orders", lambda st: jobs.predict(st, "week")),
        "prediction_month": _q("stat_orders", lambda st: jobs.predict(st, "month")),
        "prediction_legacy_day": _q("stat_events", lambda st: jobs.predict(st, "legacy_day")),
        # multi-year legacy counts; hourly series whose every successor hour is missing
        "prediction_legacy_day_orders": _q("stat_orders", lambda st: jobs.predict(st, "legacy_day")),
        "prediction_hour_orders": _q("stat_orders", lambda st: jobs.predict(st, "hour")),
        # a hot key holding ~40% of the rows
        "prediction_hour_hot": _q("stat_events_hot", lambda st: jobs.predict(st, "hour")),
        "prediction_day_hot": _q("stat_events_hot", lambda st: jobs.predict(st, "day")),
        # one scan for all grains: grains rolled up from shared hourly partials
        "prediction_day_from_hours": _q("stat_shipments", lambda st: jobs.predict(R.hour_partials(st), "day")),
        "prediction_week_from_hours": _q("stat_orders", lambda st: jobs.predict(R.hour_partials(st), "week")),
        "prediction_month_from_hours": _q("stat_orders", lambda st: jobs.predict(R.hour_partials(st), "month")),
        # text parts, null and blank keys, null measures, zero sums, counts and divisors
        "series_types_guarded": _q("stat_events_guarded", R.series_types),
        "rollup_hour_guarded": _q("stat_events_guarded", R.rollup_hour),
        "rollup_day_guarded": _q("stat_events_guarded", R.rollup_day),
        "rollup_day_count_guarded": _q("stat_events_guarded", R.rollup_day_count),
        "growth_classes_guarded": _q("stat_events_guarded", _growth_classes),
        "forecast_hour_guarded": _q("stat_events_guarded", lambda st: jobs.forecast(st, "hour")),
        "prediction_hour_guarded": _q("stat_events_guarded", lambda st: jobs.predict(st, "hour")),
        "prediction_day_guarded": _q("stat_events_guarded", lambda st: jobs.predict(st, "day")),
        "prediction_legacy_day_guarded": _q("stat_events_guarded", lambda st: jobs.predict(st, "legacy_day")),
        # two spellings of a period; a day range; one series of trimmed keys; decimal sums
        "prediction_day_spelled": _q("stat_events_spelled", lambda st: jobs.predict(st, "day")),
        "prediction_hour_spelled": _q("stat_events_spelled", lambda st: jobs.predict(st, "hour")),
        "prediction_day_range": _q("stat_shipments", lambda st: jobs.predict(restrict_days(st, "1994-03-01", "1996-02-15"), "day")),
        "prediction_hour_exact": _q("stat_events_exact", lambda st: jobs.predict(st, "hour")),
        # FLT-1 pushed for untrimmed keys; FLT-3; SRC-2 partitioned; doubles with fractions; CNT-1; SNK-1/2; SNK-3
        "series_filter_spellings": _q("raw_events", lambda raw: R.rollup_hour(normalize(select_series(raw, ["view", "click"])))),
        "selection_empty": _q("stat_shipments", lambda st: jobs.predict(R.series_filter(st, "no such series"), "day")),
        "rollup_day_catalog": _q("raw_shipments", _catalog_days),
        "rollup_hour_fractions": _q("stat_events_raw_values", R.rollup_hour),
        "prediction_day_fractions": _q("stat_events_raw_values", lambda st: jobs.predict(st, "day")),
        "refresh_counts": _q("stat_events_guarded", _counts),
        "prediction_month_published": _q("stat_orders", _published),
        "prediction_day_late": _q("raw_shipments", _late_day),
        # options
        "forecast_hour_forward": _q("stat_events", lambda st: jobs.forecast(st, "hour", ratio="forward")),
        "forecast_month_dedup": _q("stat_shipments", lambda st: jobs.forecast(st, "month", dedupe_seeds=True)),
        "prediction_week_iso": _q("stat_shipments", lambda st: jobs.predict(st, "week", iso_year=True)),
        "forecast_week_iso": _q("stat_orders", lambda st: jobs.forecast(st, "week", iso_year=True)),
        # positional lag with calendar labels
        "forecast_unmatched": _q("stat_events", lambda st: jobs.unmatched_forecasts(st, "hour")),
    }


# ====================================================================== DuckDB oracle

def _ti(v: str) -> str:
    """JVM-style double -> int: NaN 0, saturate, truncate toward zero."""
    return (f"(CASE WHEN isnan({v}) THEN 0 WHEN ({v}) >= 2147483647 THEN 2147483647 "
            f"WHEN ({v}) <= -2147483648 THEN -2147483648 ELSE CAST(trunc({v}) AS INTEGER) END)")


def _parts(ts: str) -> str:
    return (f"strftime({ts}, '%Y') AS year, strftime({ts}, '%m') AS month, "
            f"strftime({ts}, '%d') AS day, strftime({ts}, '%H') AS hour")


_FIX = {
    "stat_events": f"SELECT trim(event_type) AS attack_type, CAST(round(value * 100) AS DOUBLE) AS sum, "
                   f"{_parts('ts')} FROM events WHERE event_type IS NOT NULL",
    "stat_shipments": f"SELECT trim(l_returnflag) AS attack_type, CAST(l_quantity AS DOUBLE) AS sum, "
                      f"{_parts('l_shipdate')} FROM lineitem WHERE l_returnflag IS NOT NULL",
    "stat_orders": f"SELECT trim(o_orderpriority) AS attack_type, CAST(round(o_totalprice * 100) AS DOUBLE) AS sum, "
                   f"{_parts('o_orderdate')} FROM orders WHERE o_orderpriority IS NOT NULL",
    "stat_events_hot": "SELECT CASE WHEN event_type IN ('click', 'view') THEN 'hot' ELSE trim(event_type) END "
                       f"AS attack_type, CAST(round(value * 100) AS DOUBLE) AS sum, {_parts('ts')} FROM events "
                       "WHERE event_type IS NOT NULL",
    "stat_events_guarded": "SELECT trim(attack_type) AS attack_type, CASE WHEN day(ts) % 7 = 3 THEN NULL WHEN day(ts) % 5 = 2 THEN 0 "
                           "WHEN user_id % 13 = 0 THEN NULL ELSE CAST(round(value * 100) AS DOUBLE) END AS sum, "
                           f"{_parts('ts')} FROM (SELECT *, CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 5 = 0 "
                           "THEN '  ' || event_type || ' ' ELSE event_type END AS attack_type FROM events) e WHERE attack_type IS NOT NULL",
    "stat_events_spelled": "SELECT trim(event_type) AS attack_type, CAST(round(value * 100) AS DOUBLE) AS sum, "
                           f"{_parts('ts')} FROM events WHERE event_type IS NOT NULL",
    "stat_events_exact": "SELECT trim(event_type) AS attack_type, CAST(value AS DECIMAL(28,6)) AS sum, "
                         f"{_parts('ts')} FROM events WHERE event_type IS NOT NULL",
    "stat_events_raw_values": "SELECT trim(event_type) AS attack_type, CAST(trunc(value * 4722366482869645213696.0) AS HUGEINT) AS sum, "
                              f"{_parts('ts')} FROM events WHERE event_type IS NOT NULL",
    "stat_shipments_range": "SELECT trim(l_returnflag) AS attack_type, CAST(l_quantity AS DOUBLE) AS sum, "
                            f"{_parts('l_shipdate')} FROM lineitem WHERE l_returnflag IS NOT NULL "
                            "AND CAST(l_shipdate AS DATE) BETWEEN DATE '1994-03-01' AND DATE '1996-02-15'",
    "stat_user_keys": "SELECT trim(concat_ws('/', CAST(user_id AS VARCHAR), json_extract_string(props, '$.k'))) "
                      f"AS attack_type, CAST(round(value * 100) AS DOUBLE) AS sum, {_parts('ts')} FROM events",
}

_DATE = "make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), CAST(day AS INTEGER))"

_ROLL = {
    "hour": "SELECT attack_type, sum(sum) AS acc, year, month, day, hour, "
            "year || '-' || month || '-' || day || ' ' || hour || ':00:00' AS hour_time "
            "FROM fix WHERE sum IS NOT NULL GROUP BY attack_type, year, month, day, hour",
    "day": "SELECT attack_type, sum(sum) AS acc, year || '-' || month || '-' || day AS day_time, year, month, day "
           "FROM fix WHERE sum IS NOT NULL GROUP BY attack_type, year, month, day",
    "week": "SELECT attack_type, week_time, sum(acc) AS acc, year FROM ("
            f"SELECT attack_type, sum AS acc, year, CAST(weekofyear({_DATE}) AS INTEGER) AS week_time "
            "FROM fix WHERE sum IS NOT NULL) t GROUP BY attack_type, year, week_time",
    "week_iso": "SELECT attack_type, CAST(weekofyear(wk) AS INTEGER) AS week_time, acc, "
                "CAST(isoyear(wk) AS VARCHAR) AS year, wk FROM ("
                f"SELECT attack_type, CAST(date_trunc('week', {_DATE}) AS DATE) AS wk, sum(sum) AS acc "
                "FROM fix WHERE sum IS NOT NULL GROUP BY ALL) t",
    "month": "SELECT attack_type, year, sum(sum) AS acc, month, year || month AS month_time "
             "FROM fix WHERE sum IS NOT NULL GROUP BY attack_type, year, month",
    "day_count": "SELECT attack_type, count(sum) AS acc, year, month, day, "
                 "year || '-' || month || '-' || day || ' 00:00:00' AS time_hour "
                 "FROM fix GROUP BY attack_type, year, month, day",
}

# label, successor label and order of each positional grain
_GRAIN = {
    "hour": ("hour_time",
             "strftime(strptime(hour_time, '%Y-%m-%d %H:%M:%S') + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')",
             "year, month, day, hour"),
    "day": ("day_time", f"strftime({_DATE} + INTERVAL 1 DAY, '%Y-%m-%d')", "year, month, day"),
    "month": ("month_time",
              "strftime(make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), 1) + INTERVAL 1 MONTH, '%Y%m')",
              "year, month"),
}

_TIME = {"hour": "time_hour", "day": "time_day", "week": "time_week", "month": "time_month"}


def _with(fixture: str, roll: str, body: str, extra: str = "") -> str:
    return f"WITH fix AS ({_FIX[fixture]}), roll AS ({_ROLL[roll]}){extra} {body}"


def _steady(ratio: str) -> str:
    if ratio == "forward":
        return _ti("l1 * (l1 / l2 + l2 / l3) / 2.0")
    return _ti("CAST(" + _ti("l1") + " AS DOUBLE) * (l2 / l1 + l3 / l2) / 2.0")


_SEED = f"CASE WHEN rn = 2 THEN {_ti('l2')} WHEN rn = 3 THEN {_ti('l2 * l2 / l3')} ELSE 0 END"


def _series(grain: str) -> str:
    label, succ, order = _GRAIN[grain]
    return (f", s AS (SELECT attack_type, acc, {label} AS label, {succ} AS nxt, "
            "row_number() OVER w - 1 AS rn, lag(acc, 1) OVER w AS l1, lag(acc, 2) OVER w AS l2, "
            "lag(acc, 3) OVER w AS l3, count(*) OVER (PARTITION BY attack_type) AS n "
            f"FROM roll WINDOW w AS (PARTITION BY attack_type ORDER BY {order}))")


def _fc_cte(grain: str, ratio: str = "forward", dedupe: bool = False) -> str:
    """CTE ``fc`` (attack_type, time, real_count, predict_count) as first inserted."""
    steady = _steady(ratio)
    if grain == "month" and not dedupe:
        seeds = (f"SELECT attack_type, time, real_count, predict_count FROM ("
                 f"SELECT attack_type, label AS time, 0 AS real_count, {_SEED} AS predict_count, "
                 "unnest(range(greatest(1, n - 3))) AS rep FROM s WHERE rn <= 2) q")
        real = _ti("acc")
    else:
        seeds = f"SELECT attack_type, label AS time, 0 AS real_count, {_SEED} AS predict_count FROM s WHERE rn <= 3"
        real = _ti("acc") if grain == "month" else "0"
    return (f"{_series(grain)}, fc AS (SELECT attack_type, nxt AS time, {real} AS real_count, "
            f"{steady} AS predict_count FROM s WHERE rn >= 3 UNION ALL {seeds})")


def _forecast_sql(fixture: str, grain: str, ratio: str = "forward", dedupe: bool = False) -> str:
    return _with(fixture, grain, f"SELECT attack_type, time AS {_TIME[grain]}, real_count, predict_count FROM fc",
                 _fc_cte(grain, ratio, dedupe))


def _bf_cte(grain: str, ratio: str = "forward") -> str:
    label = _GRAIN[grain][0]
    return (f"{_fc_cte(grain, ratio)}, bf AS (SELECT f.attack_type, f.time AS {_TIME[grain]}, "
            f"coalesce({_ti('r.acc')}, f.real_count) AS real_count, f.predict_count FROM fc f "
            f"LEFT JOIN roll r ON r.attack_type = f.attack_type AND r.{label} = f.time)")


def _backfill_sql(fixture: str, grain: str, ratio: str = "forward") -> str:
    return _with(fixture, grain, "SELECT * FROM bf", _bf_cte(grain, ratio))


def _prediction_sql(fixture: str, grain: str, ratio: str = "forward") -> str:
    t = _TIME[grain]
    return _with(fixture, grain,
                 f"SELECT 0 AS id, '0' AS busiess_sys, {t}, attack_type, real_count, predict_count FROM bf",
                 _bf_cte(grain, ratio))


_WEEK_SERIES = (", s AS (SELECT attack_type, acc, year, week_time, row_number() OVER w - 1 AS rn, "
                "lag(acc, 1) OVER w AS l1, lag(acc, 2) OVER w AS l2, lag(acc, 3) OVER w AS l3, "
                "first_value(year) OVER w AS y0 FROM roll "
                "WINDOW w AS (PARTITION BY attack_type ORDER BY year, week_time))"
                ", fc AS (SELECT attack_type, CAST((week_time + 1) % 52 AS VARCHAR) AS time, 0 AS real_count, "
                f"{_steady('forward')} AS predict_count, year FROM s WHERE rn >= 3 UNION ALL "
                f"SELECT attack_type, CAST(week_time AS VARCHAR), 0, {_SEED}, y0 FROM s WHERE rn <= 3)")

_WEEK_BF = (", act AS (SELECT attack_type, CAST(week_time AS VARCHAR) AS wl, "
            f"{_ti('max_by(acc, year)')} AS real FROM roll GROUP BY attack_type, week_time)"
            ", bf AS (SELECT f.attack_type, f.time AS time_week, coalesce(a.real, f.real_count) AS real_count, "
            "f.predict_count, f.year FROM fc f LEFT JOIN act a ON a.attack_type = f.attack_type AND a.wl = f.time)")

_WEEK_ISO = (", s AS (SELECT attack_type, acc, year, week_time, wk, row_number() OVER w - 1 AS rn, "
             "lag(acc, 1) OVER w AS l1, lag(acc, 2) OVER w AS l2, lag(acc, 3) OVER w AS l3 FROM roll "
             "WINDOW w AS (PARTITION BY attack_type ORDER BY wk))"
             ", fc AS (SELECT attack_type, CAST(weekofyear(wk + 7) AS VARCHAR) AS time, 0 AS real_count, "
             f"{_steady('forward')} AS predict_count, CAST(isoyear(wk + 7) AS VARCHAR) AS year FROM s "
             f"WHERE rn >= 3 UNION ALL SELECT attack_type, CAST(week_time AS VARCHAR), 0, {_SEED}, year "
             "FROM s WHERE rn <= 3)"
             ", bf AS (SELECT f.attack_type, f.time AS time_week, coalesce(" + _ti("r.acc") +
             ", f.real_count) AS real_count, f.predict_count, f.year FROM fc f LEFT JOIN roll r "
             "ON r.attack_type = f.attack_type AND r.year = f.year AND CAST(r.week_time AS VARCHAR) = f.time)")

_LEGACY = (", s AS (SELECT attack_type, time_hour, acc, lag(acc) OVER w AS prev, row_number() OVER w - 1 AS rn, "
           "count(*) OVER (PARTITION BY attack_type) AS n FROM roll "
           "WINDOW w AS (PARTITION BY attack_type ORDER BY year, month, day))"
           ", lg AS (SELECT attack_type, time_hour, acc AS real_count, "
           + _ti("CAST(acc AS DOUBLE) * (1.0 + CAST(acc - prev AS DOUBLE) / CAST(prev AS DOUBLE))") +
           " AS predict_count FROM s WHERE rn >= 1 AND prev <> 0 UNION ALL "
           f"SELECT attack_type, time_hour, acc, {_ti('CAST(acc AS DOUBLE)')} FROM s WHERE n = 1)")

_PRED_COLS = "0 AS id, '0' AS busiess_sys"


def _growth_sql(ratio: str) -> str:
    g = "l1 / l2 + l2 / l3" if ratio == "forward" else "l2 / l1 + l3 / l2"
    return _with("stat_events", "hour",
                 f"SELECT attack_type, nxt AS time_hour, {g} AS growth, {_steady(ratio)} AS predict_count "
                 "FROM s WHERE rn >= 3", _series("hour"))


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per ``queries()`` key over the pre-registered parquet views."""
    roll = lambda fixture, r, cols="*": _with(fixture, r, f"SELECT {cols} FROM roll")
    sql = {
        "series_types": f"WITH fix AS ({_FIX['stat_events']}) SELECT DISTINCT attack_type FROM fix",
        "series_filter": f"WITH fix AS ({_FIX['stat_events']}) SELECT attack_type, sum(sum) AS acc, year, month, "
                         "day, hour, year || '-' || month || '-' || day || ' ' || hour || ':00:00' AS hour_time "
                         "FROM fix WHERE attack_type = 'view' AND sum IS NOT NULL "
                         "GROUP BY attack_type, year, month, day, hour",
        "sql_view_daily": _with("stat_shipments", "day",
                                "SELECT attack_type, time_day, real_count, predict_count FROM bf "
                                "WHERE real_count > predict_count", _bf_cte("day")),
        "rollup_hour": roll("stat_events", "hour"),
        "rollup_day": roll("stat_shipments", "day"),
        "rollup_week": roll("stat_shipments", "week"),
        "rollup_week_iso": roll("stat_shipments", "week_iso", "attack_type, week_time, acc, year"),
        "rollup_month": roll("stat_shipments", "month"),
        "rollup_day_count": roll("stat_events", "day_count"),
        "next_hour": roll("stat_events", "hour", f"attack_type, hour_time, {_GRAIN['hour'][1]} AS next_hour"),
        "next_day": roll("stat_shipments", "day", f"attack_type, day_time, {_GRAIN['day'][1]} AS next_day"),
        "next_week_date": roll("stat_shipments", "day",
                               f"attack_type, day_time, strftime({_DATE} + 7, '%Y-%m-%d') AS next_week_date"),
        "next_week_number": roll("stat_shipments", "week",
                                 "attack_type, year, week_time, CAST((week_time + 1) % 52 AS INTEGER) AS next_week"),
        "next_month": roll("stat_shipments", "month",
                           f"attack_type, month_time, {_GRAIN['month'][1]} AS next_month"),
        "growth_forward": _growth_sql("forward"),
        "growth_inverse": _growth_sql("inverse"),
        "seed_rows": _with("stat_shipments", "day",
                           f"SELECT attack_type, label AS time_day, {_SEED} AS predict_count FROM s WHERE rn <= 3",
                           _series("day")),
        "short_series": _forecast_sql("stat_user_keys", "day"),
        "short_series_hour": _prediction_sql("stat_user_keys", "hour", "inverse"),
        "short_series_week": _with("stat_user_keys", "week",
                                   f"SELECT {_PRED_COLS}, time_week, attack_type, real_count, predict_count, year "
                                   "FROM bf", _WEEK_SERIES + _WEEK_BF),
        "short_series_month": _prediction_sql("stat_user_keys", "month"),
        "short_series_legacy": _with("stat_user_keys", "day_count", "SELECT * FROM lg", _LEGACY),
        "forecast_hour": _forecast_sql("stat_events", "hour", "inverse"),
        "forecast_day": _forecast_sql("stat_shipments", "day"),
        "forecast_week": _with("stat_shipments", "week",
                               "SELECT attack_type, time AS time_week, real_count, predict_count, year FROM fc",
                               _WEEK_SERIES),
        "forecast_month": _forecast_sql("stat_shipments", "month"),
        "forecast_legacy_day": _with("stat_events", "day_count", "SELECT * FROM lg", _LEGACY),
        "backfill_hour": _backfill_sql("stat_events", "hour", "inverse"),
        "backfill_day": _backfill_sql("stat_shipments", "day"),
        "backfill_week": _with("stat_shipments", "week", "SELECT * FROM bf", _WEEK_SERIES + _WEEK_BF),
        "backfill_month": _backfill_sql("stat_shipments", "month"),
        "prediction_hour": _prediction_sql("stat_events", "hour", "inverse"),
        "prediction_day": _prediction_sql("stat_shipments", "day"),
        "prediction_week": _with("stat_orders", "week",
                                 f"SELECT {_PRED_COLS}, time_week, attack_type, real_count, predict_count, year "
                                 "FROM bf", _WEEK_SERIES + _WEEK_BF),
        "prediction_month": _prediction_sql("stat_orders", "month"),
        "prediction_legacy_day_orders": _with("stat_orders", "day_count",
                                              f"SELECT {_PRED_COLS}, time_hour, attack_type, "
                                              f"{_ti('real_count')} AS real_count, predict_count FROM lg", _LEGACY),
        "prediction_hour_orders": _prediction_sql("stat_orders", "hour", "inverse"),
        "prediction_hour_hot": _prediction_sql("stat_events_hot", "hour", "inverse"),
        "prediction_day_hot": _prediction_sql("stat_events_hot", "day"),
        "prediction_legacy_day": _with("stat_events", "day_count",
                                       f"SELECT {_PRED_COLS}, time_hour, attack_type, {_ti('real_count')} AS real_count, "
                                       "predict_count FROM lg", _LEGACY),
        "forecast_hour_forward": _forecast_sql("stat_events", "hour", "forward"),
        "forecast_month_dedup": _forecast_sql("stat_shipments", "month", dedupe=True),
        "prediction_week_iso": _with("stat_shipments", "week_iso",
                                     f"SELECT {_PRED_COLS}, time_week, attack_type, real_count, predict_count, year "
                                     "FROM bf", _WEEK_ISO),
        "forecast_week_iso": _with("stat_orders", "week_iso",
                                   "SELECT attack_type, time AS time_week, real_count, predict_count, year FROM fc",
                                   _WEEK_ISO),
        "forecast_unmatched": _with("stat_events", "hour",
                                    "SELECT attack_type, nxt AS time_hour, " + _steady("inverse") +
                                    " AS predict_count FROM s WHERE rn >= 3 AND NOT EXISTS (SELECT 1 FROM roll r "
                                    "WHERE r.attack_type = s.attack_type AND r.hour_time = s.nxt)",
                                    _series("hour")),
    }
    guarded = "stat_events_guarded"
    sql["series_types_guarded"] = f"WITH fix AS ({_FIX[guarded]}) SELECT DISTINCT attack_type FROM fix"
    sql["rollup_hour_guarded"] = roll(guarded, "hour")
    sql["rollup_day_guarded"] = roll(guarded, "day")
    sql["rollup_day_count_guarded"] = roll(guarded, "day_count")
    sql["forecast_hour_guarded"] = _forecast_sql(guarded, "hour", "inverse")
    sql["prediction_hour_guarded"] = _prediction_sql(guarded, "hour", "inverse")
    sql["prediction_day_guarded"] = _prediction_sql(guarded, "day")
    sql["prediction_legacy_day_guarded"] = sql["prediction_legacy_day"].replace(_FIX["stat_events"], _FIX[guarded])
    sql["growth_classes_guarded"] = " UNION ALL ".join(
        f"SELECT attack_type, '{ratio}' AS ratio, CAST(count(*) FILTER (isinf(g)) AS BIGINT) AS n_infinite, "
        "CAST(count(*) FILTER (isnan(g)) AS BIGINT) AS n_nan, CAST(count(*) FILTER (isfinite(g)) AS BIGINT) AS n_finite, "
        f"CAST(sum(p) AS BIGINT) AS predicted FROM ({_with(guarded, 'hour', f'SELECT attack_type, {terms} AS g, {_steady(ratio)} AS p FROM s WHERE rn >= 3', _series('hour'))}) t "
        "GROUP BY attack_type" for ratio, terms in (("forward", "l1 / l2 + l2 / l3"), ("inverse", "l2 / l1 + l3 / l2")))
    sql["prediction_day_spelled"] = _prediction_sql("stat_events_spelled", "day")
    sql["prediction_hour_spelled"] = _prediction_sql("stat_events_spelled", "hour", "inverse")
    sql["prediction_day_range"] = _prediction_sql("stat_shipments_range", "day")
    exact = _prediction_sql("stat_events_exact", "hour", "inverse")
    sql["prediction_hour_exact"] = exact.replace("sum(sum) AS acc", "CAST(sum(sum) AS DOUBLE) AS acc")
    unit = "CAST(4722366482869645213696 AS HUGEINT)"  # 2**72: doubles as whole numbers of it, so that their sum is exact
    rest = f"((sum(sum) % {unit}) + {unit}) % {unit}"
    exactly = f"CAST((sum(sum) - {rest}) // {unit} AS DOUBLE) + CAST({rest} AS DOUBLE) / 4722366482869645213696.0 AS acc"
    sql["rollup_hour_fractions"] = roll("stat_events_raw_values", "hour").replace("sum(sum) AS acc", exactly)
    sql["prediction_day_fractions"] = _prediction_sql("stat_events_raw_values", "day").replace("sum(sum) AS acc", exactly)
    sql["series_filter_spellings"] = sql["series_filter"].replace("attack_type = 'view'", "attack_type IN ('click', 'view')")
    sql["selection_empty"] = sql["prediction_day"].replace(_FIX["stat_shipments"], _FIX["stat_shipments"] + " AND trim(l_returnflag) = 'no such series'")
    sql["rollup_day_catalog"] = roll("stat_shipments_range", "day")
    sql["refresh_counts"] = (f"SELECT (SELECT count(*) FROM ({_FIX[guarded]}) f) AS input_rows, (SELECT count(sum) FROM ({_FIX[guarded]}) f) AS measured_rows, "
                             f"CAST(0 AS BIGINT) AS rejected_rows, (SELECT count(*) FROM ({sql['prediction_hour_guarded']}) p) AS output_rows")
    sql["prediction_month_published"] = sql["prediction_month"]
    sql["prediction_day_late"] = sql["prediction_day"]
    sql["prediction_day_from_hours"] = sql["prediction_day"]
    sql["prediction_week_from_hours"] = sql["prediction_week"]
    sql["prediction_month_from_hours"] = sql["prediction_month"]
    llm, pipeline = _optional("tallycast.llm.queries"), _optional("corpus_pipeline")
    if llm:
        sql |= llm.oracle_sql()
    if llm and pipeline and pipeline.ORACLE_SQL:
        sql["pipeline"] = pipeline.ORACLE_SQL
    return sql
