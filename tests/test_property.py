"""Property test: the window plans against the plain-Python model on random series.

Each example packs many random series (lengths 1..9, zeros, huge values,
fractions, random gaps) into one table so one Spark run checks them all.
"""

import os
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallycast.plans import jobs
from tests.conftest import stat_frame
from tests.series_model import (STARTS, backfilled, label_of, legacy_rows, parts, periods,
                                predicted_rows, succ_of, to_int)

VALUES = st.one_of(st.integers(0, 50).map(float), st.sampled_from([0.0, 0.25, 2.5, 3e9, 7.75]),
                   st.integers(1, 10**6).map(float))
SERIES = st.lists(st.tuples(VALUES, st.integers(1, 3)), min_size=1, max_size=9)
TABLE = st.lists(SERIES, min_size=1, max_size=25)
# TALLYCAST_EXAMPLES=40 for a deeper search; each example is one Spark run over many series
SETTINGS = settings(max_examples=int(os.environ.get("TALLYCAST_EXAMPLES", "6")), deadline=None,
                    suppress_health_check=list(HealthCheck))


def _layout(grain, table):
    rows, truth = [], {}
    for i, series in enumerate(table):
        steps, s = [], 0
        for _, gap in series:
            steps.append(s)
            s += gap
        ts = periods(grain, STARTS[grain], steps)
        xs = [v for v, _ in series]
        name = f"s{i}"
        rows += [(name, x, *parts(t)) for t, x in zip(ts, xs)]
        truth[name] = (xs, ts)
    return rows, truth


def _check(spark, grain, table, **opts):
    rows, truth = _layout(grain, table)
    got = {}
    for r in jobs.backfill(stat_frame(spark, rows), grain, **opts).collect():
        got.setdefault(r["attack_type"], []).append((r[jobs.TIME_COL[grain]], r["real_count"], r["predict_count"]))
    for name, (xs, ts) in truth.items():
        labels = [label_of(grain, t) for t in ts]
        succ = [succ_of(grain, t) for t in ts]
        want = [(lab, real, pred) for lab, real, pred, _ in predicted_rows(xs, labels, succ, grain)]
        want = backfilled(want, list(zip(labels, xs)))
        assert Counter(got.get(name, [])) == Counter(want), (name, xs, labels)


@SETTINGS
@given(TABLE)
def test_day(spark, table):
    _check(spark, "day", table)


@SETTINGS
@given(TABLE)
def test_hour(spark, table):
    _check(spark, "hour", table)


@SETTINGS
@given(TABLE)
def test_month(spark, table):
    _check(spark, "month", table)


@SETTINGS
@given(TABLE)
def test_week(spark, table):
    _check(spark, "week", table)


@SETTINGS
@given(st.lists(st.lists(st.tuples(st.integers(0, 6), st.integers(1, 3)), min_size=1, max_size=8),
                min_size=1, max_size=20))
def test_legacy(spark, table):
    rows, truth = [], {}
    for i, series in enumerate(table):
        steps, s = [], 0
        for _, gap in series:
            steps.append(s)
            s += gap
        days = periods("day", STARTS["day"], steps)
        counts = [c for c, _ in series]
        for t, c in zip(days, counts):
            rows += [(f"s{i}", 1.0, *parts(t))] * c
            if c == 0:
                rows.append((f"s{i}", None, *parts(t)))
        truth[f"s{i}"] = legacy_rows(counts, [label_of("legacy_day", t) for t in days])
    got = {}
    for r in jobs.forecast(stat_frame(spark, rows), "legacy_day").collect():
        got.setdefault(r["attack_type"], []).append((r["time_hour"], r["real_count"], r["predict_count"]))
    for name, want in truth.items():
        assert Counter(got.get(name, [])) == Counter(want), name


WEEKLY = st.lists(st.lists(st.tuples(VALUES, st.integers(1, 60)), min_size=1, max_size=9),
                  min_size=1, max_size=20)


def _check_weeks(spark, table, iso_year):
    import datetime as dt
    from tests.series_model import weekly_truth
    rows, truth = [], {}
    for i, series in enumerate(table):
        d, dates = dt.date(2016, 12, 26), []
        for _, gap in series:
            dates.append(d)
            d += dt.timedelta(days=gap)
        xs = [v for v, _ in series]
        rows += [(f"s{i}", x, f"{t.year:04d}", f"{t.month:02d}", f"{t.day:02d}", "00") for t, x in zip(dates, xs)]
        truth[f"s{i}"] = weekly_truth(dates, xs, iso_year)
    got = {}
    for r in jobs.backfill(stat_frame(spark, rows), "week", iso_year=iso_year).collect():
        got.setdefault(r["attack_type"], []).append((r["time_week"], r["real_count"], r["predict_count"], r["year"]))
    for name, want in truth.items():
        assert Counter(got.get(name, [])) == Counter(want), (name, want, got.get(name))


@SETTINGS
@given(WEEKLY)
def test_week_multi_year(spark, table):
    """Days scattered over several years: (calendar year, ISO week) keys that hold
    two different weeks, week labels repeating across years, year-blind backfill."""
    _check_weeks(spark, table, iso_year=False)


@SETTINGS
@given(WEEKLY)
def test_week_iso_multi_year(spark, table):
    _check_weeks(spark, table, iso_year=True)


@SETTINGS
@given(TABLE)
def test_hour_forward_ratio(spark, table):
    rows, truth = _layout("hour", table)
    got = {}
    for r in jobs.backfill(stat_frame(spark, rows), "hour", ratio="forward").collect():
        got.setdefault(r["attack_type"], []).append((r["time_hour"], r["real_count"], r["predict_count"]))
    for name, (xs, ts) in truth.items():
        labels = [label_of("hour", t) for t in ts]
        succ = [succ_of("hour", t) for t in ts]
        want = [(a, b, c) for a, b, c, _ in predicted_rows(xs, labels, succ, "day")]  # forward rule
        assert Counter(got.get(name, [])) == Counter(backfilled(want, list(zip(labels, xs)))), name


@SETTINGS
@given(TABLE)
def test_month_dedup(spark, table):
    rows, truth = _layout("month", table)
    got = {}
    for r in jobs.backfill(stat_frame(spark, rows), "month", dedupe_seeds=True).collect():
        got.setdefault(r["attack_type"], []).append((r["time_month"], r["real_count"], r["predict_count"]))
    for name, (xs, ts) in truth.items():
        labels = [label_of("month", t) for t in ts]
        succ = [succ_of("month", t) for t in ts]
        # seeds once, with the fourth seed (the daily rule) ...
        want = [(a, b, c) for a, b, c, _ in predicted_rows(xs, labels, succ, "day")]
        # ... and forecast rows carry the provisional actual trunc(x[j]) until backfilled
        n_seed = min(len(xs), 4)
        want = want[:n_seed] + [(a, to_int(xs[j]), c) for j, (a, _, c) in zip(range(3, len(xs)), want[n_seed:])]
        assert Counter(got.get(name, [])) == Counter(backfilled(want, list(zip(labels, xs)))), name


@settings(SETTINGS, max_examples=max(2, SETTINGS.max_examples // 2))  # ten Spark jobs per example
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), VALUES), st.integers(0, 30)), min_size=1, max_size=12),
                min_size=1, max_size=12))
def test_grains_from_hourly_partials_equal_direct(spark, table):
    """predict_all's path (every grain rolled up from hourly partials) gives the
    same tables as rolling up the raw rows, null measures included."""
    import datetime as dt
    from tallycast.operators.rollup import hour_partials
    rows = []
    for i, series in enumerate(table):
        t = dt.datetime(2016, 12, 28)
        for v, gap_hours in series:
            t += dt.timedelta(hours=gap_hours * 7)
            rows.append((f"s{i}", v, *parts(t)))
            rows.append((f"s{i}", v, *parts(t)))  # two raw rows per hour: partials really merge
    stat = stat_frame(spark, rows)
    base = hour_partials(stat)
    for g in jobs.GRAINS:
        direct = sorted(map(tuple, jobs.predict(stat, g).collect()), key=str)
        merged = sorted(map(tuple, jobs.predict(base, g).collect()), key=str)
        assert direct == merged, g
