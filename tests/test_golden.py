"""Hand-computed golden series (FIXTURES.md §3) through the Spark plans."""

from collections import Counter

import pytest

from tallycast.plans import jobs
from tests.conftest import stat_frame
from tests.series_model import STARTS, label_of, parts, periods

MAX = 2147483647

SERIES = {
    "s5": [10, 20, 30, 60, 90],
    "s3": [10, 20, 30],
    "s2": [10, 20],
    "s1": [10],
    "zero_first": [0, 10, 20, 30],
    "zeros": [0, 0, 0, 5],
    "zero_mid": [10, 0, 20, 30, 40],
    "huge": [3e9, 3e9, 3e9, 3e9],
}

# predictions by label index t0..tn (t[n] = successor of the last period)
FORWARD = {
    "s5": [0, 0, 10, 40, 52, 105],
    "s3": [0, 0, 10],
    "s2": [0, 0],
    "s1": [0],
    "zero_first": [0, 0, 0, MAX, MAX],
    "zeros": [0, 0, 0, 0, 0],
    "zero_mid": [0, 0, 10, 0, MAX, MAX],
    "huge": [0, 0, MAX, MAX, MAX],
}
INVERSE = dict(FORWARD, s5=[0, 0, 10, 40, 17, 34], zero_first=[0, 0, 0, MAX, 5],
               zero_mid=[0, 0, 10, 0, MAX, 10])


def _stat(spark, grain):
    rows = []
    for name, xs in SERIES.items():
        for t, x in zip(periods(grain, STARTS[grain], range(len(xs))), xs):
            rows.append((name, float(x), *parts(t)))
    return stat_frame(spark, rows)


def _labels(grain, n):
    return [label_of(grain, t) for t in periods(grain, STARTS[grain], range(n + 1))]


def _by_series(df, time_col):
    out = {}
    for r in df.collect():
        out.setdefault(r["attack_type"], []).append((r[time_col], r["real_count"], r["predict_count"]))
    return out


@pytest.mark.parametrize("grain,table", [("day", FORWARD), ("week", FORWARD), ("hour", INVERSE)])
def test_predictions(spark, grain, table):
    got = _by_series(jobs.forecast(_stat(spark, grain), grain), jobs.TIME_COL[grain])
    for name, want in table.items():
        labels = _labels(grain, len(SERIES[name]))
        assert sorted((t, p) for t, _, p in got[name]) == sorted(zip(labels, want)), name


def test_hour_forward_option(spark):
    got = _by_series(jobs.forecast(_stat(spark, "hour"), "hour", ratio="forward"), "time_hour")
    for name, want in FORWARD.items():
        labels = _labels("hour", len(SERIES[name]))
        assert sorted((t, p) for t, _, p in got[name]) == sorted(zip(labels, want)), name


def test_month_rows(spark):
    got = _by_series(jobs.forecast(_stat(spark, "month"), "month"), "time_month")
    t = _labels("month", 5)
    want = Counter([(t[0], 0, 0), (t[1], 0, 0), (t[2], 0, 10)] * 2 + [(t[4], 60, 52), (t[5], 90, 105)])
    assert Counter(got["s5"]) == want and len(got["s5"]) == 8
    t2 = _labels("month", 2)
    assert Counter(got["s2"]) == Counter([(t2[0], 0, 0), (t2[1], 0, 0)])


def test_month_dedup_option(spark):
    got = _by_series(jobs.forecast(_stat(spark, "month"), "month", dedupe_seeds=True), "time_month")
    t = _labels("month", 5)
    assert sorted((a, p) for a, _, p in got["s5"]) == sorted(zip(t, FORWARD["s5"]))


@pytest.mark.parametrize("grain", ["hour", "day", "week"])
def test_backfill_actuals(spark, grain):
    got = _by_series(jobs.backfill(_stat(spark, grain), grain), jobs.TIME_COL[grain])
    labels = _labels(grain, 5)
    assert sorted((t, r) for t, r, _ in got["s5"]) == sorted(zip(labels, [10, 20, 30, 60, 90, 0]))


def test_backfill_month(spark):
    got = _by_series(jobs.backfill(_stat(spark, "month"), "month"), "time_month")
    t = _labels("month", 5)
    want = Counter([(t[0], 10), (t[1], 20), (t[2], 30)] * 2 + [(t[4], 90), (t[5], 90)])
    assert Counter((a, r) for a, r, _ in got["s5"]) == want


@pytest.mark.parametrize("counts,want", [
    ([4, 6, 0, 5], [(1, 6, 9), (2, 0, 0)]),
    ([3, 5, 4], [(1, 5, 8), (2, 4, 3)]),
    ([5], [(0, 5, 5)]),
])
def test_legacy(spark, counts, want):
    days = periods("day", STARTS["day"], range(len(counts)))
    rows = []
    for t, c in zip(days, counts):
        rows += [("x", 1.0, *parts(t))] * c
        if c == 0:
            rows.append(("x", None, *parts(t)))  # the day exists, with no counted measure
    got = jobs.forecast(stat_frame(spark, rows), "legacy_day").collect()
    labels = [label_of("legacy_day", t) for t in days]
    assert sorted((r["time_hour"], r["real_count"], r["predict_count"]) for r in got) == \
        sorted((labels[i], cur, nxt) for i, cur, nxt in want)


def test_prediction_table_layout(spark):
    st = _stat(spark, "week")
    assert jobs.predict(st, "week").columns == [
        "id", "busiess_sys", "time_week", "attack_type", "real_count", "predict_count", "year"]
    assert jobs.predict(st, "day").columns == [
        "id", "busiess_sys", "time_day", "attack_type", "real_count", "predict_count"]
    row = jobs.predict(st, "day").first()
    assert row["id"] == 0 and row["busiess_sys"] == "0"
