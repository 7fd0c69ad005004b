import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallycast.plans import jobs, partial
from tallycast.sources.tables import normalize, on_days

SCHEMA = "attack_type string, sum double, year string, month string, day string, hour string"


def stat(spark, rows):
    return normalize(spark.createDataFrame(rows, SCHEMA).coalesce(2))


def row(key, day, hour="05", value=1.5):
    return (key, value, day[:4], day[5:7], day[8:], hour)


def history():
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 7) for d in (1, 2, 9, 17, 28)]
    return [row("a", d, value=3.25 * (i % 7 + 1)) for i, d in enumerate(days)] + [row(" b ", d, "23", 2.0 + i) for i, d in enumerate(days[12:])] + [row("c", "2024-03-31")]


def rows(df):
    return sorted(map(str, df.collect()))


def files(path):
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")) for d in os.listdir(path) if "=" in d}


def refreshed(spark, scratch, name, before, after, days, grain, by="day"):
    """Full refresh of ``before``, then a partial one to ``after``; the months said and the folders whose files changed."""
    parts, table = os.path.join(scratch, name, "partials"), os.path.join(scratch, name, "table")
    partial.write_partials(stat(spark, before), parts, by)
    partial.write_periods(partial.read_partials(spark, parts), grain, table)
    was = files(table)
    partial.update_partials(stat(spark, after), parts, days, by)
    months = partial.refresh_days(partial.read_partials(spark, parts), grain, table, days)
    now = files(table)
    changed = {d[-7:] for d in was.keys() | now.keys() if was.get(d) != now.get(d)}
    assert rows(partial.read_periods(spark, grain, table)) == rows(jobs.predict(stat(spark, after), grain))
    assert changed <= set(months)
    return months


@pytest.mark.parametrize("grain", partial.GRAINS)
def test_a_late_day_rewrites_only_the_months_that_hold_its_labels(spark, scratch, grain):
    before = history()
    after = before + [row("a", "2024-04-10", value=11.0)]
    months = refreshed(spark, scratch, f"late-{grain}", before, after, ["2024-04-10"], grain)
    assert {"2024-04", "2024-05"} <= set(months) and not {"2024-01", "2024-02", "2024-06"} & set(months)


@pytest.mark.parametrize("grain", partial.GRAINS)
def test_days_that_go_first_days_and_new_series(spark, scratch, grain):
    before = history()
    gone = [r for r in before if (r[2], r[3], r[4]) not in {("2024", "04", "17"), ("2024", "01", "01")}]
    refreshed(spark, scratch, f"gone-{grain}", before, gone, ["2024-04-17", "2024-01-01"], grain)
    new = before + [row("d", "2023-12-31"), row("a", "2023-11-05"), row("a", "2024-07-04")]
    refreshed(spark, scratch, f"new-{grain}", before, new, ["2023-12-31", "2023-11-05", "2024-07-04"], grain)
    refreshed(spark, scratch, f"months-{grain}", before, new[5:], ["2023-12-31", "2023-11-05", "2024-07-04"] + [f"2024-01-{d:02d}" for d in (1, 2, 9, 17, 28)], grain, "month")
    only = [r for r in before if r[0] != "c"]
    refreshed(spark, scratch, f"only-{grain}", before, only, ["2024-03-31"], grain)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1, max_size=25), st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), max_size=3), st.lists(st.integers(0, 40), max_size=2))
def test_any_change_equals_a_full_refresh(spark, scratch, first, added, removed):
    import uuid
    day = lambda n: f"2024-{n // 8 + 1:02d}-{n % 8 * 3 + 1:02d}"
    before = [row(k, day(n), value=n + 0.5) for k, n in first]
    after = [row(k, day(n), value=n + 0.5) for k, n in first if n not in removed] + [row(k, day(n), value=7.0) for k, n in added]
    days = sorted({day(n) for _, n in added} | {day(n) for n in removed})
    if days:
        refreshed(spark, scratch, uuid.uuid4().hex, before, after, days, "day")


def test_only_the_late_days_are_read(spark, scratch):
    path = os.path.join(scratch, "raw_days")
    spark.createDataFrame(history(), SCHEMA).write.parquet(path)
    df = on_days(normalize(spark.read.parquet(path)), ["2024-03-09"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "In(month, [03,3])" in plan and "In(day, [09,9])" in plan and "In(year, [2024])" in plan or "EqualTo(year,2024)" in plan
    assert df.count() == 2
    ints = spark.createDataFrame([("a", 1.0, 2024, 3, 9, 1), ("a", 1.0, 2024, 3, 10, 1)], "attack_type string, sum double, year int, month int, day int, hour int")
    assert on_days(ints, ["2024-03-09"]).count() == 1
    assert on_days(ints, []).count() == 0


def test_grains(spark):
    with pytest.raises(ValueError):
        partial.touched_periods(stat(spark, history()), "week", ["2024-01-01"])
    assert partial.touched_periods(stat(spark, []), "day", ["2024-01-31"]) == ["2024-01", "2024-02"]
