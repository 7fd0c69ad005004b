"""Edge cases of FIXTURES.md §4."""

import pytest

from tallycast.operators import rollup as R
from tallycast.plans import jobs
from tests.conftest import stat_frame


def test_blank_and_null_types(spark):
    st = stat_frame(spark, [
        ("dos", 1.0, "2024", "01", "01", "00"),
        ("dos ", 2.0, "2024", "01", "01", "00"),
        (" dos", 3.0, "2024", "01", "01", "01"),
        (None, 5.0, "2024", "01", "01", "00"),
    ])
    assert [r[0] for r in R.series_types(st).collect()] == ["dos"]
    rows = sorted((r["hour_time"], r["acc"]) for r in R.rollup_hour(st).collect())
    assert rows == [("2024-01-01 00:00:00", 3.0), ("2024-01-01 01:00:00", 3.0)]


def test_null_measures(spark):
    st = stat_frame(spark, [
        ("a", 1.0, "2024", "01", "01", "00"),
        ("a", None, "2024", "01", "01", "00"),
        ("a", None, "2024", "01", "02", "00"),
    ])
    assert sorted((r["day_time"], r["acc"]) for r in R.rollup_day(st).collect()) == [("2024-01-01", 1.0)]
    counts = sorted((r["time_hour"], r["acc"]) for r in R.rollup_day_count(st).collect())
    assert counts == [("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 0)]


def test_gap_keeps_positional_ratio(spark):
    hours = ["00", "01", "02", "03", "04", "06", "07"]
    vals = [10.0, 20.0, 30.0, 60.0, 90.0, 30.0, 40.0]
    st = stat_frame(spark, [("g", v, "2024", "01", "01", h) for v, h in zip(vals, hours)])
    rows = {r["time_hour"]: (r["real_count"], r["predict_count"])
            for r in jobs.backfill(st, "hour").collect()}
    # made at 04:00 (lags 03:00, 02:00, 01:00), labelled 05:00: no measured period
    assert rows["2024-01-01 05:00:00"] == (0, int(60 * (30 / 60 + 20 / 30) / 2))
    # made at 06:00, labelled 07:00 (measured 40): lags 04:00, 03:00, 02:00
    assert rows["2024-01-01 07:00:00"] == (40, int(90 * (60 / 90 + 30 / 60) / 2))
    # made at 07:00: its lags 06:00, 04:00, 03:00 span the gap (positional, not calendar)
    assert rows["2024-01-01 08:00:00"] == (0, int(30 * (90 / 30 + 60 / 90) / 2))
    unmatched = sorted(r["time_hour"] for r in jobs.unmatched_forecasts(st, "hour").collect())
    assert unmatched == ["2024-01-01 05:00:00", "2024-01-01 08:00:00"]


def test_week_year_semantics(spark):
    # 2017-01-01 is ISO (2016, 52); the calendar-year key puts it in (2017, 52)
    st = stat_frame(spark, [("w", 1.0, "2017", "01", "01", "00")])
    cal_row = R.rollup_week(st).first()
    iso_row = R.rollup_week(st, iso_year=True).first()
    assert (cal_row["year"], cal_row["week_time"]) == ("2017", 52)
    assert (iso_row["year"], iso_row["week_time"]) == ("2016", 52)


def test_same_week_two_years(spark):
    # week 10 of 2016 and of 2017, plus enough weeks before each for forecasts
    days_2016 = ["2016-02-15", "2016-02-22", "2016-02-29", "2016-03-07"]  # weeks 7..10
    days_2017 = ["2017-02-13", "2017-02-20", "2017-02-27", "2017-03-06"]  # weeks 7..10
    rows = []
    for i, d in enumerate(days_2016):
        rows.append(("w", float(100 + i), d[:4], d[5:7], d[8:10], "00"))
    for i, d in enumerate(days_2017):
        rows.append(("w", float(500 + i), d[:4], d[5:7], d[8:10], "00"))
    st = stat_frame(spark, rows)
    blind = [(r["time_week"], r["year"], r["real_count"]) for r in jobs.backfill(st, "week").collect()]
    # year-blind: every row labelled 10 takes the latest year's actual (2017 -> 503)
    assert {real for t, _, real in blind if t == "10"} == {503}
    iso = [(r["time_week"], r["year"], r["real_count"]) for r in jobs.backfill(st, "week", iso_year=True).collect()]
    assert ("10", "2016", 103) in iso and ("10", "2017", 503) in iso


def test_week_labels_wrap(spark):
    # ISO weeks 50..53 of 2020 (2020 has 53 weeks) then week 1 of 2021
    days = ["2020-12-07", "2020-12-14", "2020-12-21", "2020-12-28", "2021-01-04"]
    st = stat_frame(spark, [("w", 10.0 * (i + 1), d[:4], d[5:7], d[8:10], "00") for i, d in enumerate(days)])
    labels = sorted(r["time_week"] for r in jobs.forecast(st, "week").collect())
    # weeks 50 (2020), 51, 52, 53 and week 1 (2021): forecasts (53+1)%52=2 and (1+1)%52=2
    assert labels == sorted(["50", "51", "52", "53", "2", "2"])


def test_ansi_off_gives_same_result(spark):
    st = stat_frame(spark, [("z", v, "2024", "01", "01", f"{h:02d}")
                            for h, v in enumerate([0.0, 10.0, 20.0, 30.0, 0.0, 0.0])])
    a = sorted(map(tuple, jobs.backfill(st, "hour").collect()))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        b = sorted(map(tuple, jobs.backfill(st, "hour").collect()))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert a == b


def test_text_measure_sums_like_numbers(spark):
    from pyspark.sql import types as T
    from tallycast.sources.tables import normalize
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("attack_type", "sum", "year", "month", "day", "hour")])
    raw = spark.createDataFrame([("a", "2.5", "2024", "01", "01", "00"), ("a", "junk", "2024", "01", "01", "00"),
                                 ("a", "4", "2024", "01", "01", "01")], schema)
    rows = sorted((r["hour_time"], r["acc"]) for r in R.rollup_hour(normalize(raw)).collect())
    assert rows == [("2024-01-01 00:00:00", 2.5), ("2024-01-01 01:00:00", 4.0)]


def test_text_measure_counts_like_hive(spark):
    """Hive's count(sum) counts every non-null text value; only sums cast it."""
    from pyspark.sql import types as T
    from tallycast.sources.tables import normalize
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("attack_type", "sum", "year", "month", "day", "hour")])
    raw = spark.createDataFrame([("a", "4", "2024", "01", "01", "00"), ("a", "n/a", "2024", "01", "01", "05"),
                                 ("a", "n/a", "2024", "01", "02", "00"), ("a", None, "2024", "01", "02", "00")],
                                schema)
    st = normalize(raw)
    counts = sorted((r["time_hour"], r["acc"]) for r in R.rollup_day_count(st).collect())
    assert counts == [("2024-01-01 00:00:00", 2), ("2024-01-02 00:00:00", 1)]
    sums = sorted((r["day_time"], r["acc"]) for r in R.rollup_day(st).collect())
    assert sums == [("2024-01-01", 4.0)]  # 2024-01-02 has no number: no rollup row


def test_spellings_of_a_period_are_one_row(spark):
    rows = [("a", 10.0 * d, "2024", "01", f"0{d}", "00") for d in range(1, 7)]
    st = stat_frame(spark, rows + [("a", 10.0, "2024", "1", "4", "0")])
    got = {r["time_day"]: r["real_count"] for r in jobs.backfill(st, "day").where("time_day >= '2024-01-04'").collect()}
    assert got["2024-01-05"] == 50 and got["2024-01-04"] == 50  # 40 + 10 of the other spelling
    assert jobs.backfill(st, "day").where("time_day = '2024-01-05'").count() == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_impossible_dates_are_rejected_and_listed(spark, ansi):
    rows = [("a", 1.0, "2024", "02", f"{d:02d}", "01") for d in (27, 28, 29, 30)] + [("a", 5.0, "2024", "xx", "01", "01"), ("a", 5.0, "2024", "02", "01", "25")]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        st = stat_frame(spark, rows)
        clean = stat_frame(spark, rows[:3] + [rows[5]])
        for g in ("day", "week", "legacy_day"):
            assert sorted(map(str, jobs.predict(st, g).collect())) == sorted(map(str, jobs.predict(clean, g).collect())), g
        assert [r["label"] for r in jobs.rejected_periods(st, "day").collect() if r["label"]] == ["2024-02-30"]
        assert jobs.rejected_periods(st, "day").count() == 2
        assert jobs.predict(st, "hour").count() == jobs.predict(stat_frame(spark, rows[:3]), "hour").count()
        assert jobs.rejected_periods(st, "hour").count() == 3 and jobs.rejected_periods(st, "legacy_day").count() == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("grain", jobs.GRAINS)
def test_empty_table(spark, grain):
    st = stat_frame(spark, [])
    assert jobs.predict(st, grain).collect() == [] and jobs.rejected_periods(st, grain).collect() == []
    assert st.count() == 0


def test_sink_counts_are_ints_in_every_grain(spark):
    st = stat_frame(spark, [("a", 1.0, "2024", "01", f"{d:02d}", "01") for d in range(1, 9)])
    for g in jobs.GRAINS:
        assert dict(jobs.predict(st, g).dtypes)["real_count"] == "int", g


def test_exact_sums_do_not_depend_on_the_layout(spark):
    from pyspark.sql import functions as F
    from tallycast.sources.tables import normalize
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    raw = events.select(F.lit("a").alias("attack_type"), (F.col("value") / 7).alias("sum"), F.year("ts").alias("year"),
                        F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"))
    sums = [sorted(map(tuple, jobs.R.rollup_day(normalize(x, exact_scale=6)).collect())) for x in (raw, raw.repartition(16), raw.coalesce(1))]
    assert sums[0] == sums[1] == sums[2]
    partials = jobs.R.hour_partials(normalize(raw, exact_scale=6))
    assert sorted(map(tuple, jobs.R.rollup_day(partials).collect())) == sums[0]
