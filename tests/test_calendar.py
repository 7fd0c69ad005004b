from pyspark.sql import functions as F

from tallycast.functions import calendar as cal


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_next_hour_over_midnight(spark):
    ts = cal.hour_start(F.lit("2017"), F.lit("12"), F.lit("31"), F.lit("23"))
    assert _one(spark, cal.next_hour(ts)) == "2018-01-01 00:00:00"


def test_next_day_leap(spark):
    d = cal.day_date(F.lit("2024"), F.lit("02"), F.lit("28"))
    assert _one(spark, cal.next_day(d)) == "2024-02-29"
    d = cal.day_date(F.lit("2023"), F.lit("02"), F.lit("28"))
    assert _one(spark, cal.next_day(d)) == "2023-03-01"


def test_next_month_year_end(spark):
    assert _one(spark, cal.next_month(cal.month_start(F.lit("2017"), F.lit("12")))) == "201801"
    assert _one(spark, cal.next_month(cal.month_start(F.lit("2017"), F.lit("01")))) == "201702"


def test_next_week_date(spark):
    d = cal.day_date(F.lit("2017"), F.lit("12"), F.lit("28"))
    assert _one(spark, cal.next_week_date(d)) == "2018-01-04"


def test_week_number_wrap(spark):
    got = [_one(spark, cal.next_week_number(F.lit(w))) for w in (1, 50, 51, 52, 53)]
    assert got == [2, 51, 0, 1, 2]


def test_iso_week_against_calendar_year(spark):
    assert _one(spark, cal.week_of_year(F.lit("2017"), F.lit("01"), F.lit("01"))) == 52
    monday = cal.week_start(cal.day_date(F.lit("2017"), F.lit("01"), F.lit("01")))
    assert str(_one(spark, monday)) == "2016-12-26"
    y, w = cal.next_iso_week(monday)
    assert (_one(spark, y), _one(spark, w)) == ("2017", 1)


def test_week_start_is_monday(spark):
    for day in ("01", "02", "03", "04", "05", "06", "07"):
        d = cal.day_date(F.lit("2024"), F.lit("01"), F.lit(day))
        assert str(_one(spark, cal.week_start(d))) == "2024-01-01"


def test_labels(spark):
    assert _one(spark, cal.hour_label(F.lit("2024"), F.lit("01"), F.lit("02"), F.lit("03"))) == "2024-01-02 03:00:00"
    assert _one(spark, cal.day_label(F.lit("2024"), F.lit("01"), F.lit("02"))) == "2024-01-02"
    assert _one(spark, cal.midnight_label(F.lit("2024"), F.lit("01"), F.lit("02"))) == "2024-01-02 00:00:00"
    assert _one(spark, cal.month_label(F.lit("2024"), F.lit("01"))) == "202401"


def test_successors_ignore_session_time_zone(spark):
    """Labels are wall-clock values: a DST session zone must not move them."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2024-03-10 02:00 does not exist in New York (clocks jump to 03:00)
        ts = cal.hour_start(F.lit("2024"), F.lit("03"), F.lit("10"), F.lit("01"))
        assert _one(spark, cal.next_hour(ts)) == "2024-03-10 02:00:00"
        ts = cal.hour_start(F.lit("2024"), F.lit("11"), F.lit("03"), F.lit("01"))
        assert _one(spark, cal.next_hour(ts)) == "2024-11-03 02:00:00"
        d = cal.day_date(F.lit("2024"), F.lit("03"), F.lit("09"))
        assert _one(spark, cal.next_day(d)) == "2024-03-10"
        assert _one(spark, cal.next_month(cal.month_start(F.lit("2024"), F.lit("02")))) == "202403"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
