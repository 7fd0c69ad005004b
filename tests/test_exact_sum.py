import math
import random
from fractions import Fraction
from functools import reduce
from operator import add

from pyspark.sql import functions as F

from tallycast.functions import exact_sum as E
from tallycast.operators import rollup as R
from tallycast.plans import jobs
from tallycast.sources import fixtures as fx
from tallycast.sources.tables import normalize
from tests.conftest import SF_SMALL


def total(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    row = E.combined(E.with_digits(df, "v").groupBy(F.lit(1).alias("g")).agg(*E.digit_sums()), "s").first()
    return row.s


def test_every_order_and_layout_gives_the_same_double(spark):
    rng = random.Random(3)
    values = [rng.choice((-1, 1)) * rng.random() * 10.0 ** rng.randint(-9, 12) for _ in range(3000)] + [0.1] * 500 + [None, 0.0, -0.0]
    exact = sum(Fraction(v) for v in values if v is not None)
    got = set()
    for parts in (1, 3, 7):
        rng.shuffle(values)
        got.add(total(spark, values, parts))
    (one,) = got
    assert abs(Fraction(one) - exact) <= 2 * Fraction(math.ulp(one))
    assert len({reduce(add, sorted((v for v in values if v is not None), key=lambda _: rng.random())) for _ in range(20)}) > 1  # a plain sum varies


def test_cases(spark):
    assert total(spark, [None, None], 2) is None
    assert total(spark, [1e300, 1.5, None], 1) == 1e300
    assert total(spark, [float("inf"), 1.0], 1) == float("inf") and math.isnan(total(spark, [float("inf"), float("-inf"), 2.0], 1))
    assert math.isnan(total(spark, [float("nan"), 2.0], 1))
    assert total(spark, [-0.1] * 10, 3) == -1.0 and total(spark, [-3.0, 5.0], 2) == 2.0
    assert total(spark, [2.0 ** 52, -2.0 ** 52, 2.0 ** -60], 2) == 2.0 ** -60
    assert total(spark, [2.0 ** 53, 1.0], 1) == 2.0 ** 53 + 1.0


def raw(spark, parts=None):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    return fx.events_as_raw_values(ev if parts is None else ev.repartition(parts, "value"))


def test_rollups_and_forecasts_of_fractions_do_not_depend_on_the_layout(spark):
    for build in (R.rollup_hour, R.rollup_day, R.rollup_week, R.rollup_month, lambda s: R.rollup_month(R.hour_partials(s)),
                  lambda s: jobs.predict(s, "hour"), lambda s: jobs.predict(s, "day"), lambda s: jobs.predict(s, "week")):
        assert sorted(map(str, build(raw(spark)).collect())) == sorted(map(str, build(raw(spark, 5)).collect()))
    assert sorted(map(str, R.rollup_month(raw(spark)).collect())) == sorted(map(str, R.rollup_month(R.hour_partials(raw(spark, 3))).collect()))


def test_decimals_are_summed_as_they_are(spark):
    rows = [("a", 0.1, "2024", "01", "01", "00")] * 10
    df = spark.createDataFrame(rows, "attack_type string, sum double, year string, month string, day string, hour string")
    assert [r.acc for r in R.rollup_hour(normalize(df, exact_scale=3)).collect()] == [1.0]
    assert [r.acc for r in R.rollup_hour(R.hour_partials(normalize(df, exact_scale=3))).collect()] == [1.0]
