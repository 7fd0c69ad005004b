import math

import pytest
from pyspark.sql import types as T

from tallycast.functions.numeric import INT_MAX, INT_MIN, ieee_div, trunc_int

INF = float("inf")


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


def _eval(spark, expr_fn, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr_fn().alias("v")).collect()]


DIV_CASES = [
    (1.0, 0.0, INF), (-1.0, 0.0, -INF), (0.0, 0.0, "nan"), (6.0, 3.0, 2.0),
    (1.0, 3.0, 1.0 / 3.0), (INF, 0.0, INF), (None, 2.0, None), (2.0, None, None),
]


def test_ieee_div(spark, ansi):
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())])
    got = _eval(spark, lambda: ieee_div("a", "b"), [(a, b) for a, b, _ in DIV_CASES], schema)
    for (a, b, want), v in zip(DIV_CASES, got):
        if want == "nan":
            assert math.isnan(v), (a, b, v)
        else:
            assert v == want, (a, b, v)


TRUNC_CASES = [
    (2.7, 2), (-2.7, -2), (0.0, 0), (3e9, INT_MAX), (-3e9, INT_MIN), (INF, INT_MAX),
    (-INF, INT_MIN), (float("nan"), 0), (None, None), (2147483647.5, INT_MAX),
    (-2147483648.5, INT_MIN), (2147483646.9, 2147483646), (34.99999999999999, 34),
]


def test_trunc_int(spark, ansi):
    schema = T.StructType([T.StructField("d", T.DoubleType())])
    got = _eval(spark, lambda: trunc_int("d"), [(d,) for d, _ in TRUNC_CASES], schema)
    assert got == [w for _, w in TRUNC_CASES]


def test_trunc_int_type(spark):
    df = spark.range(1).select(trunc_int("1.5D").alias("v"))
    assert df.schema["v"].dataType == T.IntegerType()
