"""Numeric Column helpers that behave the same whatever ``spark.sql.ansi.enabled`` says.

The forecasts divide doubles and then truncate to a 32-bit int the way JVM
``Double.toInt`` does: toward zero, saturating at the int bounds, NaN -> 0.
Spark 4 in ANSI mode raises on a zero divisor and on an out-of-range cast, and
in legacy mode returns NULL for a zero divisor, so both steps are spelled out
with ``when`` guards.  Every branch is a plain Catalyst expression and stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 32-bit signed int range that truncated forecasts saturate to.
INT_MAX = 2147483647
INT_MIN = -2147483648


def ieee_div_sql(a: str, b: str) -> str:
    """SQL text of ``ieee_div`` over two SQL operands (column names or expressions)."""
    a, b = f"CAST(({a}) AS DOUBLE)", f"CAST(({b}) AS DOUBLE)"
    return (f"(CASE WHEN {b} = 0 THEN (CASE WHEN {a} > 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN {a} < 0 THEN CAST('-Infinity' AS DOUBLE) ELSE CAST('NaN' AS DOUBLE) END) "
            f"ELSE {a} / {b} END)")


def trunc_int_sql(d: str) -> str:
    """SQL text of ``trunc_int`` over a SQL operand."""
    d = f"CAST(({d}) AS DOUBLE)"
    return (f"CAST(CASE WHEN isnan({d}) THEN 0 WHEN {d} >= {INT_MAX} THEN {INT_MAX} "
            f"WHEN {d} <= {INT_MIN} THEN {INT_MIN} ELSE CAST({d} AS INT) END AS INT)")


def ieee_div(a: str, b: str) -> Column:
    """``a / b`` on doubles with IEEE-754 results for a zero divisor (operands: column names or SQL).

    x/0 is +Infinity for x > 0, -Infinity for x < 0 and NaN for 0/0 or NaN/0.
    The sign of a negative zero divisor is not tracked (sums here are never -0.0).
    """
    return F.expr(ieee_div_sql(a, b))


def trunc_int(d: str) -> Column:
    """Double -> int, truncating toward zero and saturating; NaN -> 0; NULL stays NULL.

    NaN is tested first because Spark orders NaN above every other double.
    """
    return F.expr(trunc_int_sql(d))
