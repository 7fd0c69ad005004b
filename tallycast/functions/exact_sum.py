"""Sums of doubles that are the same for every order of the terms and every layout of the tasks.

A double below 2**53 is cut, exactly, into five whole numbers of 24 bits: two for
its integer part and three for its fraction (what lies below 2**-72 is cut off).
Each is summed as a long, which no order changes, and 2**39 terms fit.  Only the
finished sums are put together again, with two roundings: of the integer part and of
the fraction.  Whole numbers below 2**53 in total sum to themselves.  Larger
terms, infinities and NaN are summed as doubles beside them.

Everything is built-in expressions and built-in sums, so partial aggregation, merging
of partial rows and code generation stay as they are for a plain sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = ("_d0", "_d1", "_d2", "_d3", "_d4")
BIG = "_big"
#: The columns that stand for one sum.
SUM_COLS = (*DIGITS, BIG)
_UNIT = 1 << 24
_LIMIT = "9007199254740992D"  # 2**53


def _cut(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def _next(value: str) -> str:
    """What is left of ``value`` behind its whole part, 24 bits higher."""
    return f"(({value} - CAST({_cut(value)} AS DOUBLE)) * {_UNIT}D)"


def with_digits(df: DataFrame, measure: str) -> DataFrame:
    """``df`` with the columns ``SUM_COLS`` of the double column ``measure`` (and two helpers); all null where it is null."""
    inside = f"abs({measure}) < {_LIMIT}"
    df = df.selectExpr("*", f"CASE WHEN {inside} THEN {_cut(measure)} END AS _whole", f"CASE WHEN {inside} THEN {_next(measure)} END AS _rest",
                       f"CASE WHEN NOT {inside} THEN {measure} END AS {BIG}")
    return df.selectExpr("*", "shiftright(_whole, 24) AS _d0", f"_whole & {_UNIT - 1}L AS _d1", f"{_cut('_rest')} AS _d2",
                         f"{_cut(_next('_rest'))} AS _d3", f"{_cut(_next(_next('_rest')))} AS _d4")


def digit_sums() -> list[Column]:
    """The sums of ``SUM_COLS``: of terms, or of partial rows."""
    return [F.sum(c).alias(c) for c in SUM_COLS]


def combined(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the double ``name`` that the summed ``SUM_COLS`` stand for, in place of them; null where all are."""
    carried = "_d4"
    low = [f"(_d4 & {_UNIT - 1}L)"]  # the digits below 2**24, from the last
    for i in (3, 2, 1, 0):
        carried = f"(_d{i} + shiftright({carried}, 24))"
        low.append(f"({carried} & {_UNIT - 1}L)")
    whole = f"CAST({carried} AS DOUBLE) * {_UNIT}D + CAST({low[3]} AS DOUBLE)"
    part = f"(CAST({low[2]} * {_UNIT}L + {low[1]} AS DOUBLE) * {_UNIT}D + CAST({low[0]} AS DOUBLE)) / 4722366482869645213696D"  # 2**72
    total = f"({whole}) + {part}"
    return df.selectExpr(*[c for c in df.columns if c not in SUM_COLS],
                         f"CASE WHEN _d0 IS NULL THEN {BIG} ELSE {total} + coalesce({BIG}, 0D) END AS {name}")
