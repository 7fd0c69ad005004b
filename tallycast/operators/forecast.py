"""Growth-ratio forecasts over every series at once.

One window pass per grain: ``Window.partitionBy(attack_type).orderBy(period)``
gives each rollup row its position ``rn`` and the three previous values, from
which each row emits up to two output rows (a *seed* row labelled with its own
period and a *forecast* row labelled with the calendar successor).  The rows
are produced with ``inline(filter(array(...)))`` in the same stage as the
window, so there is no union, no second pass and no driver loop.

A window partition is one series after rollup: at most one row per period of
its history (e.g. 8,760 rows per year of hours), whatever the raw volume, and
Spark's window buffer spills to disk beyond its threshold.

Rules, with x the rollup values of one series in period order, ``l1..l3`` the
values one to three periods back (positional, so a gap does not reset them):

* forecast rows, for ``rn >= 3``, label = successor of the row's period:
  forward ratio  ``trunc(l1 * (l1/l2 + l2/l3) / 2)``
  inverse ratio  ``trunc(trunc(l1) * (l2/l1 + l3/l2) / 2)``   (hourly default)
* seed rows, for ``rn <= 3`` (``<= 2`` for months), label = the row's period:
  rn 0 and 1 -> 0, rn 2 -> ``trunc(l2)`` (= x[0]), rn 3 -> ``trunc(l2*l2/l3)``.
* monthly seeds are repeated ``max(1, n - 3)`` times (one copy per forecast
  step), and a monthly forecast row carries ``trunc(x)`` as provisional actual.

Division is IEEE (``ieee_div``) and truncation saturating (``trunc_int``); the
operand order matches the definitions above so doubles agree bit for bit
before truncation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.numeric import ieee_div_sql, trunc_int_sql
from ..sources.tables import TYPE_COL

ACTUAL = "_actual"  # measured value of the row's label, carried to backfill.py
MARK_YEAR = "_mark_year"  # set on period marker rows only (label-keyed backfill)


@dataclass(frozen=True)
class SeriesSpec:
    """How a prepared rollup frame is ordered and labelled.

    order       columns giving period order within a series
    label       this period's label
    next_label  label of the calendar successor
    next_key    successor as a period value, compared with ``lead(order[0])`` to
                find the successor's actual positionally (None: no positional actual)
    year        column carried as ``year`` on output rows (weeks only)
    next_year   ``year`` of forecast rows (default: the row's own ``year``)
    seed_year_first  seed rows take the series' first ``year``
    """

    order: tuple[str, ...]
    label: str
    next_label: str
    next_key: str | None = None
    year: str | None = None
    next_year: str | None = None
    seed_year_first: bool = False


def growth_forecast(
    prepared: DataFrame,
    spec: SeriesSpec,
    *,
    x: str = "acc",
    ratio: str = "forward",
    seed3: bool = True,
    repeat_seeds: bool = False,
    provisional_actual: bool = False,
    emit: tuple[str, ...] = ("seed", "forecast"),
    markers: bool = False,
) -> DataFrame:
    """Forecast rows (attack_type, time, predict_count, real_count[, year], _actual[, _mark_year]).

    ``real_count`` is the value the rows are first written with (0, or the
    provisional actual for months); ``_actual`` is the measured value of the
    row's label when the series has it (always for seeds; for forecasts when the
    successor is the next row), for positional backfill.  ``emit`` selects seed
    rows, forecast rows or both.  ``markers`` adds one row per rollup period
    (``_mark_year`` set, ``_actual`` = its value) for label-keyed backfill.

    The step is written as SQL expressions (``selectExpr``): the same Catalyst
    plan as the Column API, built with a handful of driver calls instead of
    thousands.
    """
    if ratio not in ("forward", "inverse"):
        raise ValueError(f"ratio must be 'forward' or 'inverse', got {ratio!r}")
    order = ", ".join(spec.order)
    over = f"OVER (PARTITION BY {TYPE_COL} ORDER BY {order})"
    xv = f"CAST({x} AS DOUBLE)"
    cols = [TYPE_COL, f"{xv} AS _x", f"{spec.label} AS _label", f"{spec.next_label} AS _next",
            f"row_number() {over} - 1 AS _rn",
            *[f"lag({xv}, {k}) {over} AS _l{k}" for k in (1, 2, 3)]]
    if spec.next_key is not None:
        cols += [f"{spec.next_key} AS _next_key", f"lead({spec.order[0]}, 1) {over} AS _lead_key",
                 f"lead({xv}, 1) {over} AS _lead_x"]
    if repeat_seeds:
        cols.append(f"count(1) OVER (PARTITION BY {TYPE_COL} ORDER BY {order} "
                    "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS _n")
    if spec.year is not None:
        cols.append(f"{spec.year} AS _year")
        if spec.seed_year_first:
            cols.append(f"first({spec.year}) {over} AS _first_year")
        if spec.next_year:
            cols.append(f"{spec.next_year} AS _next_year")
    win = prepared.selectExpr(*cols)
    # Doubles are computed once here; the row structs below only truncate them.
    win = win.selectExpr("*", f"{ratio_value_sql(ratio, '_l1', '_l2', '_l3')} AS _fv",
                         f"{ieee_div_sql('_l2 * _l2', '_l3')} AS _s3")

    def entry(time: str, predict: str, real: str, year: str | None, actual: str,
              mark_year: str = "NULL") -> str:
        fields = [f"'time', CAST({time} AS STRING)", f"'predict_count', CAST({predict} AS INT)",
                  f"'real_count', CAST({real} AS INT)"]
        if spec.year is not None:
            fields.append(f"'year', CAST({year} AS STRING)")
        fields.append(f"'{ACTUAL}', CAST({actual} AS DOUBLE)")
        if markers:
            fields.append(f"'{MARK_YEAR}', CAST({mark_year} AS STRING)")
        return f"named_struct({', '.join(fields)})"

    seed_year = fc_year = None
    if spec.year is not None:
        seed_year = "_first_year" if spec.seed_year_first else "_year"
        fc_year = "_next_year" if spec.next_year else "_year"
    seed_pred = f"CASE _rn WHEN 2 THEN {trunc_int_sql('_l2')} WHEN 3 THEN {trunc_int_sql('_s3')} ELSE 0 END"
    seed_on = f"_rn <= {3 if seed3 else 2}" if "seed" in emit else "false"
    fc_on = "_rn >= 3" if "forecast" in emit else "false"
    succ_actual = "CASE WHEN _lead_key = _next_key THEN _lead_x END" if spec.next_key else "NULL"
    fc_real = trunc_int_sql("_x") if provisional_actual else "0"
    seed = f"CASE WHEN {seed_on} THEN {entry('_label', seed_pred, '0', seed_year, '_x')} END"
    fc = f"CASE WHEN {fc_on} THEN {entry('_next', trunc_int_sql('_fv'), fc_real, fc_year, succ_actual)} END"
    if repeat_seeds:
        rows = f"concat(array_repeat({seed}, CAST(greatest(1, _n - 3) AS INT)), array({fc}))"
    else:
        rows = f"array({seed}, {fc})"
    if markers:
        mark = entry("_label", "NULL", "NULL", "_year" if spec.year else None, "_x",
                     "_year" if spec.year else "''")
        rows = f"concat({rows}, array({mark}))"
    return win.selectExpr(TYPE_COL, f"inline(filter({rows}, e -> e IS NOT NULL))")


def ratio_value_sql(ratio: str, l1: str, l2: str, l3: str) -> str:
    """SQL text of the forecast double before truncation (see the module doc)."""
    if ratio == "forward":
        return f"({l1} * ({ieee_div_sql(l1, l2)} + {ieee_div_sql(l2, l3)}) / 2.0)"
    return (f"(CAST({trunc_int_sql(l1)} AS DOUBLE) * "
            f"({ieee_div_sql(l2, l1)} + {ieee_div_sql(l3, l2)}) / 2.0)")


def growth_terms(prepared: DataFrame, spec: SeriesSpec, *, x: str = "acc",
                 ratio: str = "forward") -> DataFrame:
    """The ratio sum behind each forecast row: (attack_type, time, growth, predict_count).

    ``growth`` is ``l1/l2 + l2/l3`` (forward) or ``l2/l1 + l3/l2`` (inverse).
    """
    over = f"OVER (PARTITION BY {TYPE_COL} ORDER BY {', '.join(spec.order)})"
    xv = f"CAST({x} AS DOUBLE)"
    win = prepared.selectExpr(TYPE_COL, f"{spec.next_label} AS time", f"row_number() {over} - 1 AS _rn",
                              *[f"lag({xv}, {k}) {over} AS _l{k}" for k in (1, 2, 3)])
    if ratio == "forward":
        growth = f"{ieee_div_sql('_l1', '_l2')} + {ieee_div_sql('_l2', '_l3')}"
    else:
        growth = f"{ieee_div_sql('_l2', '_l1')} + {ieee_div_sql('_l3', '_l2')}"
    value = trunc_int_sql(ratio_value_sql(ratio, "_l1", "_l2", "_l3"))
    return win.where("_rn >= 3").selectExpr(TYPE_COL, "time", f"{growth} AS growth",
                                            f"{value} AS predict_count")


def legacy_growth(rollup_count: DataFrame, *, order: tuple[str, ...] = ("_day",),
                  label: str = "time_hour", x: str = "acc") -> DataFrame:
    """One-step relative growth on daily counts.

    For each period i >= 1 whose predecessor count is non-zero:
    (label of i, current = x[i], next = trunc(x[i] * (1 + (x[i] - x[i-1]) / x[i-1]))).
    A series with a single period predicts persistence: (label, x[0], x[0]).
    Output: (attack_type, time_hour, real_count, predict_count).
    """
    over = f"OVER (PARTITION BY {TYPE_COL} ORDER BY {', '.join(order)})"
    win = rollup_count.selectExpr(TYPE_COL, f"{label} AS _label", f"{x} AS _x", f"lag({x}, 1) {over} AS _prev",
                                  f"lead({x}, 1) {over} AS _next_x", f"row_number() {over} - 1 AS _rn")
    single = "_rn = 0 AND _next_x IS NULL"
    grown = f"_x * (1.0D + {ieee_div_sql('_x - _prev', '_prev')})"
    predict = f"CASE WHEN {single} THEN {trunc_int_sql('_x')} ELSE {trunc_int_sql(grown)} END"
    return win.where(f"(_rn >= 1 AND _prev <> 0) OR ({single})").selectExpr(
        TYPE_COL, f"_label AS {label}", "_x AS real_count", f"{predict} AS predict_count")
