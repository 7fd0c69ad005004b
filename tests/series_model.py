"""
brute-force truth for small fixtures, plus helpers that lay a list of values
out as statistics rows at a given grain."""

from __future__ import annotations

import datetime as dt
import math

INT_MAX, INT_MIN = 2147483647, -2147483648


def to_int(d: float) -> int:
    """JVM Double.toInt."""
    if math.isnan(d):
        return 0
    if d >= INT_MAX:
        return INT_MAX
    if d <= INT_MIN:
        return INT_MIN
    return int(d)


def div(a: float, b: float) -> float:
    """IEEE division."""
    if b == 0:
        return math.inf if a > 0 else (-math.inf if a < 0 else math.nan)
    return a / b


def predicted_rows(xs, labels, succ, grain, years=None):
    """Rows as first inserted: (label, real_count, predict_count, year)."""
    n = len(xs)
    month = grain == "month"
    last_seed = 2 if month else 3
    copies = max(1, n - 3) if month else 1
    yr0 = years[0] if years else None
    rows = []
    for k in range(min(n, last_seed + 1)):
        p = 0 if k < 2 else (to_int(xs[0]) if k == 2 else to_int(div(xs[1] * xs[1], xs[0])))
        rows += [(labels[k], 0, p, yr0)] * copies
    for j in range(3, n):
        if grain == "hour":
            p = to_int(to_int(xs[j - 1]) * (div(xs[j - 2], xs[j - 1]) + div(xs[j - 3], xs[j - 2])) / 2.0)
        else:
            p = to_int(xs[j - 1] * (div(xs[j - 1], xs[j - 2]) + div(xs[j - 2], xs[j - 3])) / 2.0)
        real = to_int(xs[j]) if month else 0
        rows.append((succ[j], real, p, years[j] if years else None))
    return rows


def backfilled(rows, actuals):
    """Apply (label, acc) updates in order: every row with that label takes trunc(acc)."""
    out = [list(r) for r in rows]
    for label, acc in actuals:
        for r in out:
            if r[0] == label:
                r[1] = to_int(acc)
    return [tuple(r) for r in out]


def legacy_rows(counts, labels):
    """(label, current, next) of the one-lag growth rule."""
    if len(counts) == 1:
        return [(labels[0], counts[0], counts[0])]
    out = []
    for i in range(1, len(counts)):
        prev = counts[i - 1]
        if prev != 0:
            g = (counts[i] - prev) / float(prev)
            out.append((labels[i], counts[i], to_int(counts[i] * (1.0 + g))))
    return out


# ---------------------------------------------------------------- layouts

def periods(grain, start, steps):
    """Datetimes of periods at integer offsets ``steps`` from ``start``."""
    out = []
    for s in steps:
        if grain == "hour":
            out.append(start + dt.timedelta(hours=s))
        elif grain in ("day", "legacy_day"):
            out.append(start + dt.timedelta(days=s))
        elif grain == "week":
            out.append(start + dt.timedelta(days=7 * s))
        else:
            m = start.month - 1 + s
            out.append(start.replace(year=start.year + m // 12, month=m % 12 + 1, day=1))
    return out


def parts(t):
    return (f"{t.year:04d}", f"{t.month:02d}", f"{t.day:02d}", f"{t.hour:02d}")


def label_of(grain, t):
    y, m, d, h = parts(t)
    if grain == "hour":
        return f"{y}-{m}-{d} {h}:00:00"
    if grain == "day":
        return f"{y}-{m}-{d}"
    if grain == "legacy_day":
        return f"{y}-{m}-{d} 00:00:00"
    if grain == "week":
        return str(t.isocalendar()[1])
    return f"{y}{m}"


def succ_of(grain, t):
    if grain == "hour":
        return label_of(grain, t + dt.timedelta(hours=1))
    if grain == "day":
        return label_of(grain, t + dt.timedelta(days=1))
    if grain == "week":
        return str((t.isocalendar()[1] + 1) % 52)
    return label_of(grain, periods("month", t, [1])[0])


STARTS = {
    "hour": dt.datetime(2017, 12, 31, 21),
    "day": dt.datetime(2024, 2, 26),
    "legacy_day": dt.datetime(2024, 2, 26),
    "week": dt.datetime(2016, 12, 5),
    "month": dt.datetime(2017, 10, 1),
}


def grouped_weeks(dates, xs, iso_year=False):
    """Roll dated values up the way the weekly job keys them.

    Default key: (calendar year, ISO week), so late-December days of ISO week 1
    join that calendar year's week 1.  ``iso_year``: (ISO year, ISO week).
    Returns [(year, week, sum)] in key order.
    """
    acc = {}
    for d, x in zip(dates, xs):
        iy, w, _ = d.isocalendar()
        key = (str(iy) if iso_year else f"{d.year:04d}", w)
        acc[key] = acc.get(key, 0.0) + x
    return [(y, w, acc[(y, w)]) for y, w in sorted(acc)]


def weekly_truth(dates, xs, iso_year=False):
    """Backfilled weekly rows (label, real_count, predict_count, year)."""
    weeks = grouped_weeks(dates, xs, iso_year)
    vals = [a for _, _, a in weeks]
    labels = [str(w) for _, w, _ in weeks]
    years = [y for y, _, _ in weeks]
    if not iso_year:
        succ = [str((w + 1) % 52) for _, w, _ in weeks]
        rows = predicted_rows(vals, labels, succ, "week", years)
        return backfilled(rows, list(zip(labels, vals)))
    # ISO mode: labels carry their own ISO year; the successor is the next ISO week
    mondays = [dt.date.fromisocalendar(int(y), w, 1) for y, w, _ in weeks]
    nxt = [m + dt.timedelta(days=7) for m in mondays]
    succ = [str(n.isocalendar()[1]) for n in nxt]
    rows = predicted_rows(vals, labels, succ, "week", years)
    # seeds keep their own year; forecasts take the successor's ISO year
    n_seed = min(len(vals), 4)
    rows = [(lab, real, p, years[i]) for i, (lab, real, p, _) in enumerate(rows[:n_seed])] + \
           [(lab, real, p, str(nxt[j].isocalendar()[0])) for j, (lab, real, p, _) in
            zip(range(3, len(vals)), rows[n_seed:])]
    actual = {(years[i], labels[i]): vals[i] for i in range(len(vals))}
    return [(lab, to_int(actual[(y, lab)]) if (y, lab) in actual else real, p, y) for lab, real, p, y in rows]
