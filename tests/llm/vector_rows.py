"""Embedding rows with every case that the vector operators define."""

from __future__ import annotations

import numpy as np

SCHEMA = "vec_id long, embedding array<float>, label int, ints string, code string, n long, entry long, chunk int"


def hard_rows(n: int = 700) -> list[tuple]:
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(int(i), [float(np.float32(v)) for v in x[i]], int(i % 7) if i % 11 else None) for i in range(n)]
    same = rows[3][1]
    rows += [(10_000 + i, same, 1) for i in range(300)]  # one very common vector
    rows += [rows[5], rows[5], (6, rows[9][1], None), (None, rows[8][1], 3), (None, None, None)]
    rows += [(20_000, None, 1), (20_001, [], 1), (20_002, [*same[:63], None], 1), (20_003, [*same[:63], float("nan")], 1),
             (20_004, [*same[:63], float("inf")], 2), (20_020, [0.0] * 64, 2), (20_006, same[:32], 2), (20_040, [*same, 1.0], 2)]
    rows += [(30_000, [3e30, *same[1:]], 5), (-20, [-1e9] * 64, 5), (40_000, [0.5 - 1e-9] * 64, None)]
    single = lambda v: None if v is None else [None if c is None else float(np.float32(c)) for c in v]  # noqa: E731  as the column holds it
    return [(i, single(v), label, "ints", "code", 1, 2, 3) for i, v, label in rows]


def kept(rows: list[tuple], dims: int | None = None) -> list[tuple]:
    out = [(r[0], r[1], r[2]) for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    return [r for r in out if dims is None or len(r[1]) == dims]


def nulls_last(r: tuple) -> tuple:
    return (r[0] is None, r[0] or 0, r[1])
