import hashlib
from collections import defaultdict

import numpy as np
import pytest

from tallycast.llm import pivot_codes as P
from tests.llm import vector_rows as V


def brute(rows, parts=4, k=256, rounds=4):
    rows = sorted(V.kept(rows, 64), key=V.nulls_last)
    x = np.clip(np.floor(1024 * np.array([r[1] for r in rows])), -P.LIMIT, P.LIMIT).astype(np.int64).reshape(len(rows), parts, -1)
    books = x[:k].copy()
    for r in range(rounds + 1):
        d = np.stack([((x - e) ** 2).sum(-1) for e in books], axis=2)  # rows x parts x entries
        near = d.argmin(2)
        if r < rounds:
            for p in range(parts):
                for e in range(len(books)):
                    if (near[:, p] == e).any():
                        books[e, p] = x[near[:, p] == e, p].sum(0) // (near[:, p] == e).sum()
    error = d.min(2).sum(1).tolist()
    by_label = defaultdict(int)
    for row, e in zip(rows, error, strict=True):
        by_label[row[2]] += e
    digest = hashlib.sha256(",".join(map(str, books.transpose(1, 0, 2).ravel().tolist())).encode()).hexdigest()
    return [(row[0], "".join(f"{c:02x}" for c in near[i]), error[i], by_label[row[2]], digest) for i, row in enumerate(rows)]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("n", [700, 150, 1])
def test_against_comparing_all(spark, n):
    rows = V.hard_rows(700)[:n] if n < 700 else V.hard_rows()
    out = P.codes(spark.createDataFrame(rows, V.SCHEMA).repartition(5))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert ordered(out.collect()) == ordered(brute(rows))


def test_no_rows(spark):
    assert P.codes(spark.createDataFrame([], V.SCHEMA)).collect() == []
    assert P.codes(spark.createDataFrame([(1, None, 1, "", "", 1, 1, 1), (2, [1.0], 1, "", "", 1, 1, 1)], V.SCHEMA)).collect() == []


@pytest.mark.parametrize("spread", [0.05, 1.0, 5000.0])
def test_bounds_put_aside_no_nearest_entry(spread):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(32, 16)) * 1000
    parts = np.floor(centres[rng.integers(0, 32, 3000)] + rng.normal(size=(3000, 16)) * 1000 * spread).astype(np.int32)
    entries = parts[:256].astype(np.int64)
    pivots = P.choose_pivots(entries, 16)
    near, d, done = P.nearest_entries(parts, P.pivot_distances(parts, pivots), entries, P.pivot_distances(entries, pivots))
    all_d = ((parts[:, None, :].astype(np.int64) - entries[None]) ** 2).sum(-1)
    assert (near == all_d.argmin(1)).all() and (d == all_d.min(1)).all()
    if spread < 0.1:  # grouped parts: most entries are never evaluated
        assert done < 0.2 * all_d.size


def test_pivots_are_distinct():
    assert len(P.choose_pivots(np.array([[1, 1], [1, 1], [5, 5]]), 16)) == 2
    assert len(P.choose_pivots(np.array([[1, 1]]), 16)) == 1
