import hashlib

import numpy as np
import pytest

from tallycast.llm import zone_clusters as Z
from tests.llm import vector_rows as V


def brute(rows, k=40, rounds=5):
    mark = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    rows = sorted(V.kept(rows, 64), key=lambda r: (r[0] is None, "" if r[0] is None else mark(r[0]), r[1]))
    x = np.clip(np.floor(256 * np.array([r[1] for r in rows])), -Z.LIMIT, Z.LIMIT).astype(np.int64)
    c = x[:k].copy()
    for r in range(rounds + 1):
        d = np.stack([((x - e) ** 2).sum(-1) for e in c], axis=1)
        near = d.argmin(1)
        if r < rounds:
            for e in range(len(c)):
                if (near == e).any():
                    c[e] = x[near == e].sum(0) // (near == e).sum()
    d = d.min(1)
    shas = [hashlib.sha256(",".join(map(str, e.tolist())).encode()).hexdigest() for e in c]
    return [(r[0], int(near[i]), int(d[i]), int(d[near == near[i]].sum()), int(d.sum()), shas[near[i]]) for i, r in enumerate(rows)]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("n", [700, 30, 1])
def test_against_comparing_all(spark, n):
    rows = V.hard_rows() if n == 700 else V.hard_rows()[:n]
    out = Z.clusters(spark.createDataFrame(rows, V.SCHEMA).repartition(5))
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert ordered(out.collect()) == ordered(brute(rows))


def test_no_rows(spark):
    assert Z.clusters(spark.createDataFrame([], V.SCHEMA)).collect() == []
    assert Z.clusters(spark.createDataFrame([(1, None, 1, "", "", 1, 1, 1)], V.SCHEMA)).collect() == []


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_steps_of_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = Z.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_boxes_keep_the_nearest_centre_and_put_others_aside():
    rng = np.random.default_rng(3)
    groups = rng.integers(-3000, 3000, size=(40, 64))
    total = 0
    for g in groups:
        x = g + rng.integers(-40, 40, size=(Z.BLOCK, 64))
        use = Z.candidates(x.min(0)[None], x.max(0)[None], groups)[0]
        assert use[Z.squared_distances(x, groups).argmin(1)].all()
        total += use.sum()
    assert total == len(groups)  # one candidate a block


def test_blocks_hold_every_row_and_tight_boxes(spark):
    rows = V.hard_rows()
    table = Z.blocks(Z.plain(spark.createDataFrame(rows, V.SCHEMA)).where("size(embedding) = 64"), 256, 64).collect()
    assert sum(r.n for r in table) == len(V.kept(rows, 64)) and max(r.n for r in table) <= Z.BLOCK
    for r in table:
        x = np.frombuffer(r.ints, np.int32).reshape(-1, 64)
        assert (x.min(0) == np.frombuffer(r.low, np.int32)).all() and (x.max(0) == np.frombuffer(r.high, np.int32)).all()
