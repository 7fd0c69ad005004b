import numpy as np
import pytest

from tallycast.llm import graph_search as G
from tests.llm import vector_rows as V


def exact(rows, top=20, every=20):
    """Per query (id, vector) the scores of all candidates, nearest first."""
    rows = sorted({(r[0], tuple(r[1])) for r in V.kept(rows) if r[0] is not None and any(r[1])})
    out = {}
    for i, q in rows:
        if i % every == 0:
            score = [(-sum_of(q, v), j) for j, v in rows if j != i and len(v) == len(q)]
            out[i, q] = [(j, -s) for s, j in sorted(score)[:top]]
    return out


def sum_of(a, b):
    s = 0.0
    for x, y in zip(a, b, strict=True):
        s += x * y
    return s


def recall(found, rows, top=20):
    got, want = {}, exact(rows, top)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == sorted({i for i, _ in want if want[i, _]})
    hit = total = 0
    for (i, q), best in want.items():
        hit += len({j for j, _ in best} & {j for j, _ in got.get(i, [])})
        total += len(best)
    return hit / total


def test_hard_rows(spark):
    rows = V.hard_rows()
    out = G.neighbours(spark.createDataFrame(rows, V.SCHEMA).repartition(4)).collect()
    assert out[0].asDict().keys() == {"query_id", "rank", "vec_id", "score"}
    by_id = {}
    for r in V.kept(rows):
        if r[0] is not None:
            by_id.setdefault(r[0], set()).add(tuple(r[1]))
    for r in out:
        assert r.query_id % 20 == 0 and r.vec_id != r.query_id
        scores = [sum_of(a, b) for a in by_id[r.query_id] for b in by_id[r.vec_id] if len(a) == len(b)]
        assert r.score in scores  # bit for bit
    lists = {}
    for r in out:
        lists.setdefault(r.query_id, []).append(r)
    for q, rs in lists.items():
        rs.sort(key=lambda r: r.rank)
        assert [r.rank for r in rs] == list(range(1, len(rs) + 1))
        assert [(-r.score, r.vec_id) for r in rs] == sorted((-r.score, r.vec_id) for r in rs)
    assert not {20_000, 20_020} & set(lists)
    assert 20_040 not in lists  # 65 components: no other vector has them
    assert {10_000 + i for i in range(1, 20)} | {3} == {r.vec_id for r in lists[10_000]}  # copies, ties to the smaller id
    assert recall(out, rows) > 0.97


def test_several_shards_and_chunks(spark):
    rows = V.hard_rows(1500)[:1500]
    df = spark.createDataFrame(rows, V.SCHEMA)
    out = G.neighbours(df, shard_rows=300, chunk=20).collect()
    assert len(out) == 75 * 20 and recall(out, rows) > 0.99


def test_few_and_no_rows(spark):
    assert G.neighbours(spark.createDataFrame([], V.SCHEMA)).collect() == []
    rows = [(20, [1.0, 2.0], 1), (40, [1.0, 0.0], 1), (41, [3.0, -1.0], 1), (60, [0.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, "", "", 1, 1, 1) for r in rows], V.SCHEMA)
    assert sorted(map(tuple, G.neighbours(df).collect())) == [(20, 1, 40, 1.0), (20, 2, 41, 1.0), (40, 1, 41, 3.0), (40, 2, 20, 1.0)]


@pytest.mark.parametrize("kind", ["even", "groups", "lengths"])
def test_recall_of_a_shard(kind):
    rng = np.random.default_rng(4)
    n = 4000
    x = rng.normal(size=(n, 32))
    if kind == "groups":
        x = 3 * rng.normal(size=(20, 32))[rng.integers(0, 20, n)] + 0.1 * x
    if kind == "lengths":
        x *= rng.uniform(0.2, 3, size=(n, 1))
    level = -np.sort(-np.floor(-np.log(rng.random(n)) / np.log(G.LINKS)).astype(int))
    links = G.build(G.on_sphere(x), [int((level >= h).sum()) for h in range(level.max() + 1)])
    assert links[0].shape == (n, G.WIDTH) and ((links[0] >= 0).sum(1) > 0).all()
    shard = {"dims": 32, "n": n, "vectors": x.tobytes(), "counts": np.ones(n, np.int32).tobytes(), "ids": np.arange(n).tobytes(), "links": [a.tobytes() for a in links]}
    q, v, _ = G.search(shard, x[:200], np.arange(200), 20, G.SEARCH_BEAM)
    like = x[:200] @ x.T
    like[np.arange(200), np.arange(200)] = -np.inf
    best = np.argsort(-like, axis=1)[:, :20]
    assert np.mean([np.isin(best[i], v[q == i]).mean() for i in range(200)]) > 0.95
