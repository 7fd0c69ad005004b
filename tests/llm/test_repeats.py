import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tallycast.llm import repeats as R
from tallycast.llm.common import as_often
from tests.llm.conftest import prose


def brute(rows):
    """Bytes that stay, rows ordered by id (null first) and then by the text's hash."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - R.LENGTH + 1):
            s = hashlib.blake2b(data[i:i + R.LENGTH], digest_size=16).digest()
            if s in seen:
                gone[i:i + R.LENGTH] = b"\1" * R.LENGTH
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def patched_texts(seed, n):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(60, 400))) for _ in range(6)]
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(parts)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            text += rng.choice((p, p[a:b], p[a:b], "".join(rng.choices("xyz", k=rng.randint(0, 120)))))
        yield i * 3, ("a" if i % 37 == 0 else "ab") * rng.randint(0, 500) if i % 37 == 0 or i % 41 == 0 else text


def test_against_brute_force(spark, documents):
    df = spark.createDataFrame(list(patched_texts(1, 200)), "doc_id long, text string").repartition(7)
    want = brute([tuple(r) for r in df.collect()])
    assert rows_of(R.without_repeats(df)) == want
    assert rows_of(R.without_repeats(df, hot=2)) == want  # every larger run by its strings' hashes
    assert rows_of(R.without_repeats(documents)) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_hard_rows(hard, none):
    assert rows_of(R.without_repeats(hard)) == brute([(r.doc_id, r.text) for r in hard.collect()])
    assert R.without_repeats(none).collect() == []
    kept = R.without_repeats(hard, with_bytes=True).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.starts) == len(r.ends) == r.n_spans for r in kept)


def test_null_and_shared_ids(spark):
    texts = [t for _, t in patched_texts(7, 40)]
    rng = random.Random(8)
    rows = [(i, rng.choice(texts)) for i in [None] * 50 + [3] * 50 + list(range(-9, 9))] + [(None, texts[1])] * 20 + [(-(1 << 63), texts[1])] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(R.without_repeats(df)) == brute(rows)
    kept = R.without_repeats(df, with_bytes=True).collect()
    assert len(kept) == len(rows) and all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.starts) == len(r.ends) == r.n_spans for r in kept)


def test_copies_are_dealt_out(spark):
    df = as_often(spark.createDataFrame([("a", 1), ("b", 10), ("c", 25)], "block string, n long"), "n", block=4)
    assert df.columns == ["block"] and {r.block: r["count"] for r in df.groupBy("block").count().collect()} == {"a": 1, "b": 10, "c": 25}
    assert df.rdd.getNumPartitions() > 1


def test_stretches_do_not_matter(monkeypatch):
    import numpy as np
    rng = random.Random(3)
    buf = np.frombuffer(prose(rng, 3000).encode(), np.uint8)
    bounds = np.array([0, 50, 50, 7000, len(buf)])
    whole = R._block_anchors(buf, bounds)
    monkeypatch.setattr(R, "STRETCH", 777)
    parts = R._block_anchors(buf, bounds)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    gaps = np.diff(whole[0][(whole[0] >= 7000)])
    assert gaps.max() <= R.LENGTH - R.K + 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14))
def test_interval_tree(lcp):
    got = sorted(R.intervals(lcp))
    want = set()
    for depth in set(lcp) - {0}:
        first = 0
        for i, d in enumerate([*lcp, -1]):
            if d < depth:
                if i > first and min(lcp[first:i]) == depth:
                    want.add((depth, first, i))
                first = i + 1
    assert sorted((d, a, b) for d, _, a, b in got) == sorted(want)
    for depth, parent, first, last in got:
        around = [lcp[first - 1] if first else 0, lcp[last] if last < len(lcp) else 0]
        assert parent == max(around) < depth


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=6), min_size=1, max_size=9))
def test_longest_shared(words):
    keys = [w.encode() for w in words]
    best = R.longest_shared(sorted(range(len(keys)), key=lambda i: (keys[i], i)), keys)
    for i in range(len(keys)):
        assert best[i] == max((R.common(keys[i], keys[j]) for j in range(i)), default=-1)
