import functools
import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from tallycast.llm import fingerprints as W
from tests.llm.conftest import prose


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_marks(text, k, w):
    data = text.encode()
    if not data:
        return set()
    grams = [data[i:i + k] for i in range(len(data) - k + 1)] or [data]
    keys = [signed(xxhash.xxh64(g, seed=42).intdigest()) >> 32 for g in grams]
    out = set()
    for i in range(max(1, len(keys) - w + 1)):
        window = keys[i:i + w]
        least = min(window)
        out.add((least, i + max(j for j, x in enumerate(window) if x == least)))  # rightmost of equal ones
    return out


def test_marks_against_brute_force(spark):
    rng = random.Random(1)
    texts = ["", "a", "ab" * 40, "a" * 100, "é" * 33, *(prose(rng, n) for n in (1, 3, 4, 5, 30, 200))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    for k, w in ((16, 16), (5, 4), (8, 1)):
        rows = W.marks(df, "t", "m", k, w).select("t", F.transform("m", lambda m: F.shiftright(m, 32)).alias("h"), W.mark_positions("m").alias("p")).collect()
        for r in rows:
            assert set(zip(r.h, r.p)) == brute_marks(r.t, k, w), (k, w, r.t)


def test_a_shared_run_shares_a_mark(spark):
    rng = random.Random(2)
    run = prose(rng, 20)[:W.K + W.W - 1]
    df = spark.createDataFrame([(prose(rng, 9) + run + prose(rng, 8), run + prose(rng, 30))], "a string, b string")
    for c in "ab":
        df = W.marks(df, c, f"m{c}").withColumn(f"h{c}", W.mark_hashes(f"m{c}"))
    assert df.select(F.size(F.array_intersect("ha", "hb"))).first()[0] >= 1


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """doc_id, n_chars, edited_sha256, near_edited, near_next of (doc_id, text)."""
    key = lambda r: (r[0] is None, -(r[0] or 0), signed(xxhash.xxh64((r[1] or "").encode(), seed=42).intdigest()))
    order = sorted(rows, key=key)
    hashes = functools.cache(lambda text: {h for h, _ in brute_marks(text, W.K, W.W)})
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        edited = text[:len(text) - len(text) // 3] + after[:len(text) // 3]
        yield (r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(),
               round(likeness(hashes(text), hashes(edited)), 9), round(likeness(hashes(text), hashes(after)), 9))


def by(rows):
    return sorted(rows, key=str)


def found(df):
    return by((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in W.edited_fingerprints(df).collect())


def test_edited_texts(spark, documents, hard, none, monkeypatch):
    for df in (documents, hard):
        want = by(expected([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]))
        for rows_a_bucket, fan in ((128, 256), (2, 3)):  # one bucket; borders at every second row
            monkeypatch.setattr(W, "ROWS", rows_a_bucket)
            monkeypatch.setattr(W, "FAN", fan)
            assert found(df) == want
    assert W.edited_fingerprints(none).collect() == []
    one = W.edited_fingerprints(spark.createDataFrame([(5, "abc")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(3, 1.0)]


def shared_ids():
    """A third of the rows without an id, a third with one id, copies among both, and some with ids beside them."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(0, 20)) for _ in range(60)] + [""]
    ids = [None] * 60 + [7] * 60 + [6, 8] * 10 + list(range(-20, 40))
    return [(i, rng.choice(texts)) for i in ids] + [(None, texts[0])] * 30 + [(7, texts[1])] * 30


def test_null_and_shared_ids_are_spread(spark, monkeypatch):
    rows = shared_ids()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(W, "ROWS", 4)
    assert found(df) == by(expected(rows))
    placed = W._bucketed(df.distinct().withColumn("tie", F.xxhash64("text")), "doc_id", "tie")
    buckets = placed.groupBy("_bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("i")).collect()
    assert max(r.n for r in buckets) <= 24 and sum(r.i is None for r in buckets) >= 8 and sum(r.i == 7 for r in buckets) >= 6


def test_equal_texts_have_equal_fingerprints(hard):
    rows = W.edited_fingerprints(hard.where("doc_id < 100")).join(hard.select("doc_id", "text").distinct(), "doc_id").where("text IS NOT NULL")
    single = {r.doc_id: (r.text, r.fingerprint) for r in rows.collect() if r.doc_id != 4}
    marks = {}
    for text, f in single.values():
        marks.setdefault(text, set()).add(f)
    assert all(len(f) == 1 for f in marks.values()) and len(marks) > 8
