import random
import re

import pyarrow as pa

from tallycast.llm import decontaminate as D
from tests.llm.conftest import prose


def grams(text, n=5):
    words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if 0 < len(words) < n:
        return words, {tuple(words)}
    return words, {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def brute(docs, items, percent=80):
    out = []
    for doc_id, text in docs:
        words, held = grams(text)
        for item_id, item in items:
            wanted, shingles = grams(item)
            if 0 < len(wanted) < 5:
                found = any(words[i:i + len(wanted)] == wanted for i in range(len(words)))
                shared = int(found)
            else:
                shared = len(shingles & held)
            if shingles and 100 * shared >= percent * len(shingles):
                out.append((doc_id, item_id, len(shingles), shared))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in df.collect()), key=str)


def planted(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice((1, 3, 5, 6, 9, 20, 33, 64, 150, 400)))) for i in range(60)]
    docs = []
    for i in range(80):
        text = prose(rng, rng.choice((0, 4, 50, 400, 5_000))).split()
        for _ in range(rng.choice((0, 0, 1, 2))):
            words = rng.choice(items)[1].upper().split()
            if len(words) > 20 and rng.random() < 0.5:
                words[rng.randrange(len(words))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = words
        docs.append((i, ", ".join(text)))
    return docs, items


def test_recall_against_brute_force(spark):
    docs, items = planted(3)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 20
    assert rows_of(D.contained_items(d, b)) == want
    assert rows_of(D.contained_items(d, b, block=7)) == want  # items in blocks


def test_hard_rows(spark, hard, none):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    texts = dict((i, t) for i, t in rows if t)
    items = [(1, texts[1]), (1, texts[1]), (None, texts[13]), (3, None), (4, ""), (5, " ;: "), (6, "a"), (7, "é"), (8, "1234 5678"), (9, texts[5][:3000])]
    b = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, doc_id string")
    assert rows_of(D.contained_items(hard, b)) == brute(rows, items)
    assert D.contained_items(none, b).collect() == [] and D.contained_items(hard, b.limit(0)).collect() == []
    whole = [tuple(r) for r in hard.withColumnRenamed("base", "text to search").collect()]
    kept = D.rows_without_items(hard.withColumnRenamed("base", "text to search"), b)
    leaks = {k for k, *_ in brute([(k, t) for k, (_, t) in enumerate(rows)], items)}
    assert kept.columns == hard.withColumnRenamed("base", "text to search").columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(str(r) for k, r in enumerate(whole) if k not in leaks)
    assert D.rows_without_items(none, b).collect() == []


def test_minima_of_stretches():
    """A stretch's minimum values are those of the shingles in it, for each class."""
    import numpy as np
    index = D.ItemIndex([0], pa.array(["a b c d e f g h i j k l m n"]), 5, 4)
    shingles = D.H.randoms(100, 5)
    bounds = np.array([0, 37, 37, 100])
    starts, ends = D._starts(bounds, 16)
    assert starts.tolist() == [0, 16, 32, 37, 53, 69, 85] and ends.tolist() == [0, 3, 3, 7]
    assert index.minima(shingles).tolist() == [((shingles >> D.H.U(32)).astype(np.uint32) * f).min() for f in index.factors]
