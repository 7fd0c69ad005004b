"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

Test items are short and documents long, so the Jaccard likeness of the two is
tiny and plain MinHash misses them.  Items are therefore partitioned by their
number of shingles into classes [2^i, 2^(i+1)); for each class the shingles of a
document are cut into overlapping stretches of at most 2 * 2^(i+1), so that an
item and the stretch that holds it have comparable sizes: at a containment of
0.8 their Jaccard likeness is 0.19 or more.  A stretch is a candidate for an item
if any of ``hashes`` minimum values agrees (one row per band), which a
true match misses with probability (1 - 0.19) ** 64, about 1e-6.  Each candidate
is verified once by exact containment of the item's shingle set in the document's.

One scan of the documents, no shuffle.  Items are a stated query set: they
are sent to the tasks in blocks of ``block`` items, one scan per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm import hashing as H
from tallycast.llm.common import unused

SCHEMA = "doc_id long, item_id long, item_shingles long, shared long, containment double"
WORDS, PERCENT, HASHES, BLOCK = 5, 80, 64, 50_000


def _values() -> tuple[np.ndarray, np.ndarray]:
    return H.ascii_breaks(), H.byte_values(fold_ascii=True)


class ItemIndex:
    """The items of one block: exact sets, and by size class the minimum values of each hash."""

    def __init__(self, item_ids: list, texts: pa.Array, n: int, hashes: int):
        self.n = n
        self.factors = (H.randoms(hashes, 17) >> H.U(32)).astype(np.uint32) | np.uint32(1)
        buf, off = H.column_bytes(texts)
        words, bounds = H.word_hashes(buf, off, *_values())
        grams = H.gram_hashes(words, n)
        self.ids, self.sets, self.tiny = [], [], {}
        classes: dict[int, list[int]] = {}
        for i, item in enumerate(item_ids):
            length = int(bounds[i + 1] - bounds[i])
            if not length:
                continue
            if length < n:  # fewer words than a shingle: the whole sequence, looked for as such
                g = H.gram_hashes(words[bounds[i]:bounds[i + 1]], length)
                self.tiny.setdefault(length, []).append((g[0], item))
                continue
            shingles = np.unique(grams[bounds[i]:bounds[i + 1] - n + 1])
            classes.setdefault(len(shingles).bit_length() - 1, []).append(len(self.ids))
            self.ids.append(item)
            self.sets.append(shingles)
        self.classes = {}
        for c, members in sorted(classes.items()):
            values = np.stack([self.minima(self.sets[m]) for m in members], axis=1)  # hashes x items
            order = np.argsort(values, axis=1, kind="stable")
            seen = np.zeros((hashes, 1 << 16), dtype=bool)
            for k in range(hashes):
                seen[k, values[k] & np.uint32(0xFFFF)] = True
            self.classes[c] = (np.take_along_axis(values, order, axis=1), np.array(members)[order], seen)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        return ((shingles >> H.U(32)).astype(np.uint32)[None, :] * self.factors[:, None]).min(axis=1)


def _starts(bounds: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The first index of each block of ``step`` within rows, and the rows' block bounds."""
    sizes = np.diff(bounds)
    blocks = -(-sizes // step)
    ends = np.concatenate([[0], np.cumsum(blocks)])
    row = np.repeat(np.arange(len(sizes)), blocks)
    return bounds[:-1][row] + (np.arange(ends[-1]) - ends[:-1][row]) * step, ends


def _candidates(index: ItemIndex, shingles: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
    """(row, item) pairs of which a minimum value agrees in the item's size class."""
    found: set[tuple[int, int]] = set()
    if not len(shingles) or not index.classes:
        return found
    small = (shingles >> H.U(32)).astype(np.uint32)
    classes = list(index.classes)
    lowest, ends0 = _starts(bounds, 2 << classes[0])
    for k, factor in enumerate(index.factors):
        low, ends, step = np.minimum.reduceat(small * factor, lowest), ends0, 2 << classes[0]
        for c in classes:
            if (2 << c) != step:
                at, higher = _starts(ends, (2 << c) // step)
                low, ends, step = np.minimum.reduceat(low, at), higher, 2 << c
            stretch = low.copy()
            np.minimum(stretch[:-1], low[1:], out=stretch[:-1])
            last = ends[1:][np.diff(ends) > 0] - 1  # a row's last block has no next one
            stretch[last] = low[last]
            values, members, seen = index.classes[c]
            for b in np.flatnonzero(seen[k][stretch & np.uint32(0xFFFF)]):
                lo, hi = np.searchsorted(values[k], stretch[b], "left"), np.searchsorted(values[k], stretch[b], "right")
                if hi > lo:
                    row = int(np.searchsorted(ends, b, side="right")) - 1
                    found.update((row, int(m)) for m in members[k, lo:hi])
    return found


def matches(index: ItemIndex, texts: pa.Array, percent: int) -> Iterator[tuple[int, object, int, int]]:
    """(row, item id, item's shingles, shared) of the texts of one column that hold an item."""
    n = index.n
    buf, off = H.column_bytes(texts)
    for lo, hi in H.slices(off):
        words, bounds = H.word_hashes(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], *_values())
        grams = H.gram_hashes(words, n)
        sizes = np.maximum(np.diff(bounds) - n + 1, 0)
        inner = np.concatenate([[0], np.cumsum(sizes)])
        row = np.repeat(np.arange(hi - lo), sizes)
        shingles = grams[bounds[:-1][row] + np.arange(inner[-1]) - inner[:-1][row]] if len(grams) else grams
        held: dict[int, np.ndarray] = {}
        for r, m in sorted(_candidates(index, shingles, inner)):
            if r not in held:
                held = {r: np.unique(shingles[inner[r]:inner[r + 1]])}
            wanted = index.sets[m]
            shared = int(np.isin(wanted, held[r], assume_unique=True).sum())
            if 100 * shared >= percent * len(wanted):
                yield lo + r, index.ids[m], len(wanted), shared
        for length, items in index.tiny.items():
            g = H.gram_hashes(words, length)
            for h, item in items:
                at = np.flatnonzero(g == h)
                r = np.searchsorted(bounds, at, side="right") - 1
                for x in np.unique(r[at + length <= bounds[r + 1]]):
                    yield lo + int(x), item, 1, 1


def contained_items(docs: DataFrame, benchmark: DataFrame, n: int = WORDS, percent: int = PERCENT,
                    hashes: int = HASHES, block: int = BLOCK) -> DataFrame:
    """A row for each document and item of which ``percent`` of the item's n-word shingles stand in the document.

    Words are runs of letters and digits, A-Z lower-cased.  Items of fewer than
    n words match where their whole word sequence occurs; items without words
    and null or empty texts match nothing.  Repeated documents and items give a
    row each; null ids stay null; extra columns are not read; an empty table on
    either side gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-items.count() // block))
    out = spark.createDataFrame([], SCHEMA)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow()
        shared = spark.sparkContext.broadcast((part.column(0).to_pylist(), part.column(1).to_pylist()))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, item_texts = shared.value
            index = ItemIndex(ids, pa.array(item_texts, pa.string()), n, hashes)
            for batch in batches:
                rows = list(matches(index, batch.column(1), percent))
                if rows:
                    at, item, size, shared_n = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at, pa.int64())), pa.array(item, pa.int64()), pa.array(size, pa.int64()),
                         pa.array(shared_n, pa.int64()), pa.array([s / z for s, z in zip(shared_n, size, strict=True)], pa.float64())],
                        names=["doc_id", "item_id", "item_shingles", "shared", "containment"])

        found = texts.mapInArrow(search, SCHEMA)
        out = found if b == 0 else out.unionByName(found)
    return out


def rows_without_items(docs: DataFrame, benchmark: DataFrame, n: int = WORDS, percent: int = PERCENT,
                       hashes: int = HASHES, block: int = BLOCK) -> DataFrame:
    """The rows whose own text holds no item, all columns, judged where they are read: ids, also null or repeated, play no part."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-items.count() // block))
    name = unused(docs, "text to search")
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("text").cast("string").alias(name))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow()
        shared = docs.sparkSession.sparkContext.broadcast((part.column(0).to_pylist(), part.column(1).to_pylist()))

        def kept(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, item_texts = shared.value
            index = ItemIndex(ids, pa.array(item_texts, pa.string()), n, hashes)
            for batch in batches:
                clean = np.ones(len(batch), dtype=bool)
                clean[[row for row, *_ in matches(index, batch.column(batch.num_columns - 1), percent)]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(kept, out.schema)
    return out.drop(name)
