"""Exact centroid clustering of integer vectors by zone maps over a space-filling curve.

1. Vectors are put in the order of a Hilbert curve through the eight components of
   largest variance (over all rows) and cut into blocks.  A block is one stored row
   with its vectors and its zone map, the least and largest value per component.
2. Each round holds every block's box against all centroids.  A centroid whose least
   distance to the box exceeds another's largest distance is nearest to no vector of
   the block; the rest are the block's candidates.
3. The block's vectors are compared with the candidates exactly, in integers.  What
   leaves a task is one count and one sum per cluster and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import stored
from tallycast.llm.vectors import integers, matrix, packed, pieces, plain, unpacked

BLOCK = 128
#: Components and bits of each that the curve runs through: a key of 56 bits.
CURVE_DIMS, CURVE_BITS = 8, 7
#: Integers are held to this on either side; a sum of 64 squared differences then fits a long.
LIMIT = 1 << 26
#: Up to this size products of integers are exact in doubles.
EXACT = 1 << 20


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (n x d integers below 2**bits, d * bits < 64) on the Hilbert curve."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(len(x)):
            upper = (x[i] & bit) > 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        bit >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn, bit = np.zeros_like(x[0]), 1 << (bits - 1)
    while bit > 1:
        turn = np.where(x[-1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | (((v ^ turn) >> b) & 1)
    return key


def squared_distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The exact squared distance of every row to every centre, as 64-bit integers."""
    if max(np.abs(rows).max(initial=0), np.abs(centres).max(initial=0)) <= EXACT:
        a, b = rows.astype(np.float64), centres.astype(np.float64)
        return (np.einsum("ij,ij->i", a, a)[:, None] - 2 * (a @ b.T) + np.einsum("ij,ij->i", b, b)[None, :]).astype(np.int64)
    out = np.zeros((len(rows), len(centres)), dtype=np.int64)
    for i, c in enumerate(centres.astype(np.int64)):
        gap = rows - c
        out[:, i] = np.einsum("ij,ij->i", gap, gap)
    return out


def candidates(low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per box (row of ``low`` and ``high``) which centres may be nearest to a vector inside it."""
    c = centres.astype(np.int64)
    out = np.zeros((len(low), len(c)), dtype=bool)
    for i, (lo, hi) in enumerate(zip(low.astype(np.int64), high.astype(np.int64), strict=True)):
        under, over = lo - c, c - hi
        gap, far = np.maximum(np.maximum(under, over), 0), np.maximum(np.abs(under), np.abs(over))
        out[i] = np.einsum("ij,ij->i", gap, gap) <= np.einsum("ij,ij->i", far, far).min()
    return out


def _curve(rows: DataFrame, scale: int, dims: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The components that the curve runs through, their means and spreads, over all rows."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dims), np.zeros(dims)
        for batch in batches:
            x = integers(matrix(batch.column(0), dims), scale, LIMIT).astype(np.float64)
            n, first, second = n + len(x), first + x.sum(0), second + (x * x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array(first), pa.array(second)], names=["pos", "n", "first", "second"])

    sums = rows.select("embedding").mapInArrow(moments, "pos long, n long, first double, second double")
    sums = sums.groupBy("pos").agg(F.sum("n").alias("n"), F.sum("first").alias("first"), F.sum("second").alias("second")).orderBy("pos").toArrow()
    n, first, second = (sums.column(c).to_numpy() for c in ("n", "first", "second"))
    if not len(n) or not n[0]:
        return [], first, second
    mean = first / n
    spread = np.sqrt(np.maximum(second / n - mean * mean, 0))
    chosen = np.argsort(-spread, kind="stable")[:CURVE_DIMS]
    return chosen.tolist(), mean[chosen], spread[chosen]


def blocks(rows: DataFrame, scale: int, dims: int) -> DataFrame | None:
    """Stored (n, ids, ints, low, high) per block of the curve; None where no row is kept."""
    chosen, mean, spread = _curve(rows, scale, dims)
    if not chosen:
        return None

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = integers(matrix(batch.column(1), dims), scale, LIMIT)
            cells = (ints[:, chosen] - mean) / (np.maximum(spread, 1e-9) * 6 / (1 << CURVE_BITS)) + (1 << (CURVE_BITS - 1))
            keys = hilbert_keys(np.clip(cells, 0, (1 << CURVE_BITS) - 1).astype(np.int64), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0), packed(ints)], names=["key", "vec_id", "ints"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, BLOCK):
            ints = unpacked(piece.column(2), np.int32, dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(piece)], pa.int64()), pa.array([piece.column(1).to_pylist()], pa.list_(pa.int64())),
                 pa.array([ints.tobytes()]), pa.array([ints.min(0).tobytes()]), pa.array([ints.max(0).tobytes()])],
                names=["n", "ids", "ints", "low", "high"])

    keys = rows.select("vec_id", "embedding").mapInArrow(keyed, "key long, vec_id long, ints binary")
    # the id's hash spreads rows that share a place on the curve, so that no range holds a large group of equal vectors
    ordered = keys.repartitionByRange("key", F.xxhash64("vec_id", "ints")).sortWithinPartitions("key")
    return stored(ordered.mapInArrow(cut, "n long, ids array<long>, ints binary, low binary, high binary"), "blocks")


def _nearest(batches: Iterator[pa.RecordBatch], centres: np.ndarray, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block its ids, integers, nearest centres (ties: smaller number) and squared distances."""
    for batch in batches:
        may = candidates(unpacked(batch.column("low"), np.int32, dims), unpacked(batch.column("high"), np.int32, dims), centres)
        for i, use in enumerate(may):
            ints = np.frombuffer(batch.column("ints")[i].as_py(), dtype=np.int32).reshape(-1, dims)
            number = np.flatnonzero(use)
            d = squared_distances(ints, centres[number])
            best = d.argmin(1)
            yield batch.column("ids")[i].values, ints, number[best], d[np.arange(len(d)), best]


def _moved(table: DataFrame, centres: np.ndarray, dims: int) -> np.ndarray:
    """The centres after a round: the floor of the mean of their vectors, or as they were where they have none."""
    k = len(centres)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), dtype=np.int64)
        for _, ints, near, _ in _nearest(batches, centres, dims):
            member = np.zeros((k, len(ints)), dtype=np.float64)
            member[near, np.arange(len(ints))] = 1  # sums of a block stay far below 2**53
            total[:, :dims] += (member @ ints).astype(np.int64)
            total[:, dims] += np.bincount(near, minlength=k)
        cluster, pos = np.divmod(np.arange(total.size), dims + 1)
        held = np.flatnonzero(total[:, dims][cluster])
        yield pa.RecordBatch.from_arrays([pa.array(cluster[held]), pa.array(pos[held]), pa.array(total.ravel()[held])], names=["cluster", "pos", "total"])

    parts = table.select("ids", "ints", "low", "high").mapInArrow(sums, "cluster long, pos long, total long")
    after = [[int(x) for x in c] for c in centres]
    totals: dict[int, dict[int, int]] = {}
    for cluster, pos, total in parts.groupBy("cluster", "pos").agg(F.sum(F.col("total").cast("decimal(20,0)"))).collect():  # k * (dims + 1) rows
        totals.setdefault(cluster, {})[pos] = int(total)
    for cluster, of in totals.items():
        after[cluster] = [of[pos] // of[dims] for pos in range(dims)]
    return np.array(after, dtype=np.int64)


def clusters(vectors: DataFrame, *, k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64, seed: str = "2:") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept row of ``vectors``.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; each
    component becomes floor(scale * x), held to +-2**26.  The first centroids are the
    ``k`` kept rows of smallest SHA-256 of ``seed`` and vec_id (ties and null ids, which
    come last: smaller components first), or all rows where there are fewer.  Each
    round assigns all vectors to the nearest centroid (ties: smaller number) and
    replaces every non-empty centroid by the floor of its vectors' mean.  Rows that
    repeat an id, or have none, are vectors of their own.  Extra columns are not
    read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = plain(vectors).where(F.size("embedding") == dims)
    table = blocks(rows, scale, dims)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if table is None:
        return spark.createDataFrame([], schema)
    mark = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = rows.select(mark.alias("mark"), "embedding").orderBy(F.col("mark").asc_nulls_last(), "embedding").limit(k).collect()
    centres = integers(np.array([r.embedding for r in first]), scale, LIMIT).astype(np.int64)
    for _ in range(rounds):
        centres = _moved(table, centres, dims)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, near, distance in _nearest(batches, centres, dims):
            yield pa.RecordBatch.from_arrays([ids, pa.array(near.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = stored(table.select("ids", "ints", "low", "high").mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    total = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()}  # k rows
    facts = [(c, t, sum(total.values()), hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()) for c, t in total.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
