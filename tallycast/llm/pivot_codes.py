"""Product codes of vectors, trained and assigned exactly with pivot tables (LAESA).

Vectors are integers, cut into equal parts, and each part position has a codebook.
Every part's distances to a few fixed pivots are computed once and stored with it.
In each round the entries' distances to the same pivots are computed on the driver
(256 by 16 a position).  By the triangle inequality the largest difference of the two,
over the pivots, is a lower bound of the distance of part and entry: entries of the
least bounds are evaluated first, and of the others only those whose bound does not
exceed the best distance found.  Evaluations are exact, in integers.  What leaves a
task in a round is one count and one sum per entry and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import small_side, stored
from tallycast.llm.vectors import integers, matrix, packed, pieces, plain, unpacked

PIVOTS = 16
#: Entries of least bound that are evaluated before any is put aside.
FIRST = 8
#: Rows that are held against a codebook together.
ROWS = 2048
#: Integers are held to this on either side: a squared distance of a part of up to
#: 16 components, followed by the entry's number, then fits a long.
LIMIT = 1 << 24
#: Up to this size doubles hold a part's squared distance exactly, and are faster.
EXACT = 1 << 20


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The distance of every row to every pivot."""
    out = np.empty((len(rows), len(pivots)), dtype=np.float32)
    for i, p in enumerate(pivots.astype(np.float64)):
        gap = rows - p
        out[:, i] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` distinct entries, each the farthest from those before it (ties: smaller number)."""
    chosen, near = [0], np.full(len(entries), np.inf)
    while len(chosen) < n:
        gap = (entries - entries[chosen[-1]]).astype(np.float64)
        near = np.minimum(near, np.einsum("ij,ij->i", gap, gap))
        if not near.max() > 0:
            break
        chosen.append(int(near.argmax()))
    return entries[chosen]


def nearest_entries(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each part's nearest entry (ties: smaller number), its squared distance, and the number of exact evaluations."""
    m, k = len(parts), len(entries)
    bound = np.zeros((m, k), dtype=np.float32)
    for j in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, j, None] - entry_pivots[None, :, j]), out=bound)
    # distances are rounded to 24 bits, so a bound may be this much too large
    bound -= 4e-7 * (to_pivots.max(1, initial=0)[:, None] + entry_pivots.max(1, initial=0)[None, :])
    # Distances of a part fit 55 bits; sorting by distance and number together settles ties.
    number = max(k - 1, 1).bit_length()
    small = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)) <= EXACT
    exact, among = (x.astype(np.float64 if small else np.int64) for x in (parts, entries))

    def evaluate(r: np.ndarray, e: np.ndarray) -> np.ndarray:
        gap = exact[r] - among[e]
        return (np.einsum("ij,ij->i", gap, gap).astype(np.int64) << number) | e

    first = min(FIRST, k)
    order = np.argpartition(bound, first - 1, axis=1)[:, :first]
    rows = np.arange(m)
    best = evaluate(np.repeat(rows, first), order.ravel()).reshape(m, first).min(1)
    np.put_along_axis(bound, order, np.inf, axis=1)
    limit = np.sqrt((best >> number).astype(np.float64)).astype(np.float32)
    r, e = np.nonzero(bound <= np.nextafter(limit, np.float32(np.inf))[:, None])
    done = m * first + len(r)
    if len(r):
        found = evaluate(r, e)
        starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        best[r[starts]] = np.minimum(best[r[starts]], np.minimum.reduceat(found, starts))
    return best & ((1 << number) - 1), best >> number, done


class Codebooks:
    """The integer entries of each part position, its fixed pivots, and the entries' distances to them."""

    def __init__(self, entries: np.ndarray, pivots: list[np.ndarray]):
        self.entries, self.pivots = entries, pivots  # parts x k x width; per part
        self.tables = [pivot_distances(e, p) for e, p in zip(entries, pivots, strict=True)]

    def assign(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, integers, codes, error) of pieces of a batch with the columns ``ints`` and ``pivots``."""
        parts, k, width = self.entries.shape
        for piece in pieces([batch], ROWS):
            ints = unpacked(piece.column("ints"), np.int32, parts * width)
            far = unpacked(piece.column("pivots"), np.float32, sum(map(len, self.pivots)))
            codes, error, at = np.zeros((len(ints), parts), dtype=np.int64), np.zeros(len(ints), dtype=np.int64), 0
            for p in range(parts):
                n = len(self.pivots[p])
                codes[:, p], d, _ = nearest_entries(ints[:, p * width:(p + 1) * width], far[:, at:at + n], self.entries[p], self.tables[p])
                error, at = error + d, at + n
            yield piece, ints, codes, error


def _dims(rows: DataFrame, parts: int) -> int:
    """The commonest number of components that ``parts`` divides (ties: larger); 0 where there is none."""
    sizes = rows.select(F.size("embedding").alias("n")).where((F.col("n") > 0) & (F.col("n") % parts == 0))
    top = sizes.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return top.n if top else 0


def _moved(table: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: every entry is the floor of its parts' mean, or as it was where it has none."""
    parts, k, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * k, width + 1), dtype=np.int64)
        for batch in batches:
            for _, ints, codes, _ in books.assign(batch):
                place = codes + np.arange(parts) * k
                np.add.at(total[:, :width], place.ravel(), ints.reshape(-1, width))
                total[:, width] += np.bincount(place.ravel(), minlength=parts * k)
        held = np.flatnonzero(total[:, width])
        yield pa.RecordBatch.from_arrays([pa.array(held), *(pa.array(c) for c in total[held].T)], names=["entry", *(f"s{i}" for i in range(width + 1))])

    names = [f"s{i}" for i in range(width + 1)]
    out = table.select("ints", "pivots").mapInArrow(sums, ", ".join(f"{c} long" for c in ["entry", *names]))
    after = books.entries.reshape(-1, width).copy()
    for row in out.groupBy("entry").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in names]).collect():  # parts * k rows
        after[row.entry] = [int(row[c]) // int(row[names[-1]]) for c in names[:-1]]
    return Codebooks(after.reshape(parts, k, width), books.pivots)


def codes(vectors: DataFrame, *, parts: int = 4, k: int = 256, rounds: int = 4, scale: int = 1024, n_pivots: int = PIVOTS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept row of ``vectors``.

    Kept are vectors without null or non-finite components, of the commonest
    length that ``parts`` divides (ties: the larger; others share no part with them);
    each component becomes floor(scale * x), held to +-2**24.  The codebooks start
    as the parts of the ``k`` kept rows of smallest vec_id (ties and null ids, which
    come last: smaller components first), or of all rows where there are fewer.  Each
    round assigns every part to its codebook's nearest entry (ties: smaller number)
    and replaces each entry by the floor of its parts' mean; unused entries stay.
    ``code`` has two hex digits a part; ``label_error`` sums ``error`` over
    equal labels, nulls together.  Rows that repeat an id, or have none, are vectors of
    their own.  Extra columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = plain(vectors, "label")
    dims = _dims(rows, parts)
    if not dims:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if dims // parts > 16:
        raise ValueError(f"parts of {dims // parts} components: squared distances are exact for up to 16")
    rows, width = rows.where(F.size("embedding") == dims), dims // parts
    first = rows.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(k).collect()
    entries = integers(np.array([r.embedding for r in first]), scale, LIMIT).astype(np.int64)
    entries = np.ascontiguousarray(entries.reshape(-1, parts, width).transpose(1, 0, 2))
    books = Codebooks(entries, [choose_pivots(e, n_pivots) for e in entries])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = integers(matrix(batch.column("embedding"), dims), scale, LIMIT)
            far = [pivot_distances(ints[:, p * width:(p + 1) * width], pivots) for p, pivots in enumerate(books.pivots)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), packed(ints), packed(np.hstack(far))],
                                             names=["vec_id", "label", "ints", "pivots"])

    label = vectors.schema["label"].dataType.simpleString()
    table = stored(rows.mapInArrow(described, f"vec_id long, label {label}, ints binary, pivots binary"), "parts")
    for _ in range(rounds):
        books = _moved(table, books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, _, chosen, error in books.assign(batch):
                text = ["".join(f"{c:02x}" for c in row) for row in chosen.tolist()]
                yield pa.RecordBatch.from_arrays([piece.column("vec_id"), piece.column("label"), pa.array(text), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])

    assigned = stored(table.mapInArrow(assign, f"vec_id long, label {label}, code string, error long"), "assigned")
    sums = assigned.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(20,0)")).cast("long").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.entries.ravel().tolist())).encode()).hexdigest()
    both = assigned.join(small_side(stored(sums, "labels")), F.expr("label <=> of"))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
