"""Document fingerprints by winnowing, in DataFrame expressions only.

A text's UTF-8 bytes give a hash for each run of ``k`` bytes; of each window of
``w`` successive hashes the smallest is kept, the rightmost of equal ones.  Two
texts that share a run of w + k - 1 bytes therefore share a mark, and marks of
runs shorter than k never agree but by chance.  A mark is one long, its hash
above and its position counted from the end of the range below, so that the
smallest mark of a window is the rightmost of the smallest hashes.

The window minimum takes log2(w) element-wise minima of the array with itself
shifted, so the work per byte does not grow with w.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.common import as_often, stored

K, W = 16, 16
_LOW = 4294967295  # 2**32 - 1


def marks(df: DataFrame, text: str, name: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with the array ``name`` of the winnowed marks of column ``text`` (a string, null: empty).

    Texts of fewer than k bytes have one mark, of the whole text; an empty text
    has none; texts of fewer than w hashes are one window.  ``w`` is a power
    of two.
    """
    if w & (w - 1):
        raise ValueError("w must be a power of two")
    # within a lambda the bytes are fetched once, not once for each position
    gram = lambda b, i: F.xxhash64(F.substring(b, i, F.lit(k))).bitwiseOR(F.lit(_LOW)) - i
    text_bytes = F.coalesce(F.col(text), F.lit("")).cast("binary")
    hashes = lambda b: F.when(F.octet_length(b) >= k, F.transform(F.sequence(F.lit(1), F.octet_length(b) - (k - 1)), lambda i: gram(b, i))).when(
        F.octet_length(b) > 0, F.array(F.xxhash64(b).bitwiseOR(F.lit(_LOW)) - 1)).otherwise(F.array().cast("array<long>"))
    df = df.withColumn(name, F.get(F.transform(F.array(text_bytes), hashes), F.lit(0)))
    size = f"_n_{name}"
    df = df.withColumn(size, F.size(name))
    shift = 1
    while shift < w:
        df = df.withColumn(name, F.zip_with(name, F.slice(name, shift + 1, F.greatest(F.col(size), F.lit(1))), lambda a, b: F.least(a, b)))
        shift *= 2
    # zip_with fills the end with nulls, which least() skips: what stands past the last whole window is cut off
    return df.withColumn(name, F.array_distinct(F.slice(name, F.lit(1), F.greatest(F.col(size) - (w - 1), F.lit(1))))).drop(size)


def mark_hashes(name: str) -> Column:
    """The distinct hashes (int) of marks."""
    return F.array_distinct(F.transform(name, lambda m: F.shiftright(m, 32).cast("int")))


def mark_positions(name: str) -> Column:
    """The byte positions of marks, from 0."""
    return F.transform(name, lambda m: (F.lit(_LOW - 1) - m.bitwiseAND(F.lit(_LOW))).cast("int"))


def spelled(name: str) -> Column:
    """A digest of marks with their positions: number, then two hashes of the whole array."""
    return F.concat_ws("-", F.size(name).cast("string"), F.lower(F.hex(F.xxhash64(name))), F.lower(F.hex(F.hash(name))))


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two arrays of distinct hashes; two empty ones are alike, an empty and another are not."""
    shared = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


# ---------------------------------------------------------------- the next document

#: Rows of a bucket, and the number of buckets at which they grow instead; both bound what is broadcast.
ROWS, BUCKETS, FAN = 128, 1 << 16, 256


def _bits(parts: int) -> int:
    return (max(1, min(BUCKETS, parts)) - 1).bit_length()


def _bounds(docs: DataFrame, order: str) -> tuple[list[int], list[int], int]:
    """At most ``BUCKETS`` ascending values that part the rows by quantiles of ``order``.

    With them the bits of ``tie`` by which the rows of each of these values are
    parted in turn (0 but for values that hold several quantiles), and those for a null ``order``.
    """
    n, rows = docs.select(F.count(order), F.count("*")).first()
    parts, null_bits = min(BUCKETS, n // ROWS), _bits((rows - n) // ROWS)
    if parts < 2:
        return [], [], null_bits
    shares = F.expr(f"cast(split('{','.join(str(i / parts) for i in range(1, parts))}', ',') AS array<double>)")
    held = Counter(docs.select(F.percentile_approx(order, shares, max(10_000, 4 * parts))).first()[0])
    bounds = sorted(held)
    return bounds, [_bits(held[x]) for x in bounds], null_bits


def _longs(values: list[int]) -> Column:
    return F.expr(f"cast(split('{','.join(map(str, values))}', ',') AS array<bigint>)") if values else F.array().cast("array<long>")


def _bucket(order: str, bounds: list[int]) -> Column:
    """How many bounds are at or below ``order`` (-1 for null), by a search in two steps."""
    at_or_below = lambda values: F.size(F.filter(values, lambda v: v <= F.col(order)))
    coarse = at_or_below(_longs(bounds[::FAN]))
    fine = lambda c: F.greatest(c - 1, F.lit(0)) * FAN + at_or_below(F.slice(_longs(bounds), F.greatest(c - 1, F.lit(0)) * FAN + 1, FAN))
    return F.when(F.col(order).isNull(), -1).otherwise(F.get(F.transform(F.array(coarse), fine), F.lit(0)))


def _bucketed(rows: DataFrame, order: str, tie: str) -> DataFrame:
    """``rows`` with the long ``_bucket``, ascending with descending ``order`` (null last) and ascending ``tie``."""
    bounds, bits, null_bits = _bounds(rows, order)
    rows = rows.withColumn("_bucket", _bucket(order, bounds))
    number = (F.lit(len(bounds)) - F.col("_bucket")).cast("long") * (2 * BUCKETS)
    if not null_bits and not any(bits):
        return rows.withColumn("_bucket", number)
    at = F.col("_bucket") - 1
    alone = F.col(order) == F.get(_longs(bounds), at)  # rows of the bucket's least value come after its others
    rows = rows.withColumn("_bits", F.when(F.col(order).isNull(), null_bits).when(alone, F.get(_longs(bits), at)).otherwise(0).cast("int"))
    rows = rows.withColumn("_top", F.col(tie).bitwiseXOR(F.lit(-(1 << 63))))
    piece = F.when(F.col("_bits") > 0, F.expr("shiftrightunsigned(_top, 64 - _bits) + 1")).otherwise(0)
    return rows.withColumn("_bucket", number + piece).drop("_bits", "_top")


def with_next(docs: DataFrame, order: str, tie: str, carried: list[str]) -> DataFrame:
    """Each row with ``next_<c>`` of the row after it by descending ``order`` (after the last: the first), for c in ``carried``.

    Rows fall into buckets by quantiles of ``order`` and move once, into a
    window over their bucket.  Rows of a value that holds several quantiles,
    and those with a null ``order``, which come last, have buckets by ranges of
    ``tie``, a 64-bit hash that orders rows of one value.  A bucket's first row
    is copied to the end of the bucket before it, so no window needs a row of another.
    """
    rows = _bucketed(docs, order, tie)
    chain = Window.orderBy("_bucket")  # over some 2 * BUCKETS rows
    whole = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = rows.groupBy("_bucket").agg(F.max(F.struct(F.col(order).alias("order"), F.bitwise_not(tie).alias("tie"))).alias("_first"))
    firsts = firsts.withColumn("_before", F.coalesce(F.lag("_bucket").over(chain), F.last("_bucket").over(whole)))
    firsts = firsts.select(F.col("_bucket").alias("_b"), "_first", "_before")
    first = F.col(order).eqNullSafe(F.col("_first.order")) & (F.bitwise_not(tie) == F.col("_first.tie"))
    rows = rows.join(F.broadcast(firsts), (F.col("_bucket") == F.col("_b")) & first, "left")
    place = lambda bucket, copy: F.struct(F.col(bucket).alias("bucket"), F.lit(copy).alias("copy"))
    here = F.array(place("_bucket", False))
    rows = rows.withColumn("_place", F.explode(F.when(F.col("_before").isNull(), here).otherwise(F.array(place("_bucket", False), place("_before", True)))))
    rows = rows.select(*docs.columns, F.col("_place.bucket").alias("_bucket"), F.col("_place.copy").alias("_copy"))
    own = Window.partitionBy("_bucket").orderBy("_copy", F.desc_nulls_last(order), tie)
    for c in carried:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(own))
    return rows.where("NOT _copy").drop("_bucket", "_copy")


def edited_fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text: the last floor(n_chars / 3) code points replaced by the first
    as many (or all) of the next document by descending doc_id (after the last:
    the first; a single document is its own next).  Rows that repeat a doc_id
    are ordered by their text's hash; rows with a null doc_id come last; null
    texts are empty; extra columns are not read; an empty table gives no rows.
    Where rows repeat doc_id and text, one of them moves with their number: all but
    the last have their own text as the next.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("tie", F.xxhash64("text"))
    copies = []
    if not rows.groupBy("doc_id", "tie").count().where("count > 1").isEmpty():
        copies = ["copies"]
        rows = stored(rows.groupBy("doc_id", "text", "n_chars", "tie").agg(F.count("*").alias("copies")), "texts")
    rows = marks(rows, "text", "marks", k, w)
    rows = rows.select("doc_id", "text", "n_chars", "tie", *copies, spelled("marks").alias("fingerprint"), mark_hashes("marks").alias("hashes"))
    rows = with_next(rows, "doc_id", "tie", ["text", "hashes"])
    if copies:
        after = lambda text, hashes, copies: F.struct(F.col(text).alias("text"), F.col(hashes).alias("hashes"), copies.alias("copies"))
        nexts = F.array(after("next_text", "next_hashes", F.lit(1).cast("long")), after("text", "hashes", F.col("copies") - 1))
        rows = rows.withColumn("after", F.explode(F.filter(nexts, lambda x: x["copies"] > 0)))
        rows = rows.withColumns({"next_text": F.col("after.text"), "next_hashes": F.col("after.hashes"), "copies": F.col("after.copies")})
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int"))
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), third)))
    rows = rows.select("doc_id", "n_chars", *copies, "fingerprint", "hashes", "edited", likeness("hashes", "next_hashes").alias("near_next"))
    rows = marks(rows, "edited", "marks", k, w)
    rows = rows.select("doc_id", "n_chars", *copies, F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", spelled("marks").alias("edited_fingerprint"),
                       "hashes", mark_hashes("marks").alias("edited_hashes"), "near_next")
    rows = rows.select("doc_id", "n_chars", *copies, "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness("hashes", "edited_hashes").alias("near_edited"), "near_next")
    return as_often(rows, "copies") if copies else rows
