"""Exact n-gram Jaccard self-join by rare-first prefix filtering, and the groups that its links form.

1. ``describe`` (one scan) hashes each text's distinct n-word shingles.  A table
   of ``2**SKETCH_BITS`` counters, summed over all documents, gives every shingle
   an upper bound of its frequency; ordering by that bound puts rare shingles
   first.  Any common order is exact; this one makes the lists short.
2. Equal shingle sets are one class.  A class posts only its prefix, the first
   n - ceil(t n) + 1 shingles; similar classes share one of them.
3. Lists of two classes or more are stored.  Pairs pass the length and positional
   filters in the join and the suffix filter (the bits in which two parity
   bitmaps differ bound the symmetric difference from below), and are verified
   once on the whole sets.
4. To stay linear inside large groups, a first round verifies one pair per class:
   the class and, of the lists' leaders, the one it shares most lists with.  The
   leader of a list is the class with most shared tokens (a text whose copies were
   edited has them all).  A second round compares what the first left in different
   components: per list, classes outside the largest component against all.
   No pair of different components is left out, so the components are those of
   all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm import hashing as H
from tallycast.llm.common import BROADCAST_IDS, filter_ids, passing, small_side, stored, unused
from tallycast.llm.components import connected_components

SKETCH_BITS = 18
MAPS = ("m0", "m1", "m2", "m3")
#: Longs of the wide bitmap, which candidate pairs are held against before whole sets move.
WIDE = 64
ROW_SCHEMA = "doc_id long, n_shingles long, cls long, m0 long, m1 long, m2 long, m3 long, prefix array<long>, wide array<long>"


def _sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf, off = H.column_bytes(texts)
    sep, value = H.white_space(), H.byte_values(fold_ascii=True)
    for lo, hi in H.slices(off):
        words, bounds = H.word_hashes(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], sep, value)
        grams = H.gram_hashes(words, n)
        for r in range(hi - lo):
            yield np.unique(H.row_grams(words, bounds, grams, r, n))


def _class(shingles: np.ndarray) -> int:
    """The hash of a whole set, as a signed 64-bit value."""
    h = np.sum(H.mix(shingles * H.U(0xA24BAED4963EE407)), dtype=H.U) + H.U(len(shingles))
    return int(H.mix(np.array([h], dtype=H.U)).view(np.int64)[0])


def _bitmap(shingles: np.ndarray, longs: int) -> np.ndarray:
    """For each of 64 * longs hash slots the parity of the set's shingles there."""
    slots = 64 * longs
    odd = (np.bincount(((shingles >> H.U(24)) & H.U(slots - 1)).astype(np.int64), minlength=slots) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def sketch(docs: DataFrame, n: int) -> np.ndarray:
    """The shingle counters of all documents; their number, and so what reaches the driver, is fixed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        sep, value = H.white_space(), H.byte_values(fold_ascii=True)
        for batch in batches:
            buf, off = H.column_bytes(batch.column(0))
            for lo, hi in H.slices(off):
                words, bounds = H.word_hashes(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], sep, value)
                grams = H.gram_hashes(words, n)
                use = np.zeros(len(grams) + 1, dtype=np.int64)
                full = np.diff(bounds) >= n
                np.add.at(use, bounds[:-1][full], 1)
                np.add.at(use, bounds[1:][full] - n + 1, -1)
                grams = grams[np.cumsum(use[:-1]) > 0]
                total += np.bincount((grams >> H.U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["slot", "n"])

    sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "slot long, n long")
    sums = sums.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    out[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
    return out


def describe(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """A stored row per document: shingles, class, bitmap, and the prefix where its task met the class first."""
    counts = docs.sparkSession.sparkContext.broadcast(sketch(docs, n))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, met = counts.value, set()
        for batch in H.by_bytes(batches, 1):
            sizes, classes, maps, prefixes, wide = [], [], [], [], []
            for s in _sets(batch.column(1), n):
                c, prefix, bits = _class(s), None, None
                if len(s) and c not in met:
                    met.add(c)
                    order = np.argsort(slots[(s >> H.U(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                    prefix = s[order[:len(s) - (len(s) * percent + 99) // 100 + 1]].view(np.int64)
                    bits = _bitmap(s, WIDE)
                sizes.append(len(s))
                classes.append(c)
                maps.append(_bitmap(s, len(MAPS)).tolist())
                prefixes.append(prefix)
                wide.append(bits)
            four = zip(*maps, strict=True) if maps else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, classes, *four)), *(pa.array(x, pa.list_(pa.int64())) for x in (prefixes, wide))],
                names=["doc_id", "n_shingles", "cls", *MAPS, "prefix", "wide"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = stored(ids.mapInArrow(rows, ROW_SCHEMA), "shingles")
    counts.destroy()
    return out


def shared_postings(rows: DataFrame) -> DataFrame:
    """The stored postings (token, cls, size, pos) of tokens that two classes or more have in their prefix."""
    posts = rows.select("cls", F.col("n_shingles").alias("size"), F.posexplode("prefix").alias("pos", "token"))
    many = posts.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("token")
    return stored(posts.join(many, "token").dropDuplicates(["token", "cls"]), "postings")


def _may_match(x: str, y: str, percent: int) -> Column:
    """Length and positional filters of the postings x and y of one token."""
    sizes = f"{x}.size + {y}.size"
    need = f"({percent} * ({sizes}) + {99 + percent}) div {100 + percent}"
    rest = f"1 + least({x}.size - {x}.pos - 1, {y}.size - {y}.pos - 1)"
    return F.expr(f"100 * least({x}.size, {y}.size) >= {percent} * greatest({x}.size, {y}.size) AND {rest} >= {need}")


def _near(x: str, y: str, percent: int) -> Column:
    """Suffix filter of the rows x and y: their bitmaps differ in no more bits than similar sets differ in shingles."""
    bits = " + ".join(f"bit_count({x}.{m} ^ {y}.{m})" for m in MAPS)
    return F.expr(f"{bits} <= {_slack(f'({x}.size + {y}.size)', percent)}")


def _slack(total: str, percent: int) -> str:
    """The most shingles that two similar sets of ``total`` together may not share."""
    return f"{total} - 2 * (({percent} * {total} + {99 + percent}) div {100 + percent})"


def _candidates(pairs: DataFrame, rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Stored (x, y, u, v): the pairs of classes that pass the suffix filter by both bitmaps, and their smallest ids."""
    a, b = classes.alias("a"), classes.alias("b")
    near = pairs.join(a, F.expr("x = a.cls")).join(b, F.expr("y = b.cls")).where(_near("a", "b", percent))
    near = stored(near.selectExpr("x", "y", "a.rep AS u", "b.rep AS v", "a.size + b.size AS total"), "candidates")
    wanted = stored(near.selectExpr("x AS cls").unionByName(near.selectExpr("y AS cls")).distinct(), "wanted")
    wide = rows.where("wide IS NOT NULL").select("cls", "wide")
    wide = stored(filter_ids(wide, wanted, "cls", keep=True).groupBy("cls").agg(F.first("wide").alias("wide")), "wide")
    both = near.join(wide.selectExpr("cls AS x", "wide AS s"), "x").join(wide.selectExpr("cls AS y", "wide AS t"), "y")
    bits = F.aggregate(F.zip_with("s", "t", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, n: total + n)
    return stored(both.where(bits <= F.expr(_slack("total", percent))).select("x", "y", "u", "v"), "candidates")


def verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Stored (x, y, u, v, linked): the pairs of classes that pass the suffix filter, whether they are similar, and their smallest ids."""
    kept = _candidates(pairs, rows, classes, percent)
    wanted = stored(kept.selectExpr("u AS id").unionByName(kept.selectExpr("v AS id")).distinct(), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.by_bytes(batches, 0):
            found = list(_sets(batch.column(0), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class(s) for s in found], pa.int64()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))],
                names=["cls", "shingles"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = filter_ids(ids, wanted, "doc_id", keep=True).select("text").mapInArrow(sets, "cls long, shingles array<long>")
    first, second = texts.selectExpr("cls AS x", "shingles AS s"), texts.selectExpr("cls AS y", "shingles AS t")
    both = kept.join(first, "x").join(second, "y")
    shared = F.size(F.array_intersect("s", "t"))
    linked = 100 * shared >= percent * (F.size("s") + F.size("t") - shared)
    return stored(both.select("x", "y", "u", "v", linked.alias("linked")), "verified")


def _same_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Stored (u, v, linked): ids that several classes have, each linked to the smallest id of these classes."""
    several = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi")
    ids = rows.where("n_shingles > 0").join(several.select("doc_id"), "doc_id").join(classes.select("cls", "rep"), "cls")
    return stored(ids.select(F.col("rep").alias("u"), F.col("doc_id").alias("v"), F.lit(True).alias("linked")), "ids")


def _labels(links: list[DataFrame]) -> DataFrame:
    edges = links[0].select("u", "v", "linked")
    for more in links[1:]:
        edges = edges.unionByName(more.select("u", "v", "linked"))
    return connected_components(edges.where("linked AND u <> v").select("u", "v"))


def similar_groups(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased.  The
    set of a text: its distinct n-word shingles; of fewer words, the whole
    sequence as one; of none (or null), empty and linked with nothing.  Two
    rows link when 100 * intersection >= percent * union; component_id is the
    smallest doc_id that links reach, the row's own included.  Rows that
    repeat a doc_id are one node.  Rows with a null doc_id belong to the
    component of an equal set, and have null where no row with an id has it.
    Extra columns are not read; an empty table gives no rows.
    """
    rows = describe(docs, n, percent)
    classes = rows.where("n_shingles > 0").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size"), *[F.max(m).alias(m) for m in MAPS])
    classes = stored(classes, "classes")
    posts = shared_postings(rows)
    shares = posts.groupBy("cls").agg(F.count("*").alias("shares"))
    active = shares.join(classes.where("rep IS NOT NULL"), "cls")  # the classes that post and have an id
    active = stored(active.select("cls", "shares", "rep", *MAPS), "active")
    pair = (F.least("p.cls", "q.cls").alias("x"), F.greatest("p.cls", "q.cls").alias("y"))

    ranked = posts.join(small_side(active.select("cls", "shares")), "cls")
    leader = ranked.groupBy("token").agg(F.max(F.struct("shares", "cls", "size", "pos")).alias("l")).select("token", "l.*")
    star = posts.alias("p").join(leader.alias("q"), F.expr("p.token = q.token AND p.cls <> q.cls") & _may_match("p", "q", percent))
    star = star.groupBy("p.cls", F.col("q.cls").alias("to")).agg(F.count("*").alias("n")).groupBy("cls").agg(F.max(F.struct("n", "to")).alias("t"))
    star = star.select(F.least("cls", "t.to").alias("x"), F.greatest("cls", "t.to").alias("y")).distinct()
    first = verified(star, rows, classes, docs, n, percent)

    same = _same_ids(rows, classes)
    nodes = active.select("cls", "rep").join(_labels([first, same]), F.col("rep") == F.col("node"), "left")
    nodes = stored(nodes.select("cls", F.coalesce("label", "rep").alias("comp")), "nodes")
    own = posts.join(small_side(nodes), "cls")
    sizes = own.groupBy("token", "comp").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("token").agg(F.max(F.struct("n", "comp")).alias("m"), F.count("*").alias("k")).where("k > 1")
    left = own.join(mixed.selectExpr("token", "m.comp AS main"), "token").join(small_side(active.select("cls", *MAPS), BROADCAST_IDS // 4), "cls")
    left = stored(left, "mixed")
    differ = F.expr("p.token = q.token AND p.comp <> q.comp") & _may_match("p", "q", percent) & _near("p", "q", percent)
    cross = left.where("comp <> main").alias("p").join(left.alias("q"), differ).select(*pair).distinct()
    second = verified(cross.join(first.select("x", "y"), ["x", "y"], "left_anti"), rows, classes, docs, n, percent)
    labels = _labels([first, second, same])

    groups = classes.join(labels, F.col("rep") == F.col("node"), "left").select(F.col("cls").alias("c"), F.coalesce("label", "rep").alias("component"))
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return rows.join(groups, F.col("cls") == F.col("c"), "left").select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of similar texts, all columns: that of the smallest doc_id, null ids last, then by the row's hash.

    Rows are told apart by a 64-bit hash of all columns and not by doc_id, so rows
    without an id and rows that share one are grouped by their own texts.  Of rows
    equal in all columns one stays, also where the text is null or blank.
    """
    spark, key = docs.sparkSession, unused(docs, "row key")
    hashed = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]  # a null alone leaves xxhash64 as it was
    keyed = docs.withColumn(key, F.xxhash64(*hashed))
    with passing(spark):
        groups = similar_groups(keyed.select(F.col(f"`{key}`").alias("doc_id"), "text"), n, percent).distinct()
        ids = keyed.select(F.col(f"`{key}`").alias("key"), F.col("doc_id").cast("long").alias("id")).groupBy("key").agg(F.first("id").alias("id"), F.count("*").alias("n"))
        order = F.struct(F.col("id").isNull().alias("last"), "id", "key", "n")
        first = ids.join(groups, F.col("key") == F.col("doc_id")).groupBy("component_id").agg(F.min(order).alias("first"))
        first = stored(first.select(F.col("first.key").alias("key"), F.col("first.n").alias("n")), "firsts", passes=False)
    kept = filter_ids(keyed, first.select("key"), key, keep=True)
    several = first.where("n > 1").select("key")
    if not several.isEmpty():  # only rows that are repeated whole are shuffled
        kept = filter_ids(kept, several, key, keep=False).unionByName(filter_ids(kept, several, key, keep=True).dropDuplicates())
    return kept.drop(key)
