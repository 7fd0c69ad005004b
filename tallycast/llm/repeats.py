"""Exact removal of repeated 100-byte strings by partitioned suffix arrays and their common-prefix interval trees.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in
the corpus.  One suffix array of the corpus is not to be had, so suffixes are
sampled and partitioned such that no repeat is lost:

1. Anchors.  In each string of LENGTH bytes the K-byte run with the smallest hash
   (the rightmost of equal ones) is its anchor, so equal strings have equal
   anchors at equal offsets.  About one byte in 35 is an anchor.  What may be
   decided at an anchor lies in its context, the bytes from LENGTH - K before to
   LENGTH after it.
2. Equal contexts.  Anchors are dealt out and sorted by hashes of run and context,
   in ranges, so a frequent run is split between tasks.  Of equal contexts the
   first occurrence stays and the others go whole; tasks settle the copies that
   they read themselves beforehand.
3. Suffix arrays.  Runs with several contexts need their text.  The contexts of a
   run are the suffixes that start with it: sorted, with the common prefixes of
   neighbours, they form an enhanced suffix array.  A stack scan gives its
   interval tree.  An interval of depth r holds all occurrences of a string of r
   bytes; if the bytes before them differ it is a maximal repeat.  Sorted by what
   stands before, each occurrence gets the longest left extension that it shares
   with an earlier one, and with it the strings that it repeats.
4. Runs with more than ``HOT`` contexts are counted out beforehand and never
   gathered in a task: each string of their contexts is hashed where its text is,
   and all but the first occurrence of a hash go.

Texts move once, to be joined with the anchors and again, from the same exchange,
with the spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm import hashing as H
from tallycast.llm.common import as_often, filter_ids, stored

LENGTH, K = 100, 32
BEFORE = LENGTH - K
HOT = 200_000
#: Windows of a batch that are hashed at a time.
STRETCH = 1 << 20

ANCHOR_SCHEMA = "run long, context long, did long, sub int, pos int, before int, after int"
FOUND_SCHEMA = "did long, sub int, pos int, size int, run long"
CONTEXT_SCHEMA = "run long, did long, sub int, pos int, before int, bytes binary"
SPAN_SCHEMA = "did long, sub int, pos int, size int"
STRING_SCHEMA = "h1 long, h2 long, did long, sub int, pos int"


# ---------------------------------------------------------------- anchors

def _stretch_anchors(buf: np.ndarray, bounds: np.ndarray, a: int, b: int) -> tuple[np.ndarray, ...]:
    """Anchors of the windows that start in [a, b): position, hash of the run, hash of the context, bytes before and after."""
    lo, hi = max(0, a - BEFORE), min(len(buf), b + 2 * LENGTH)
    part = buf[lo:hi]
    sums = np.zeros(len(part) + 1, dtype=H.U)
    np.cumsum(H.byte_values(False)[part] * H.powers(H._BASE, len(part)), out=sums[1:])
    inverse = H.powers(H._INVERSE, len(part) + 1)
    runs = H.mix((sums[K:] - sums[:-K]) * inverse[:len(part) - K + 1])
    low = np.arange(len(runs), dtype=H.U)
    least = (runs >> H.U(24) << H.U(24)) | (H.U((1 << 24) - 1) - low)
    width = 1
    while 2 * width <= BEFORE + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = BEFORE + 1 - width
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    starts = np.arange(a, min(b, lo + len(least)))
    row = np.searchsorted(bounds, starts, side="right") - 1
    starts = starts[starts + LENGTH <= bounds[row + 1]]
    p = np.int64((1 << 24) - 1) - (least[starts - lo] & H.U((1 << 24) - 1)).astype(np.int64)
    p = p[np.concatenate([[True], p[1:] != p[:-1]])] if len(p) else p
    row = np.searchsorted(bounds, p + lo, side="right") - 1
    before = np.minimum(BEFORE, p + lo - bounds[row])
    after = np.minimum(LENGTH, bounds[row + 1] - p - lo)
    around = (sums[p + after] - sums[p - before]) * inverse[p - before]
    around = H.mix(around ^ (before * 128 + after).astype(H.U) * H.U(0xA24BAED4963EE407))
    return p + lo, runs[p], around, before, after, row


def _block_anchors(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """The anchors of all texts in ``buf``; a text may be longer than a stretch."""
    found = []
    for a in range(0, len(buf) - LENGTH + 1, STRETCH):
        part = _stretch_anchors(buf, bounds, a, min(a + STRETCH, len(buf) - LENGTH + 1))
        if found and len(part[0]) and len(found[-1][0]) and part[0][0] == found[-1][0][-1]:
            part = tuple(x[1:] for x in part)
        found.append(part)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else tuple(np.zeros(0, t) for t in (np.int64, H.U, H.U, np.int64, np.int64, np.int64))


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans joined where they touch within a row; they come by row, with starts and ends that do not fall."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(row)]])[:len(first)] - 1
    return row[first], start[first], end[last]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """did, sub, text to anchors; copies within a batch are settled here and go on as spans (before = -1, after = size)."""
    names = [x.split()[0] for x in ANCHOR_SCHEMA.split(", ")]
    for batch in batches:
        did, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        buf, off = H.column_bytes(batch.column(2))
        parts = []
        for lo, hi in H.slices(off):
            p, run, around, before, after, row = _block_anchors(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            parts.append((run, around, row + lo, p + off[lo] - off[row + lo], before, after))
        if not parts:
            continue
        run, around, row, pos, before, after = (np.concatenate(x) for x in zip(*parts, strict=True))
        place = np.empty(len(did), dtype=np.int64)
        place[np.lexsort((sub, did))] = np.arange(len(did))
        key = run ^ H.mix(around)
        order = np.lexsort((pos, place[row], key))
        copy = np.zeros(len(key), dtype=bool)
        copy[order[1:]] = key[order[1:]] == key[order[:-1]]
        r, s, e = _merged(row[copy], (pos - before)[copy], (pos + after)[copy])
        rest = ~copy
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (
                np.concatenate([run[rest].view(np.int64), H.mix(s.astype(H.U) + did[r].view(H.U)).view(np.int64)]),
                np.concatenate([around[rest].view(np.int64), np.zeros(len(r), np.int64)]),
                np.concatenate([did[row[rest]], did[r]]), np.concatenate([sub[row[rest]], sub[r]]),
                np.concatenate([pos[rest], s]).astype(np.int32), np.concatenate([before[rest], np.full(len(r), -1)]).astype(np.int32),
                np.concatenate([after[rest], e - s]).astype(np.int32))], names=names)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted anchors to spans (size > 0) and to anchors whose run has several contexts (size = 0).

    The state is one row, however many anchors a run has.  The first and last
    run of a task may go on in another, so their contexts always go on.
    """
    names = [x.split()[0] for x in FOUND_SCHEMA.split(", ")]
    last_run = last_context = held = None
    several = True  # the run under way: the task's first one counts as having several contexts

    def out(did, sub, pos, size, run):
        return pa.RecordBatch.from_arrays([pa.array(did), pa.array(sub), pa.array(pos, pa.int32()), pa.array(size, pa.int32()), pa.array(run)], names=names)

    for batch in batches:
        run, context, did, sub, pos, before, after = (c.to_numpy() for c in batch.columns)
        span = before < 0
        if span.any():
            yield out(did[span], sub[span], pos[span], after[span], run[span])
            run, context, did, sub, pos, before, after = (x[~span] for x in (run, context, did, sub, pos, before, after))
        if not len(run):
            continue
        new_run, new_context = np.ones(len(run), dtype=bool), np.ones(len(run), dtype=bool)
        new_run[1:] = run[1:] != run[:-1]
        new_run[0] = last_run is None or run[0] != last_run
        new_context[1:] = new_run[1:] | (context[1:] != context[:-1])
        new_context[0] = new_run[0] or context[0] != last_context
        group = np.cumsum(new_run)  # 0: the run under way
        contexts = np.bincount(group, weights=new_context, minlength=group[-1] + 1)
        wide = contexts > 1
        wide[0] = several or (held is not None and contexts[0] > 0)
        if last_run is None:
            wide[1] = True  # the task's first run
        if held is not None and wide[0]:
            yield held
        if contexts[0] or len(contexts) > 1:
            held = None if wide[0] or len(contexts) > 1 else held
        copy = ~new_context
        if copy.any():
            yield out(did[copy], sub[copy], (pos - before)[copy], (before + after)[copy], run[copy])
        go = new_context & wide[group]
        if go.any():
            yield out(did[go], sub[go], pos[go], np.zeros(go.sum(), np.int32), run[go])
        end = len(contexts) - 1
        if end > 0:
            several = bool(wide[end])
            if not several:
                i = int(np.flatnonzero(new_run)[-1])
                held = out(did[i:i + 1], sub[i:i + 1], pos[i:i + 1], np.zeros(1, np.int32), run[i:i + 1])
        else:
            several = bool(wide[0])
        last_run, last_context = run[-1], context[-1]
    if held is not None:
        yield held


# ---------------------------------------------------------------- suffix arrays

def common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return n if not x else ((x & -x).bit_length() - 1) >> 3


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """The inner nodes of the common-prefix interval tree by a stack scan: (depth, depth of the parent, first, last suffix).

    ``lcp[i]`` is the common prefix of suffixes i and i + 1 of the array.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            own, first = stack.pop()
            yield own, max(depth, stack[-1][0] if stack else 0), first, i
        if depth > 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def longest_shared(order: list[int], keys: list[bytes]) -> dict[int, int]:
    """For members by rank: the longest common prefix of a member's key with that of any member of lower rank.

    ``order`` sorts the members by key; the best partner on either side is the
    nearest of lower rank, found by a stack.
    """
    best = dict.fromkeys(order, -1)
    for line in (order, order[::-1]):
        stack: list[tuple[int, int]] = []  # rank, common prefix with the one above
        before = None
        for i in line:
            shared = common(keys[before], keys[i]) if before is not None else 0
            while stack and stack[-1][0] > i:
                shared = min(shared, stack.pop()[1])
            if stack:
                best[i] = max(best[i], shared)
            stack.append((i, shared))
            before = i
    return best


def repeated(contexts: list[tuple[bytes, int]]) -> list[tuple[int, int, int]]:
    """(member, bytes before, bytes after its anchor) of what repeats earlier members, in contexts of one run in corpus order.

    ``contexts`` has each member's bytes and how many of them stand before the
    anchor.
    """
    right = [c[b:] for c, b in contexts]
    left = [c[:b][::-1] for c, b in contexts]
    if len(contexts) == 2:
        r, l = common(*right), common(*left)
        return [(1, l, r)] if l + r >= LENGTH else []
    array = sorted(range(len(right)), key=right.__getitem__)
    lcp = [common(right[a], right[b]) for a, b in zip(array, array[1:], strict=False)]
    out = []
    for depth, parent, first, last in intervals(lcp):
        if depth < K:
            continue  # a collision of hashes
        members = array[first:last + 1]
        shortest, longest = LENGTH - depth, min(BEFORE, LENGTH - max(parent, K - 1) - 1)
        if len({left[m][:shortest] for m in members}) == len(members):
            continue  # no two occurrences go on to the left far enough
        shared = longest_shared(sorted(members, key=lambda m: (left[m], m)), left)
        out += [(m, min(n, longest), depth) for m, n in shared.items() if n >= shortest]
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The sorted contexts of one run after the other."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[0] != held[0][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def _tree_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans that the suffix array of each run gives."""
    rows: list[tuple] = []
    for members in _runs(batches):
        for m, b, a in repeated([(r[5], r[4]) for r in members]) if len(members) > 1 else []:
            _, did, sub, pos, _, _ = members[m]
            rows.append((did, sub, pos - b, b + a))
        if len(rows) >= 10_000:
            yield _batch(rows, SPAN_SCHEMA)
            rows = []
    if rows:
        yield _batch(rows, SPAN_SCHEMA)


def _string_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of LENGTH bytes in contexts: a hash of 128 bits and the place of each."""
    for batch in batches:
        rows: list[tuple] = []
        for _, did, sub, pos, b, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for i in range(len(data) - LENGTH + 1):
                h = hashlib.blake2b(data[i:i + LENGTH], digest_size=16).digest()
                rows.append((int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), did, sub, pos - b + i))
            if len(rows) >= 20_000:
                yield _batch(rows, STRING_SCHEMA)
                rows = []
        if rows:
            yield _batch(rows, STRING_SCHEMA)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """did, sub, text, at (position and run of its anchors) to the bytes around each anchor."""
    for batch in batches:
        rows: list[tuple] = []
        for did, sub, text, at in zip(*batch.columns[:4], strict=True):
            data, d, s = text.as_py().encode(), did.as_py(), sub.as_py()
            rows += [(x["run"], d, s, x["pos"], min(BEFORE, x["pos"]), data[max(0, x["pos"] - BEFORE):x["pos"] + LENGTH]) for x in at.as_py()]
            if len(rows) >= 20_000:
                yield _batch(rows, CONTEXT_SCHEMA)
                rows = []
        if rows:
            yield _batch(rows, CONTEXT_SCHEMA)


# ---------------------------------------------------------------- the operator

def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows doc_id, did, sub, text, one for each doc_id and text, and those that stand for more with their further ``times``.

    ``did`` orders the rows as doc_id does, null first; ``sub`` orders the texts
    of one doc_id by their hash, numbered by parts of the hash's range, so that a doc_id
    of many rows (or none) is not in one task.  It is an int: one doc_id
    has at most 2^31 texts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("did", F.coalesce("doc_id", F.lit(-(1 << 63))))
    if rows.groupBy("did").count().where("count > 1").isEmpty():
        return rows.withColumn("sub", F.lit(0)), None
    texts = rows.groupBy("did", "doc_id", "text").agg((F.count("*") - 1).alias("times")).withColumn("hash", F.sha2("text", 256))
    texts = stored(texts.withColumn("part", F.conv(F.substring("hash", 1, 3), 16, 10).cast("int")), "texts")
    earlier = Window.partitionBy("did").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over at most 4,096 parts
    before = texts.groupBy("did", "part").agg(F.count("*").alias("n")).select("did", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("did", "part").orderBy("hash", F.asc_nulls_first("doc_id")))
    rows = texts.join(before, ["did", "part"]).withColumn("sub", (F.col("before") + own).cast("int"))
    return rows.select("doc_id", "did", "sub", "text"), texts.where("times > 0").select("doc_id", "text", "times")


def _later_copies(copies: DataFrame, with_bytes: bool) -> DataFrame:
    """What ``without_repeats`` gives for the copies of a doc_id's text: all goes, or nothing of fewer than LENGTH bytes."""
    n, gone = F.octet_length("text").cast("long"), F.octet_length("text") >= LENGTH
    runs = lambda at: F.when(gone, F.array(at)).otherwise(F.array().cast("array<long>"))
    kept = F.when(gone, "").otherwise(F.col("text"))
    columns = [n.alias("n_bytes"), F.when(gone, n).otherwise(0).cast("long").alias("n_removed"), gone.cast("long").alias("n_spans"),
               F.sha2(kept, 256).alias("kept_sha256"), runs(F.lit(0).cast("long")).alias("starts"), runs(n).alias("ends")]
    return as_often(copies.select("doc_id", *columns, *[kept.cast("binary").alias("kept")] * with_bytes, "times"), "times")


def repeated_spans(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """(did, sub, spans, and the texts) of keyed ``rows`` (doc_id, did, sub, text): see ``without_repeats``."""
    anchors = rows.select("did", "sub", "text").mapInArrow(_anchors, ANCHOR_SCHEMA)
    anchors = anchors.repartitionByRange("run", "context").sortWithinPartitions("run", "context", "did", "sub", "pos")
    found = stored(anchors.mapInArrow(_settled, FOUND_SCHEMA), "anchors")

    texts = rows.select("doc_id", "did", "sub", "text")
    wanted = found.where("size = 0").select("run", "did", "sub", "pos")
    frequent = stored(wanted.groupBy("run").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("run"), "frequent")

    def contexts(anchors: DataFrame) -> DataFrame:
        anchors = anchors.groupBy("did", "sub").agg(F.collect_list(F.struct("pos", "run")).alias("at"))
        both = texts.join(anchors, ["did", "sub"])  # all columns of texts: the last join then finds the same exchange
        return both.select("did", "sub", "text", "at", "doc_id").mapInArrow(_contexts, CONTEXT_SCHEMA)

    spans = found.where("size > 0").select("did", "sub", "pos", "size")
    if frequent.isEmpty():
        rare = contexts(wanted)
    else:
        rare = contexts(filter_ids(wanted, frequent, "run", keep=False))
        strings = contexts(filter_ids(wanted, frequent, "run", keep=True)).mapInArrow(_string_hashes, STRING_SCHEMA)
        place = F.struct("did", "sub", "pos")
        firsts = strings.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
        spans = spans.unionByName(strings.join(firsts, ["h1", "h2"]).where(place != F.col("first")).select("did", "sub", "pos", F.lit(LENGTH).alias("size")))
    rare = rare.repartition("run").sortWithinPartitions("run", "did", "sub", "pos")
    spans = spans.unionByName(rare.mapInArrow(_tree_spans, SPAN_SCHEMA))
    spans = spans.groupBy("did", "sub").agg(F.collect_list(F.struct("pos", "size")).alias("spans"))
    return texts.join(spans, ["did", "sub"], "left")


def without_repeats(docs: DataFrame, with_bytes: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends of every row: its text as UTF-8 without the bytes that repeat.

    ``starts`` and ``ends`` are the maximal removed runs; ``with_bytes`` adds the
    bytes that are left.  The corpus is ordered by doc_id, null first; rows that
    repeat a doc_id are documents of their own, ordered by their text's hash;
    of rows that repeat doc_id and text the search meets one, the others lose all
    of their text if it has LENGTH bytes.
    Null or empty texts and those of fewer than LENGTH bytes keep all.  Extra
    columns are not read; an empty table gives no rows.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"] + ["kept"] * with_bytes
        types = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2 + [pa.binary()] * with_bytes
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*batch.columns, strict=True):
                data, runs = text.as_py().encode(), []
                for start, end in sorted((x["pos"], x["pos"] + x["size"]) for x in spans.as_py() or ()):
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([start, end])
                cuts = [0, *(x for run in runs for x in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)) if runs else data
                row = (doc_id.as_py(), len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), [a for a, _ in runs], [b for _, b in runs])
                out.append((*row, kept) if with_bytes else row)
                if len(out) >= 2_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>" + ", kept binary" * with_bytes
    rows, copies = _keyed(docs)
    found = repeated_spans(rows, hot).select("doc_id", "text", "spans").mapInArrow(keep, schema)
    return found if copies is None else found.unionByName(_later_copies(copies, with_bytes))
