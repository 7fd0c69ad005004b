"""Nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

1. Equal vectors are one node, with as many of their smallest ids as a result can
   show.  Nodes are dealt to shards by hash, so no shard follows a cluster of the data.
2. A shard's vectors (of similar length) are scaled by the longest and given one more
   component that puts them on the unit sphere; the largest inner product with a query is
   then the smallest angle.  Levels are drawn from the node's hash (each level holds
   one in ``LINKS`` of the one below).  Nodes enter a level in batches: a beam search of
   what is already there finds the candidates, of which those are linked that are
   nearer to the node than to a neighbour already chosen; full lists are cut the same way.
3. A shard is a stored row: vectors, ids, and one flat array of neighbours per level.
4. Queries go to the shards in chunks of bounded size.  In a shard a query descends
   the levels and then searches the lowest with a beam; every node of the beam is
   scored on the original doubles.  The shards' results are merged by rank.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.common import shared_dir, stored
from tallycast.llm.vectors import matrix, plain

#: Links that a node chooses, and the most that a list of the lowest level keeps and can hold.
LINKS, KEPT, WIDTH = 16, 32, 48
BUILD_BEAM, SEARCH_BEAM = 64, 160
#: Nodes that go down from level to level.
ENTRIES = 16
#: Nodes of a shard, about: its vectors and links take some 100 MB a task at 64 components.
SHARD_ROWS = 16_384
#: Queries sent to all shards at a time: 64 doubles each, 16 MB.
CHUNK = 32_768
#: Nodes that enter a level together, and queries that descend together, at most.
BATCH = 512


def beam_search(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes found per query, nearest first (len(x): none), and their likeness.

    ``entry`` has a row of different nodes to begin with for each query (len(x): none).
    ``links`` holds the neighbours of the nodes 0 .. len(links) - 1, -1 where there is none.
    """
    n, rows = len(x), np.arange(len(queries))
    seen = np.zeros(len(queries) * n, dtype=bool)
    ids = np.full((len(queries), beam), n, dtype=np.int64)
    like = np.full((len(queries), beam), -np.inf, dtype=np.float32)
    done = np.ones((len(queries), beam), dtype=bool)
    first = entry[:, :beam]
    real = first < n
    s = np.where(real, np.einsum("ij,ikj->ik", queries, x[np.where(real, first, 0)]), -np.inf)
    ids[:, :first.shape[1]], like[:, :first.shape[1]] = _nearest_first(first, s, beam)
    done[:, :first.shape[1]] = np.isneginf(like[:, :first.shape[1]])
    seen[(rows[:, None] * n + first)[real]] = True
    while True:
        todo = ~done
        todo &= np.cumsum(todo, axis=1) <= at_once
        r, c = np.nonzero(todo)
        if not len(r):
            return ids, like
        done[r, c] = True
        near = links.take(ids[r, c], axis=0)
        real = near >= 0
        code = np.repeat(r * n, real.sum(1)) + near[real]
        code = code[~seen.take(code)]
        if not len(code):
            continue
        code.sort()
        code = code[np.r_[True, code[1:] != code[:-1]]]
        seen[code] = True
        of = np.repeat(rows, np.diff(np.searchsorted(code, np.arange(len(queries) + 1) * n)))
        to = code - of * n
        s = np.einsum("ij,ij->i", queries.take(of, axis=0), x.take(to, axis=0))
        better = s > like[of, -1]
        of, to, s = of[better], to[better], s[better]
        if not len(of):
            continue
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        touched, count = of[first], np.diff(np.r_[first, len(of)])
        place = np.arange(len(of)) - np.repeat(first, count)
        line = np.repeat(np.arange(len(touched)), count)
        more, more_like = np.full((len(touched), count.max()), n, dtype=np.int64), np.full((len(touched), count.max()), -np.inf, dtype=np.float32)
        more[line, place], more_like[line, place] = to, s
        all_ids, all_like = np.hstack([ids[touched], more]), np.hstack([like[touched], more_like])
        all_done = np.hstack([done[touched], np.isneginf(more_like)])
        order = np.argsort(-all_like, axis=1, kind="stable")[:, :beam]
        for whole, part in ((ids, all_ids), (like, all_like), (done, all_done)):
            whole[touched] = np.take_along_axis(part, order, axis=1)


def choose(x: np.ndarray, cand: np.ndarray, like: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` candidates of each row (nearest first, len(x): none): those nearer to the row's
    node than to one chosen before, then the nearest of the others; -1 beyond."""
    n, (rows, width) = len(x), cand.shape
    real = cand < n
    v = x[np.where(real, cand, 0)]
    between = v @ v.transpose(0, 2, 1)
    chosen, count = np.zeros((rows, width), dtype=bool), np.zeros(rows, dtype=np.int64)
    for j in range(width):
        shadowed = (chosen & (between[:, j, :] > like[:, j, None])).any(1)
        take = real[:, j] & ~shadowed & (count < most)
        chosen[:, j] = take
        count += take
    place = np.where(chosen, 0, np.where(real, width, 2 * width)) + np.arange(width)
    order = np.argsort(place, axis=1)[:, :most]
    out = np.take_along_axis(cand, order, axis=1)
    return np.where(np.take_along_axis(real, order, axis=1), out, -1)


def _nearest_first(ids: np.ndarray, like: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-like, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(like, order, axis=1)


def _enter(x: np.ndarray, links: np.ndarray, degree: np.ndarray, lo: int, hi: int, entry: np.ndarray, kept: int) -> None:
    """Link the nodes lo .. hi - 1 into a level that holds the nodes before them."""
    n, new = len(x), x[lo:hi]
    own = new @ new.T
    own[np.arange(hi - lo), np.arange(hi - lo)] = -np.inf
    cand, like = _nearest_first(np.broadcast_to(np.arange(lo, hi), own.shape), own, BUILD_BEAM)
    cand = np.where(np.isneginf(like), n, cand)
    if lo:
        found, near = beam_search(x, links[:lo], new, entry, BUILD_BEAM)
        cand, like = _nearest_first(np.hstack([found, cand]), np.hstack([near, like]), BUILD_BEAM)
    out = choose(x, cand, like, min(LINKS, cand.shape[1]))
    links[lo:hi, :out.shape[1]] = out
    degree[lo:hi] = (out >= 0).sum(1)
    source, to = np.repeat(np.arange(lo, hi), out.shape[1]), out.ravel()
    source, to = source[to >= 0], to[to >= 0]
    back = ~(links[to] == source[:, None]).any(1)  # nodes of one batch may have chosen each other
    source, to = source[back], to[back]
    s = np.einsum("ij,ij->i", x[source], x[to])
    order = np.lexsort((-s, to))
    source, to, s = source[order], to[order], s[order]
    node, first, count = np.unique(to, return_index=True, return_counts=True)
    place = np.arange(len(to)) - np.repeat(first, count)
    width = links.shape[1]
    fits = np.repeat(degree[node] + count <= width, count)
    links[to[fits], (degree[to] + place)[fits]] = source[fits]
    room = degree[node] + count <= width
    degree[node[room]] += count[room]
    full = node[~room]
    for a in range(0, len(full), BATCH):
        some = full[a:a + BATCH]
        more = np.full((len(some), width), n, dtype=np.int64)
        line = np.searchsorted(some, to)
        ours = (~fits) & (line < len(some)) & (place < width)
        ours[ours] = some[line[ours]] == to[ours]
        more[line[ours], place[ours]] = source[ours]
        cand = np.hstack([np.where(links[some] < 0, n, links[some]), more])
        like = np.where(cand < n, np.einsum("ij,ikj->ik", x[some], x[np.where(cand < n, cand, 0)]), -np.inf).astype(np.float32)
        cand, like = _nearest_first(cand, like, 2 * width)
        out = choose(x, cand, like, kept)
        links[some] = -1
        links[some, :out.shape[1]] = out
        degree[some] = (out >= 0).sum(1)


def build(x: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """The links of every level, lowest first, over unit vectors in order of descending level;
    ``sizes`` has the nodes of each level, which are the first ones."""
    levels: list[np.ndarray] = []
    for level in range(len(sizes) - 1, -1, -1):
        n, kept, width = sizes[level], (KEPT if level == 0 else LINKS), (WIDTH if level == 0 else WIDTH // 2)
        links, degree = np.full((n, width), -1, dtype=np.int32), np.zeros(n, dtype=np.int64)
        lo = 0
        while lo < n:
            hi = min(n, lo + min(BATCH, max(64, lo // 2)))
            entry = descend(x[:n], levels, x[lo:hi]) if lo else np.zeros((hi - lo, 1), dtype=np.int64)
            entry = np.where(entry < lo, entry, n)  # an upper level's nodes enter before all others
            entry[:, 0] = np.where((entry == n).all(1), 0, entry[:, 0])
            _enter(x[:n], links, degree, lo, hi, entry, kept)
            lo = hi
        levels.insert(0, links)
    return levels


def descend(x: np.ndarray, levels: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """The nodes that the given levels (lowest first) lead each query to (len(x): none).

    Several at a time go down, so that a group which no link of a level enters is reached by another.
    """
    at = np.zeros((len(queries), 1), dtype=np.int64)
    for links in reversed(levels):
        m = len(links)
        at = beam_search(x[:m], links, queries, np.where(at < m, at, m), ENTRIES)[0]
        at = np.where(at < m, at, len(x))
    return at


def length_bands(x: np.ndarray) -> np.ndarray:
    """Numbers of ranges of length, from half a power of four to twice it.  Each range is a graph of its
    own: beside a far longer vector the others would all look alike on the sphere."""
    top = np.abs(x).max(1)
    return np.floor((1 + np.log2(top) + np.log2(np.linalg.norm(x / top[:, None], axis=1))) / 2).astype(np.int64)


def on_sphere(x: np.ndarray) -> np.ndarray:
    """The vectors scaled by the longest, with a last component that makes them unit vectors."""
    x = x / max(np.abs(x).max(initial=0), np.finfo(np.float64).tiny)  # before squaring
    square = np.einsum("ij,ij->i", x, x)
    top = square.max(initial=0)
    return np.hstack([x / np.sqrt(top), np.sqrt(np.maximum(1 - square / top, 0))[:, None]]).astype(np.float32)


def toward(q: np.ndarray) -> np.ndarray:
    """Unit queries; their last component is 0."""
    q = q / np.abs(q).max(1, keepdims=True)
    return np.hstack([q / np.sqrt(np.einsum("ij,ij->i", q, q))[:, None], np.zeros((len(q), 1))]).astype(np.float32)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner product of each row of ``a`` with the same row of ``b``, summed in order of the components."""
    out = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(a.shape[1]):
            out += a[:, i] * b[:, i]
    return out


def _nodes(rows: DataFrame, most: int) -> DataFrame:
    """(embedding, ids): the distinct vectors, each with its ``most`` smallest ids, in order."""
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))  # cut to ``most`` before the exchange as well
    few = rows.select("vec_id", "embedding").distinct().select("*", rank.alias("rank")).where(F.col("rank") <= most)
    return few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def index(rows: DataFrame, most: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Stored (dims, n, vectors, counts, ids, links): a row per shard, number of components and range of length."""
    nodes = stored(_nodes(rows, most), "nodes")
    mark = F.xxhash64("embedding")
    shards = -(-nodes.count() // shard_rows)

    def graphs(table: pa.Table) -> pa.Table:
        # levels are drawn from other bits of the hash than the shard
        table = table.sort_by([("mark", "ascending")])
        mark = table.column("mark").to_numpy().view(np.uint64)
        mixed = (mark ^ (mark >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        level = np.floor(-np.log(((mixed >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)) / np.log(LINKS)).astype(np.int64)
        vectors = matrix(table.column("embedding"), table.column("dims")[0].as_py())
        ids, bands, out = table.column("ids").combine_chunks(), length_bands(vectors), []
        for band in np.unique(bands):
            at = np.flatnonzero(bands == band)
            at = at[np.argsort(-level[at], kind="stable")]
            sizes = [int((level[at] >= h).sum()) for h in range(int(level[at[0]]) + 1)]
            x, named = vectors[at], ids.take(pa.array(at))
            out.append({"dims": x.shape[1], "n": len(x), "vectors": x.tobytes(), "counts": named.value_lengths().to_numpy().astype(np.int32).tobytes(),
                        "ids": named.flatten().to_numpy().tobytes(), "links": [links.tobytes() for links in build(on_sphere(x), sizes)]})
        return pa.Table.from_pylist(out, pa.schema([("dims", pa.int32()), ("n", pa.int32()), ("vectors", pa.binary()), ("counts", pa.binary()),
                                                    ("ids", pa.binary()), ("links", pa.list_(pa.binary()))]))

    dealt = nodes.select(F.pmod(mark, F.lit(max(shards, 1))).alias("shard"), F.size("embedding").alias("dims"), mark.alias("mark"), "embedding", "ids")
    dealt = dealt.repartition(max(shards, 1), "shard", "dims").groupBy("shard", "dims")
    return stored(dealt.applyInArrow(graphs, "dims int, n int, vectors binary, counts binary, ids binary, links array<binary>"), "graphs")


def search(shard: dict, queries: np.ndarray, own: np.ndarray, top: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of up to ``top`` nearest nodes of a shard per query, but for its ``own`` id."""
    dims, n = shard["dims"], shard["n"]
    vectors = np.frombuffer(shard["vectors"]).reshape(n, dims)
    counts, ids = np.frombuffer(shard["counts"], dtype=np.int32), np.frombuffer(shard["ids"], dtype=np.int64)
    starts = np.cumsum(counts) - counts
    levels = [np.frombuffer(b, dtype=np.int32).reshape(-1, WIDTH if i == 0 else WIDTH // 2) for i, b in enumerate(shard["links"])]
    x, out = on_sphere(vectors), []
    for lo in range(0, len(queries), BATCH):
        some = queries[lo:lo + BATCH]
        unit = toward(some)
        found, _ = beam_search(x, levels[0], unit, descend(x, levels[1:], unit), beam)
        q, c = np.nonzero(found < n)
        node = found[q, c]
        score = inner_products(some[q], vectors[node])
        many = counts[node]
        q, score = np.repeat(q, many), np.repeat(score, many)
        place = np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
        vec = ids[np.repeat(starts[node], many) + place]
        other = vec != own[lo + q]
        q, score, vec = q[other], score[other], vec[other]
        order = np.lexsort((vec, -score, q))
        q, score, vec = q[order], score[order], vec[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < top
        out.append((q[keep] + lo, vec[keep], score[keep]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def neighbours(vectors: DataFrame, *, top: int = 20, every: int = 20, beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found to every row whose vec_id is divisible by ``every``.

    Candidates are all rows but those of the query's own vec_id; nearest is the
    largest inner product of the vectors as doubles (ties: smaller vec_id).
    Vectors that are null, empty or zero, or hold a null or non-finite
    component, and rows without vec_id take no part.  A query meets vectors of its own
    length.  Equal rows count once; rows that share an id but not the vector are
    queries, and candidates, of their own.  Products beyond the doubles are infinite;
    a score that is no number is last.  Extra columns are not read; an empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = plain(vectors).where(F.col("vec_id").isNotNull() & F.exists("embedding", lambda x: x != 0))
    graphs = index(rows, top + 1, shard_rows)
    asked = stored(rows.where(F.col("vec_id") % every == 0).distinct(), "queries")
    chunks = -(-asked.count() // chunk)
    schema = "chunk int, query int, query_id long, vec_id long, score double"
    path = f"{shared_dir(spark)}/found-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    for number in range(chunks):
        of = asked.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(chunks)) == number)
        sent = spark.sparkContext.broadcast(_by_length(of.toArrow()))  # about ``chunk`` rows

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    shard = batch.slice(i, 1).to_pylist()[0]
                    if shard["dims"] in sent.value:
                        number_of, own, queries = sent.value[shard["dims"]]
                        q, vec, score = search(shard, queries, own, top, beam)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(q), number, np.int32)), pa.array(number_of[q].astype(np.int32)), pa.array(own[q]), pa.array(vec), pa.array(score)],
                            names=["chunk", "query", "query_id", "vec_id", "score"])

        graphs.mapInArrow(found, schema).write.mode("append").parquet(path)
        sent.destroy()
    best = Window.partitionBy("chunk", "query").orderBy(F.col("score").desc(), "vec_id")
    ranked = spark.read.schema(schema).parquet(path).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per vector length the queries' numbers in the chunk, ids and vectors."""
    lengths = table.column("embedding").combine_chunks().value_lengths().to_numpy()
    out = {}
    for dims in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dims)
        part = table.take(at)
        out[dims] = (at, part.column("vec_id").to_numpy(), matrix(part.column("embedding"), dims))
    return out
