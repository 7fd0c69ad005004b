"""Language identification by interpolated Kneser-Ney character models.

Each language has a character 4-gram model with Kneser-Ney smoothing: raw counts
at the highest order, continuation counts below, one absolute discount per
order.  The counts cover every gram of every training document; they, the
continuation counts and the counts of counts are summed by Spark.  The models
reach the tasks in parts of some ``SHARD_ROWS`` n-grams, all n-grams of one
context in the same part, as sorted arrays; a task looks up the distinct grams of
its texts in one part after the other.  A text gets the language of lowest
cross-entropy per character, and is rejected where that is far above what the
language's own texts have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm import hashing as H
from tallycast.llm.common import stored, unused

ORDER = 4
#: Characters of a text that are looked at together; a longer one is counted and scored in stretches.
STRETCH = 1 << 20
#: N-grams of a part of the models, parts that a task keeps loaded, and n-grams times languages looked up together.
SHARD_ROWS, LOADED, CELLS = 2_000_000, 4, 1 << 22
#: Labelled texts under which a language's spread is not taken from its own texts alone.
FEW = 8
#: The model of all training rows; 0 and 1 are those learned without the rows of this fold.
WHOLE = 2
UNDETERMINED = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter (str.isalpha)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts as 16-bit symbols, every other run one space; and the n + 1 bounds of the texts.

    Each text starts with three spaces, which are context only.
    """
    low = [f"   {(t or '').lower()} " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    for i in range(ORDER - 1):
        keep[starts[:-1] + i] = True
    narrow = np.where(code > 0xFFFF, 0xE000 + code % 6400, code)
    out = np.where(letter, narrow, 32)[keep].astype(np.uint64)
    return out, np.concatenate([[0], np.cumsum(keep)])[starts]


def _grams(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The packed ORDER-gram that ends at each symbol after a text's pad, and the n + 1 bounds of the texts' grams."""
    packed = np.zeros(max(len(codes) - ORDER + 1, 0), dtype=np.uint64)
    for i in range(ORDER):
        packed = (packed << np.uint64(16)) | codes[i:i + len(packed)]
    real = np.ones(len(codes), dtype=bool)
    for i in range(ORDER - 1):
        real[bounds[:-1] + i] = False
    ends = np.flatnonzero(real)
    return packed[ends - ORDER + 1], np.searchsorted(ends, bounds)


def _tally(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams and how often each occurs."""
    grams, _ = _grams(codes, bounds)
    present = np.flatnonzero(np.bincount(codes.astype(np.int64), minlength=1))
    size = len(present)
    if size ** ORDER > 1 << 24:
        return np.unique(grams, return_counts=True)
    dense = np.zeros(65536, dtype=np.int64)
    dense[present] = np.arange(size)
    index = np.zeros(len(grams), dtype=np.int64)
    for i in reversed(range(ORDER)):
        index = index * size + dense[(grams >> np.uint64(16 * i)).astype(np.int64) & 0xFFFF]
    n = np.bincount(index, minlength=1)
    held = np.flatnonzero(n)
    keys, rest = np.zeros(len(held), dtype=np.uint64), held.copy()
    for i in range(ORDER):
        keys |= present[rest % size].astype(np.uint64) << np.uint64(16 * i)
        rest //= size
    return keys, n[held]


def _stretches(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The texts cut to ``STRETCH`` characters, and the text that each stretch is of."""
    parts = [(t[lo:lo + STRETCH], i) for i, t in enumerate(x or "" for x in texts) for lo in range(0, max(len(t), 1), STRETCH)]
    return [t for t, _ in parts], np.array([i for _, i in parts], dtype=np.int64)


def _pieces(texts: list[str], size: int = 1 << 20) -> Iterator[slice]:
    lo, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield slice(lo, i + 1)
            lo, total = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def gram_counts(docs: DataFrame) -> DataFrame:
    """Stored (lang, gram, n0, n1) over all rows of ``docs`` (text, lang, fold), by fold, summed in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

        for batch in H.by_bytes(batches, 0, 4 << 20, 10_000):
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            texts = np.array(batch.column(0).to_pylist(), dtype=object)
            folds = batch.column(2).to_numpy()
            for lang, fold in set(zip(langs.tolist(), folds.tolist(), strict=True)):
                own, _ = _stretches(texts[(langs == lang) & (folds == fold)].tolist())
                for part in _pieces(own):
                    held.setdefault((lang, fold), []).append(_tally(*symbols(own[part])))
                    if len(held[lang, fold]) > 16:
                        held[lang, fold] = [merged(held[lang, fold])]
        for (lang, fold), parts in held.items():
            keys, n = merged(parts)
            for lo in range(0, len(keys), 50_000):
                k = keys[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(k), pa.string()), pa.array([fold] * len(k), pa.int32()), pa.array(k.view(np.int64)), pa.array(n[lo:lo + 50_000])],
                    names=["lang", "fold", "gram", "n"])

    sums = [F.sum(F.when(F.col("fold") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in (0, 1)]
    return stored(docs.select("text", "lang", "fold").mapInArrow(count, "lang string, fold int, gram long, n long").groupBy("lang", "gram").agg(*sums), "grams")


class _Judge:
    """Verdicts by ``entropies``."""

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        """(language, score, cross-entropy, rejected) of each text; ties go to the first language by name."""
        out = []
        if not self.langs:
            return [(UNDETERMINED, 0.0, None, True)] * len(texts)
        together = max(1, CELLS // len(self.langs))
        for lo in range(0, len(texts), together):
            bits, n = self.entropies(texts[lo:lo + together])
            for row, b, k in zip(bits, bits.argmin(axis=1).tolist(), n.tolist(), strict=True):
                if not k:
                    out.append((UNDETERMINED, 0.0, None, True))
                    continue
                score = 1 / float(np.exp2((row[b] - row) * min(k, 20)).sum())
                far = self.centre is not None and row[b] > self.centre[b] + 8 * np.hypot(self.spread[b], self.per_symbol[b] / k ** 0.5) + 1
                out.append((self.langs[b], score, float(row[b]), bool(far)))
        return out


@dataclass
class Model(_Judge):
    """One model held whole, the measure of ``Models``: sorted keys by order, the languages' log2 probabilities beside them; context keys and log2 back-off weights."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: float
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    per_symbol: np.ndarray | None = None

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol (texts x languages) and the number of symbols of each text."""
        parts, owner = _stretches(texts)
        total, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=np.int64)
        for part in _pieces(parts):
            bits, k = self._bits(parts[part])
            np.add.at(total, owner[part], bits)
            np.add.at(n, owner[part], k)
        return total / np.maximum(n, 1)[:, None], n

    def _bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits (texts x languages) and the number of symbols of each text."""
        grams, bounds = _grams(*symbols(texts))
        bits = np.zeros((len(grams), len(self.langs)), dtype=np.float32)
        todo, keys = np.arange(len(grams)), grams
        for order in range(ORDER, 0, -1):
            have = self.keys[order - 1]
            at = np.minimum(np.searchsorted(have, keys), max(len(have) - 1, 0))
            hit = have[at] == keys if len(have) else np.zeros(len(keys), dtype=bool)
            bits[todo[hit]] -= self.logp[order - 1][at[hit]]
            todo, keys = todo[~hit], keys[~hit]
            context = keys >> np.uint64(16)
            known = self.contexts[order - 1]
            at = np.minimum(np.searchsorted(known, context), max(len(known) - 1, 0))
            hit = known[at] == context if len(known) else np.zeros(len(keys), dtype=bool)
            bits[todo[hit]] -= self.backoff[order - 1][at[hit]]
            keys = keys & np.uint64((1 << 16 * (order - 1)) - 1)
        bits[todo] -= self.floor
        n = np.diff(bounds)
        total = np.zeros((len(texts), len(self.langs)))
        full = np.flatnonzero(n)
        if len(full):
            total[full] = np.add.reduceat(bits.astype(np.float64), bounds[:-1][full], axis=0)
        return total, n


def _find(sorted_keys: np.ndarray, keys: np.ndarray, values: np.ndarray, default: float) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(keys), default)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], default)


def build(langs: list[str], grams: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    """Interpolated Kneser-Ney models of the languages from their highest-order counts, in one process."""
    tables = []  # by language, by order: keys, counts
    for g, c in zip(grams, counts, strict=True):
        order = np.argsort(g)
        own = [(g[order], c[order].astype(np.float64))]
        for n in range(ORDER - 1, 0, -1):
            keys, kinds = np.unique(own[0][0] & np.uint64((1 << 16 * n) - 1), return_counts=True)
            own.insert(0, (keys, kinds.astype(np.float64)))
        tables.append(own)
    keys, logp, contexts, backoff = [], [], [], []
    alphabet = len(np.unique(np.concatenate([t[0][0] for t in tables]))) + 1 if tables else 1
    below = None  # probabilities beside the keys of the order below
    for n in range(1, ORDER + 1):
        merged = np.unique(np.concatenate([t[n - 1][0] for t in tables])) if tables else np.zeros(0, np.uint64)
        context = np.unique(merged >> np.uint64(16))
        p, g = np.zeros((len(merged), len(langs))), np.ones((len(context), len(langs)))
        for j, own in enumerate(tables):
            k, c = own[n - 1]
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            ctx, at = np.unique(k >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(at, weights=c), np.bincount(at)
            weight = discount * kinds / total
            g[:, j] = _find(ctx, context, weight, 1.0)
            lower = 1 / alphabet if n == 1 else _find(keys[-1], merged & np.uint64((1 << 16 * (n - 1)) - 1), below[:, j], 0.0)
            p[:, j] = _find(k, merged, (c - discount) / total[at], 0.0) + _find(ctx, merged >> np.uint64(16), weight, 1.0) * lower
        keys.append(merged)
        contexts.append(context)
        logp.append(np.log2(p).astype(np.float32))
        backoff.append(np.log2(g).astype(np.float32))
        below = p
    return Model(langs, keys, logp, contexts, backoff, -float(np.log2(alphabet)))


def in_training(doc_id: str = "doc_id"):
    """Whether a row may be learned from: crc32 of its id as text, modulo 5, is not 0.  Never for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 != 0, F.lit(False))


def _fold():
    """The second fold of a training row, by the same hash as ``in_training``."""
    return (F.floor(F.crc32(F.col("doc_id").cast("string")) / 5) % 2).cast("int")


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << 16 * order) - 1)


@dataclass
class Models(_Judge):
    """The languages' models in broadcast parts.

    A part has, by (model, language, order), sorted keys with their discounted
    share of the context's count, and sorted contexts with their back-off weight:
    P(key) = share + weight * P(key without its first symbol), where an unknown key
    has share 0 and an unknown context weight 1.
    """

    langs: list[str]
    shards: dict[int, list[Broadcast]] = field(default_factory=dict)  # by model: 0 and 1 have the same list
    known: frozenset[tuple[int, int]] = frozenset()  # (model, language) that learned anything
    alphabet: int = 1
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    per_symbol: np.ndarray | None = None

    def entropies(self, texts: list[str | None], model: int = WHOLE, langs: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol (texts x ``langs``, all if not given) and the number of symbols of each text."""
        langs = list(range(len(self.langs))) if langs is None else langs
        parts, owner = _stretches(texts)
        total, n = np.zeros((len(texts), len(langs))), np.zeros(len(texts), dtype=np.int64)
        for part in _pieces(parts, min(len(self.shards[model]), 8) << 20):
            bits, k = self._bits(parts[part], model, langs)
            np.add.at(total, owner[part], bits)
            np.add.at(n, owner[part], k)
        return total / np.maximum(n, 1)[:, None], n

    def _bits(self, texts: list[str], model: int, langs: list[int]) -> tuple[np.ndarray, np.ndarray]:
        grams, bounds = _grams(*symbols(texts))
        n = np.diff(bounds)
        full = np.flatnonzero(n)
        total = np.zeros((len(texts), len(langs)))
        if not len(full):
            return total, n
        distinct, at = np.unique(grams, return_inverse=True)
        keys = [np.unique(distinct & _mask(i)) for i in range(1, ORDER)] + [distinct]
        below = [np.zeros(len(keys[0]), dtype=np.int64)] + [np.searchsorted(keys[i - 1], keys[i] & _mask(i)) for i in range(1, ORDER)]
        contexts = [np.unique(k >> np.uint64(16), return_inverse=True) for k in keys]
        together = max(1, CELLS // len(distinct))
        for lo in range(0, len(langs), together):
            block = langs[lo:lo + together]
            for j, logs in zip(range(lo, lo + len(block)), self._logs(model, block, keys, below, contexts), strict=True):
                total[full, j] = -np.add.reduceat(logs[at], bounds[:-1][full])
        return total, n

    def _logs(self, model: int, langs: list[int], keys: list, below: list, contexts: list) -> Iterator[np.ndarray]:
        """The log2 probabilities of the highest-order ``keys`` in each of the languages."""
        share = [np.zeros((len(langs), len(k))) for k in keys]
        weight = [np.ones((len(langs), len(c))) for c, _ in contexts]
        for i, shard in enumerate(self.shards[model]):
            held = shard.value
            for j, lang in enumerate(langs):
                for order in range(ORDER):
                    if (model, lang, order + 1) in held:
                        have, values, known, weights = held[model, lang, order + 1]
                        where, hit = _places(have, keys[order])
                        share[order][j, hit] = values[where[hit]]
                        where, hit = _places(known, contexts[order][0])
                        weight[order][j, hit] = weights[where[hit]]
            del held
            if i >= LOADED and getattr(shard, "_path", None):
                vars(shard).pop("_value", None)  # read again from the task's disk when next needed
        for j in range(len(langs)):
            p = np.full(1, 1 / self.alphabet)
            for order in range(ORDER):
                p = share[order][j] + weight[order][j][contexts[order][1]] * p[below[order]]
            yield np.log2(p)


def _places(have: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``keys`` stand in the sorted ``have``, and which of them do."""
    at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
    return at, have[at] == keys


def order_counts(counts: DataFrame) -> DataFrame:
    """(model, lang, order, key, c) of all n-grams: counts at the highest order, distinct symbols before it below."""
    top = counts.selectExpr("lang", "4 AS order", "gram AS key", f"inline(array(struct({WHOLE} AS model, n0 + n1 AS c), struct(0 AS model, n1 AS c), struct(1 AS model, n0 AS c)))")
    tables = [top.where("c > 0").select("model", "lang", "order", "key", "c")]
    for order in range(ORDER - 1, 0, -1):
        key = F.col("key").bitwiseAND(F.lit((1 << 16 * order) - 1)).alias("key")
        own = tables[-1].groupBy("model", "lang", key).agg(F.count("*").alias("c")).select("model", "lang", F.lit(order).alias("order"), "key", "c")
        tables.append(stored(own, f"order{order}"))
    out = tables[0]
    for own in tables[1:]:
        out = out.unionByName(own)
    return out


def _shard(table: pa.Table, langs: list[str], discounts: dict) -> dict:
    """The arrays of ``Models`` of the rows (model, lang, order, key, c) of one part."""
    place = {x: i for i, x in enumerate(langs)}
    names = table.column("lang").combine_chunks().dictionary_encode()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    lang = np.array([place[x] for x in names.dictionary.to_pylist()], dtype=np.int64)[names.indices.to_numpy()]
    model, order, key, c = (table.column(x).to_numpy() for x in ("model", "order", "key", "c"))
    key = key.view(np.uint64)
    by = np.lexsort((key, order, lang, model))
    model, lang, order, key, c = model[by], lang[by], order[by], key[by], c[by].astype(np.float64)
    heads = np.flatnonzero(np.concatenate([[True], (np.diff(model) != 0) | (np.diff(lang) != 0) | (np.diff(order) != 0)])) if len(key) else np.zeros(0, np.int64)
    out = {}
    for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), len(key)], strict=True):
        name = int(model[lo]), int(lang[lo]), int(order[lo])
        context, at = np.unique(key[lo:hi] >> np.uint64(16), return_inverse=True)
        total, kinds = np.bincount(at, weights=c[lo:hi]), np.bincount(at)
        out[name] = (key[lo:hi].copy(), (c[lo:hi] - discounts[name]) / total[at], context, discounts[name] * kinds / total)
    return out


def train(docs: DataFrame) -> Models:
    """Models of every non-null lang of the training rows of ``docs``, with calibrated rejection."""
    spark = docs.sparkSession
    rows = docs.where(in_training() & F.col("lang").isNotNull()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), _fold().alias("fold"))
    table = order_counts(gram_counts(rows))
    shape = table.groupBy("model", "lang", "order").agg(
        F.count("*").alias("n"), F.sum((F.col("c") == 1).cast("long")).alias("ones"), F.sum((F.col("c") == 2).cast("long")).alias("twos")).collect()
    langs = sorted({r["lang"] for r in shape})
    if not langs:
        return Models([])
    place = {x: i for i, x in enumerate(langs)}
    discounts = {(r["model"], place[r["lang"]], r["order"]): r["ones"] / (r["ones"] + 2 * r["twos"]) if r["ones"] and r["twos"] else 0.5 for r in shape}
    alphabet = table.where(f"order = 1 AND model = {WHOLE}").agg(F.countDistinct("key")).first()[0] + 1
    size = -(-sum(r["n"] for r in shape if r["model"] == WHOLE) // SHARD_ROWS) | 1  # odd, so that every symbol of a context tells parts apart
    if size > 1:
        table = table.withColumn("shard", F.shiftrightunsigned("key", 16) % size)
        table = stored(table.repartition(size, "shard").sortWithinPartitions("shard"), "models")

    def parts(which: str) -> list[Broadcast]:
        own = (table.where(which).where(f"shard = {i}") if size > 1 else table.where(which) for i in range(size))
        return [spark.sparkContext.broadcast(_shard(x.select("model", "lang", "order", "key", "c").toArrow(), langs, discounts)) for x in own]

    halves = parts(f"model <> {WHOLE}")
    models = Models(langs, {0: halves, 1: halves, WHOLE: parts(f"model = {WHOLE}")}, frozenset((m, j) for m, j, _ in discounts), alphabet)
    calibrate(models, rows)
    for half in halves:
        half.destroy()
    return replace(models, shards={WHOLE: models.shards[WHOLE]})


def calibrate(models: Models, rows: DataFrame) -> None:
    """Centre, spread between texts and spread within a text of each language's cross-entropy on its own texts.

    Every training row (text, lang, fold) is measured by its language's model
    of the other fold.  The centre is the median of the texts of median length
    or more, the spread their deviation.  Languages of fewer than ``FEW`` measured
    texts have the largest spreads of the others where their own are smaller, and
    without any measured text the largest centre; no text is rejected as far off
    where no language has two measured texts.
    """
    place = {x: i for i, x in enumerate(models.langs)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.by_bytes(batches, 0, 4 << 20, 10_000):
            texts = np.array(batch.column(0).to_pylist(), dtype=object)
            langs = np.array([place[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            folds = batch.column(2).to_numpy()
            for j, fold in sorted(set(zip(langs.tolist(), folds.tolist(), strict=True))):
                if (fold, j) in models.known:
                    bits, n = models.entropies(texts[(langs == j) & (folds == fold)].tolist(), fold, [j])
                    use = n > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(use.sum(), j)), pa.array(n[use]), pa.array(bits[use, 0])], names=["j", "k", "e"])

    seen = stored(rows.select("text", "lang", "fold").mapInArrow(measure, "j long, k long, e double"), "entropies")
    middle = seen.groupBy("j").agg(F.percentile_approx("k", 0.5).alias("middle"))
    long = seen.join(F.broadcast(middle), "j").where("k >= middle").groupBy("j").agg(F.percentile_approx("e", 0.5).alias("centre"), F.stddev_pop("e").alias("spread"))
    # one row a language, of which the driver has a list: broadcast, so that no language's texts meet in one task
    found = seen.join(F.broadcast(long), "j").groupBy("j").agg(
        F.count("*").alias("n"), F.first("centre").alias("centre"), F.first("spread").alias("spread"),
        F.sqrt(F.avg((F.col("e") - F.col("centre")) ** 2 * F.col("k"))).alias("per_symbol")).collect()
    sound = [r for r in found if r["n"] >= FEW] or [r for r in found if r["n"] >= 2]
    if not sound:
        return
    size = len(models.langs)
    models.centre, models.spread, models.per_symbol = (np.full(size, max(r[x] for r in sound)) for x in ("centre", "spread", "per_symbol"))
    for r in found:
        j = r["j"]
        models.centre[j] = r["centre"]
        for values, x in ((models.spread, "spread"), (models.per_symbol, "per_symbol")):
            values[j] = r[x] if r["n"] >= FEW else max(r[x], values[j])


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected of every row.

    A null text or one without a letter is ``und`` with score 0 and rejected; so
    are all texts where no row can be learned from.  Ties go to the first
    language by name.  Rows with a null doc_id are held out; repeated rows are
    judged each; extra columns are not read; an empty table gives no rows.
    """
    model = train(docs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.by_bytes(batches, 2):
            found = model.judge(batch.column(2).to_pylist())
            columns = zip(*found, strict=True) if found else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True))],
                names=["doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~in_training()).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(judge, SCHEMA)


def without_rejected(docs: DataFrame) -> DataFrame:
    """The documents that the language models do not reject, all columns, judged where they are read."""
    model, docs_columns = train(docs), docs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in H.by_bytes(batches, len(docs_columns)):
            found = model.judge(batch.column(batch.num_columns - 1).to_pylist())
            held = batch.filter(pa.array([not r for *_, r in found], pa.bool_()))
            yield pa.RecordBatch.from_arrays(held.columns[:-1], schema=pa.schema(list(held.schema)[:-1]))

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("text").cast("string").alias(unused(docs, "text to judge"))).mapInArrow(kept, docs.schema)
