"""URL verdicts: rules by host and path prefix, else naive Bayes over segmented names.

Names such as ``cheappills`` are split into words by Viterbi over unigram
probabilities, counted on the hyphenated host names and path words of all URLs
and on a list of common words.  Multinomial naive Bayes over the words of host
and path then scores the URL.  Its labelled examples are the words of
``BLOCKED_WORDS`` and ``ORDINARY_WORDS``, one example each; the model of these
alone labels every URL of the table by its host, and the words of all URLs,
with their multiplicity, are counted under these labels.  A word that is in no
list thus counts as what it stands beside.  A URL's words weigh one together, so
that no long one outweighs the others.

The counts of all words are tables, joined to the names and to the URLs; no
vocabulary passes the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import stored

#: Letters of a lexicon word, at most; longer runs of unknown letters are split.
LONGEST_WORD = 24
#: Labelled words of the blocked topics and of ordinary names.
BLOCKED_WORDS = (
    "ads adult adware bet bets betting bingo casino cialis clickbait escort gambling gamble hack jackpot keygen lottery lotto malware nude payday phish "
    "pill pills poker porn roulette scam sex sexy slots spam spyware steroids sweepstakes tracker tracking viagra warez xxx").split()
ORDINARY_WORDS = (
    "about academy archive art article articles bank book books city college community company country daily design docs edu education "
    "family food forum garden gov guide health help history house info journal kids learn library life local magazine map "
    "market media museum music news north online park people photo post press public radio research review school science "
    "south sport sports store story student support team tech times today town travel university video weather west wiki work world").split()
#: Further words that the segmenter knows; they carry no label.
COMMON_WORDS = (
    "banner blog bonus buy cheap com coupon crack dating deal deals diet discount en example farm forex free home index loan loans mail net "
    "open org page pharma pharmacy pirate prize search shop site slot torrent track web webcam win winner www").split()
#: Weight of a listed word in the lexicon, of a labelled word as an example, and the share of blocked URLs assumed beforehand.
KNOWN, EXAMPLES, PRIOR = 1000, 3, 1 / 3
#: Weights and log odds are whole numbers of 2^-20, so that sums do not depend on their order.
_UNIT = 1 << 20
#: Size of a lexicon that is broadcast; salts of a join with a larger one.
BROADCAST_BYTES, _SALTS = 1 << 24, 16


# ---------------------------------------------------------------- parts and rules

def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host (A-Z lower-cased), path of every row; both empty for a null url or one without ``://``."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url")).withColumn("_rest", rest)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rows.select("page_id", F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), upper, lower).alias("host"),
                       F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1).alias("path"))


def first_rule(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of ``rules`` ((verdict, "host/path"), the earlier on ties) and its verdict; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for what, spelled in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = spelled.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        same = F.length(rule) == len(spelled)
        better = fits & ~F.coalesce(same, F.lit(False))
        rule, verdict = F.when(better, spelled).otherwise(rule), F.when(better, what).otherwise(verdict)
    return rule, verdict


# ---------------------------------------------------------------- words

def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``table`` (stored, one row a ``key``); rows whose key it lacks go.

    The table is broadcast where its rows, spelled out, take ``BROADCAST_BYTES`` or fewer.
    Beyond, both sides are shuffled, and a key is dealt to ``_SALTS`` tasks, as
    words such as ``www`` stand in most URLs.
    """
    if (table.agg(F.sum(F.length(F.to_json(F.struct(*table.columns))))).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), key)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(_SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))), [key, "_salt"]).drop("_salt")


def lexicon(parts: DataFrame) -> DataFrame:
    """(word, n): how often words stand in hyphenated host names and in paths, over all rows, and the listed words.

    Host names without a hyphen may be concatenations and are not counted as words.
    """
    names = F.split(F.lower(F.col("host")), r"\.")
    hyphenated = F.filter(names, lambda n: F.instr(n, "-") > 0)
    words = F.concat(F.flatten(F.transform(hyphenated, lambda n: F.split(n, "-"))), F.split(F.lower(F.col("path")), r"[^a-z]+"))
    each = parts.select(F.explode(words).alias("word"), F.lit(1).cast("long").alias("n")).where(f"word RLIKE '^[a-z]{{2,{LONGEST_WORD}}}$'")
    listed = sorted({*BLOCKED_WORDS, *ORDINARY_WORDS, *COMMON_WORDS})
    known = parts.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, listed))).alias("word"), F.lit(KNOWN).cast("long").alias("n"))
    return each.unionByName(known).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split of ``name`` by the ``counts`` of words, of ``total`` in all; an unknown word costs tenfold for each letter.

    Time and memory are linear in the name's length.  A number is the word ``0``.
    """
    if name.isdecimal():
        return ["0"]
    log_total = math.log(total)
    cost = {w: log_total - math.log(n) for w, n in counts.items()}
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        least, start = min((best[s] + cost.get(name[s:end], log_total + 2.3 * (end - s)), s) for s in range(max(0, end - LONGEST_WORD), end))
        best.append(least)
        back.append(start)
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, word) of every stretch of a name that may be a word, some 30,000 at a time."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(words, pa.string())], names=["key", "word"])

    keys: list[str] = []
    words: list[str] = []
    for rows in batches:
        for key, name in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            for first in range(0, len(name), 1000):
                found = {name[a:b] for a in range(first, min(first + 1000, len(name))) for b in range(a + 2, min(a + LONGEST_WORD, len(name)) + 1)}
                words += found
                keys += [key] * len(found)
                if len(words) >= 30_000:
                    yield batch()
                    keys, words = [], []
    if words:
        yield batch()


def _splits(total: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            names = rows.column(0).to_pylist()
            words = [best_split(name, {f["word"]: f["n"] for f in found or ()}, total) for name, found in zip(names, rows.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])
    return split


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words) of distinct ``names`` by a stored lexicon (word, n), stored: each name meets the lexicon words that stand in it."""
    total = words.agg(F.sum("n")).first()[0]
    # the pieces of a long name carry its hash instead; names hold letters and digits only
    keyed = names.select(F.when(F.length("name") > 64, F.concat(F.lit("#"), F.sha2("name", 256))).otherwise(F.col("name")).alias("key"), "name")
    pieces = keyed.where("name RLIKE '[a-z]{2}'").mapInArrow(_pieces, "key string, word string").where("word RLIKE '^[a-z]+$'")
    found = looked_up(pieces, words, "word").groupBy("key").agg(F.collect_set(F.struct("word", "n")).alias("found"))
    return stored(keyed.join(found, "key", "left").select("name", "found").mapInArrow(_splits(total), "name string, words array<string>"), "names")


def url_words(parts: DataFrame) -> DataFrame:
    """(host, path, n, own, rest) of every distinct URL of ``parts``, stored: its rows and the words of host and path in order.

    The last label of a host that has several is left out.
    """
    urls = stored(parts.groupBy("host", "path").agg(F.count("*").alias("n")), "urls")
    labels = F.when(F.instr("host", ".") > 0, F.regexp_extract("host", r"(?s)^(.*)\.", 1)).otherwise(F.col("host"))
    number = lambda name: F.when(name.rlike(r"^\p{Nd}+$"), "0").otherwise(name)
    runs = lambda c: F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{Nd}]+"), F.lit(0)), number)
    placed = lambda c, own: F.transform(runs(c), lambda name, i: F.struct(F.lit(own).alias("own"), i.alias("place"), name.alias("name")))
    each = urls.select("host", "path", F.explode(F.concat(placed(labels, True), placed(F.col("path"), False))).alias("c")).select("host", "path", "c.*")
    names = segmented(each.select("name").distinct(), stored(lexicon(parts), "lexicon"))
    words = looked_up(each, names, "name").groupBy("host", "path").agg(F.array_sort(F.collect_list(F.struct("own", "place", "words"))).alias("all"))
    of = lambda own: F.flatten(F.transform(F.filter("all", lambda c: c["own"] == own), lambda c: c["words"]))
    # rows whose URL has no name are left out by the inner join of `each` and come back here
    return stored(urls.join(words, ["host", "path"], "left").select(
        "host", "path", "n", *[F.coalesce(of(own), F.array().cast("array<string>")).alias(c) for own, c in ((True, "own"), (False, "rest"))]), "url-words")


# ---------------------------------------------------------------- naive Bayes

def log_odds(blocked: Column, allowed: Column, all_blocked: Column, all_allowed: Column) -> Column:
    """Log odds of a word by its counts in the blocked and the allowed examples and those examples' sizes.

    A word's rate in a class, relative to its rate in all examples, has a Gamma(1, 1)
    prior, so that a rare word tells little and one as frequent in both nothing.
    """
    share = (blocked + allowed) / (all_blocked + all_allowed)
    return F.log((blocked + 1) / (all_blocked * share + 1)) - F.log((allowed + 1) / (all_allowed * share + 1))


def example_odds() -> dict[str, float]:
    """Log odds of the labelled words alone."""
    sizes = [EXAMPLES * len(BLOCKED_WORDS), EXAMPLES * len(ORDINARY_WORDS)]
    odds = []
    for counts in ((EXAMPLES, 0), (0, EXAMPLES)):
        share = EXAMPLES / sum(sizes)
        odds.append(math.log((counts[0] + 1) / (sizes[0] * share + 1)) - math.log((counts[1] + 1) / (sizes[1] * share + 1)))
    return {**dict.fromkeys(BLOCKED_WORDS, odds[0]), **dict.fromkeys(ORDINARY_WORDS, odds[1])}


def _whole(x: Column) -> Column:
    return F.round(x * _UNIT).cast("long")


def word_odds(urls: DataFrame) -> DataFrame:
    """(word, odds) of every word of ``urls``, stored; odds are whole numbers of 2^-20.

    The labelled words alone judge each URL by its host; the words of all URLs,
    with their multiplicity, are counted under these labels.
    """
    known = F.create_map(*[F.lit(x) for w, o in sorted(example_odds().items()) for x in (w, round(o * _UNIT))])
    seen = lambda w: F.coalesce(F.element_at(known, w), F.lit(0)).cast("long")
    label = F.aggregate("own", F.lit(_prior()).cast("long"), lambda s, w: s + seen(w)) > 0
    words = F.concat("own", "rest")
    weight = F.expr(f"n * {_UNIT} div greatest(size(own) + size(rest), 1)")
    each = urls.select(label.alias("bad"), weight.alias("weight"), F.explode(words).alias("word"))
    sums = lambda df: df.agg(*[F.coalesce(F.sum(F.when(F.col("bad") == bad, F.col("weight"))), F.lit(0)).alias(c) for bad, c in ((True, "b"), (False, "a"))])
    counts = stored(sums(each.groupBy("word")), "word-counts")
    all_blocked, all_allowed = counts.agg(F.sum("b"), F.sum("a")).first()
    odds = log_odds(F.col("b") / _UNIT, F.col("a") / _UNIT, F.lit((all_blocked or 0) / _UNIT), F.lit((all_allowed or 0) / _UNIT))
    return stored(counts.select("word", (_whole(odds) + seen(F.col("word"))).alias("odds")), "word-odds")


def _prior() -> int:
    return round(math.log(PRIOR / (1 - PRIOR)) * _UNIT)


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, words, score of every row.

    ``verdict`` is the rule's, else ``block`` where the model's log odds are
    above 0.  A url without words is allowed, its score null.  Repeated rows are
    judged each and count each, a null page_id stays null, extra columns are not
    read, an empty table gives no rows.  A name of any length is split.
    """
    parts = with_parts(pages)
    urls = url_words(parts)
    each = urls.select("host", "path", F.explode(F.concat("own", "rest")).alias("word"))
    sums = looked_up(each, word_odds(urls), "word").groupBy("host", "path").agg(F.sum("odds").alias("sum"))
    score = ((F.col("sum") + _prior()) / _UNIT).alias("score")
    scores = urls.join(sums, ["host", "path"], "left").select("host", "path", F.array_join(F.concat("own", "rest"), " ").alias("words"), score)
    rule, verdict = first_rule(rules)
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return parts.join(scores, ["host", "path"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "words", "score")
