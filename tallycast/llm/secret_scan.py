"""Secret scan: three fixed patterns and a randomness test battery, in DataFrame expressions only.

The patterns find assignments of secrets, access keys and long hexadecimal runs.
The battery judges every other long run of token characters: its encoding is
inferred (hexadecimal, base32, base36, base64, letters of both cases, letters of
one case, digits), and three tests ask whether its
characters look drawn at random from that alphabet: chi-squared uniformity,
runs above and below the alphabet's middle, lag-1 serial correlation.  Fisher's
method joins their p-values.  Random tokens have uniform p-values, others have
them near 0, so in each class of encoding and length the share of p-values over
one half estimates how many are random (Storey), and with it the share of false
discoveries over any threshold.  A class reports what lies over the lowest
threshold that keeps this share at or under ``FALSE_SHARE``; short tokens, on
which the tests have little power, thus need stronger evidence.  A class of fewer
than ``SPARSE`` tokens takes the estimate of a pool: the neighbouring lengths,
ever more of them, up to the whole encoding.  Where that has too few p-values
over one half as well, each token is judged alone, by p over ``ALONE``, but for
those of letters or digits alone: long words and numbers are common, and nothing
but such an estimate tells them from secrets.

Words keep p-values over one half where the tests have little power, and fewer the
higher; so the estimate is no more than what the p-values over 0.7 and 0.9 allow.
Tokens of fewer than 20 characters are not judged, nor letters of one case under
32 and of both under 24: of joined English words of those lengths 0.6 and 0.4 percent
have a p-value over 0.2 (of random tokens 80), of 20 letters of one case 22 percent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import stored

#: The three patterns, in the order in which kinds are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

#: A token may stand directly after ``=`` (env files, query strings); ``=`` after it is padding and not part of it.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])"
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "case": "abcdefghijklmnopqrstuvwxyz",
    "digits": "0123456789",
}
#: Encodings whose two cases are one symbol, and those of words and numbers.
FOLDED, PLAIN = ("hex", "base36", "case"), ("letters", "case", "digits")
THRESHOLDS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)
#: P-values over these must not be fewer than random tokens would have.
CHECKS = (0.7, 0.9)
#: Characters from which an encoding is judged, where not from 20.
LEAST = {"case": 32, "letters": 24}
FALSE_SHARE = 0.05
#: Classes of fewer tokens are judged by a pool of their encoding; a pool needs so many p-values over one half.
SPARSE, POOL_OVER = 20, 5
#: Where even the whole encoding has fewer, a token is reported by its own p-value: 95 percent of random tokens have more.
ALONE = 0.05
SECRET = "[SECRET]"
_BLOCK = 256


def _running(lengths: Column) -> Column:
    """What stands before each element of an array of longs, by blocks so that long arrays stay cheap."""
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    last = F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(lengths, b * _BLOCK + 1, _BLOCK))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda s, x: s + x))
    starts = F.aggregate(totals, F.array(F.lit(0).cast("long")), add)
    inner = F.transform(blocks, lambda b, i: F.slice(F.aggregate(b, F.array(F.get(starts, i)), add), 1, F.size(b)))
    return F.when(F.size(lengths) > 0, F.flatten(inner)).otherwise(F.array().cast("array<long>"))


def _with_matches(df: DataFrame, text: str, name: str, pattern: str) -> DataFrame:
    """Add ``name``: array of (start, end, token) of the leftmost non-overlapping matches, in code points."""
    t, p = F.col(text), F.lit(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(t.rlike(pattern), F.regexp_extract_all(t, p, F.lit(0))).otherwise(none))
    gaps = F.transform(F.split(t, pattern, -1), lambda x: F.length(x).cast("long"))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.slice(gaps, 1, F.size("_m"))).otherwise(F.array().cast("array<long>")))
    df = df.withColumn("_s", F.zip_with("_g", "_m", lambda g, m: g + F.length(m)))
    df = df.withColumn("_b", _running(F.col("_s")))
    start = lambda i: F.get(F.col("_b"), i) + F.get(F.col("_g"), i)
    spans = F.transform("_m", lambda m, i: F.struct(start(i).alias("start"), (start(i) + F.length(m)).alias("end"), m.alias("token")))
    return df.withColumn(name, spans).drop("_m", "_g", "_s", "_b")


def _tail(z: Column) -> Column:
    """The upper tail of the normal distribution, by a logistic approximation (error below 2e-4)."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return F.greatest(1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z)), F.lit(1e-12))


def _encoding(token: Column) -> Column:
    digit, letter = token.rlike("[0-9]"), token.rlike("[A-Za-z]")
    mixed = token.rlike("[a-z]") & token.rlike("[A-Z]")
    return (F.when(digit & letter & token.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), "hex")
            .when(digit & letter & token.rlike("^[A-Z2-7]+$"), "base32")
            .when(digit & letter & token.rlike("^[0-9a-z]+$|^[0-9A-Z]+$"), "base36")
            .when(token.rlike("^[a-z]+$|^[A-Z]+$"), F.when(F.length(token) >= LEAST["case"], "case"))
            .when(token.rlike("^[0-9]+$"), "digits")
            .when(mixed & token.rlike("^[A-Za-z]+$"), F.when(F.length(token) >= LEAST["letters"], "letters"))
            .when(mixed, "base64"))


def _with_battery(df: DataFrame, name: str) -> DataFrame:
    """Replace the (start, end, token) array ``name`` by (start, end, class, p) of the tokens with an encoding.

    Each step is one ``transform`` so that no value is worked out twice.
    """
    step = lambda f: df.withColumn(name, F.transform(name, f))
    carry = lambda c, *names: [c[n].alias(n) for n in names]
    df = step(lambda c: F.struct(*carry(c, "start", "end", "token"), _encoding(c["token"]).alias("enc")))
    df = df.withColumn(name, F.filter(name, lambda c: c["enc"].isNotNull()))
    alphabet = lambda e: F.element_at(F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair]), e)
    plain = lambda c: F.when(c["enc"].isin(*FOLDED), F.lower(c["token"])).otherwise(c["token"])
    df = step(lambda c: F.struct(*carry(c, "start", "end", "enc"), alphabet(c["enc"]).alias("abc"), F.split(plain(c), "").alias("ch")))
    # - and _ are the URL-safe spellings of + and /: the same two symbols
    df = step(lambda c: F.struct(*carry(c, "start", "end", "enc"), F.transform(c["ch"], lambda x: F.pmod(
        F.instr(c["abc"], x) - F.when((c["enc"] == "base64") & (F.instr(c["abc"], x) > 64), 3).otherwise(1), F.lit(64)).cast("double")).alias("x")))
    size = lambda e: F.element_at(F.create_map(*[F.lit(x) for k, v in ALPHABETS.items() for x in (k, float(min(len(v), 64)))]), e)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    df = step(lambda c: F.struct(
        *carry(c, "start", "end", "enc", "x"), size(c["enc"]).alias("a"), F.size(c["x"]).cast("double").alias("n"),
        (total(c["x"]) / F.size(c["x"])).alias("mean"),
        total(F.transform(F.array_distinct(c["x"]), lambda d: F.pow(F.size(F.filter(c["x"], lambda y: y == d)).cast("double"), F.lit(2.0)))).alias("squares")))
    df = step(lambda c: F.struct(
        *carry(c, "start", "end", "enc", "a", "n", "squares"),
        F.transform(c["x"], lambda v: v - c["mean"]).alias("d"),
        F.transform(c["x"], lambda v: F.when(v >= c["a"] / 2, 1.0).otherwise(0.0)).alias("up")))
    lagged = lambda a: F.slice(a, F.lit(2), F.size(a) - 1)
    heads = lambda a: F.slice(a, F.lit(1), F.size(a) - 1)
    df = step(lambda c: F.struct(
        *carry(c, "start", "end", "enc", "a", "n", "squares"), total(c["up"]).alias("n1"),
        (1 + total(F.zip_with(heads(c["up"]), lagged(c["up"]), lambda u, v: F.abs(u - v)))).alias("runs"),
        total(F.zip_with(heads(c["d"]), lagged(c["d"]), lambda u, v: u * v)).alias("cross"),
        total(F.transform(c["d"], lambda v: v * v)).alias("power")))
    expected = lambda c: 2 * c["n1"] * (c["n"] - c["n1"]) / c["n"] + 1
    df = step(lambda c: F.struct(
        *carry(c, "start", "end", "enc", "n"),
        ((c["a"] / c["n"] * c["squares"] - c["n"] - (c["a"] - 1)) / F.sqrt(2 * (c["a"] - 1) * (c["n"] - 1) / c["n"])).alias("chi"),
        F.when((c["n1"] > 1) & (c["n1"] < c["n"] - 1), (c["runs"] - expected(c)) / F.sqrt((expected(c) - 1) * (expected(c) - 2) / (c["n"] - 1))).otherwise(8.0).alias("run"),
        F.when(c["power"] > 0, (c["cross"] / c["power"] + 1 / c["n"]) * F.sqrt(c["n"])).otherwise(8.0).alias("serial")))
    df = step(lambda c: F.struct(
        *carry(c, "start", "end", "enc", "n"),
        (-F.log(_tail(c["chi"])) - F.log(2 * _tail(F.abs(c["run"]))) - F.log(2 * _tail(F.abs(c["serial"])))).alias("h")))
    band = lambda n: F.least(F.floor(F.log2(n / 20.0) * 2), F.lit(12)).cast("string")
    return step(lambda c: F.struct(
        *carry(c, "start", "end"), F.concat_ws(".", c["enc"], band(c["n"])).alias("class"),
        F.least(F.exp(-c["h"]) * (1 + c["h"] + c["h"] * c["h"] / 2), F.lit(1.0)).alias("p")))


def _numbered(spans: Column | str, kind: int) -> Column:
    return F.transform(spans, lambda c: F.struct(c["start"].alias("start"), F.lit(kind).alias("kind"), c["end"].alias("end")))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` (start, kind's number, end) and ``tokens`` (start, end, class, p) of its column ``_t``."""
    df = _with_matches(docs, "_t", "_a", ASSIGN)
    df = df.withColumn("_a", F.filter("_a", lambda c: F.length(F.regexp_extract(c["token"], ASSIGN, 2)) >= 8))
    df = _with_matches(df, "_t", "_k", ACCESS)
    df = df.withColumn("_k", F.filter("_k", lambda c: F.length(c["token"]) >= 16))
    df = _with_matches(df, "_t", "_h", HEX)
    df = df.withColumn("base", F.array_sort(F.concat(*[_numbered(x, i) for i, x in enumerate(("_a", "_k", "_h"))]))).drop("_a", "_k", "_h")
    df = _with_matches(df, "_t", "tokens", TOKEN)
    inside = lambda c: F.exists("base", lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"]))
    return _with_battery(df.withColumn("tokens", F.filter("tokens", lambda c: ~inside(c))), "tokens")


def _lowest(over: list[int]) -> float | None:
    """The lowest threshold whose estimated share of false discoveries is small enough; ``over`` counts the p-values over each and over CHECKS.

    The number of random tokens is estimated over one half, and is at most what
    the counts over CHECKS, three standard deviations and 2 added, amount to.
    """
    random = over[THRESHOLDS.index(0.5)] / 0.5
    for t, n in zip(CHECKS, over[len(THRESHOLDS):], strict=True):
        random = min(random, (n + 3 * (n + 1) ** 0.5 + 2) / (1 - t))
    for t, n in zip(THRESHOLDS, over[:len(THRESHOLDS)], strict=True):
        if n and 1 - min(1.0, random * (1 - t) / n) <= FALSE_SHARE:
            return t
    return None


def _pool(counts: dict[tuple[str, int], list[int]], enc: str, band: int) -> list[int] | None:
    """Counts over each threshold of the narrowest lengths around ``band`` with enough p-values over one half, if any has."""
    own = {b: over for (e, b), over in counts.items() if e == enc}
    for reach in range(max(abs(b - band) for b in own) + 1):
        pool = [sum(n) for n in zip(*(over for b, over in own.items() if abs(b - band) <= reach), strict=True)]
        if pool[THRESHOLDS.index(0.5)] >= POOL_OVER:
            return pool
    return None


def thresholds(tokens: DataFrame) -> dict[str, float]:
    """The p-value over which each class of ``tokens`` (class, p) reports; a class is one of 7 x 13, whatever the input."""
    over = [F.sum((F.col("p") > t).cast("long")).alias(f"n{i}") for i, t in enumerate((*THRESHOLDS, *CHECKS))]
    rows = tokens.groupBy("class").agg(F.count("*").alias("n"), *over).collect()
    name = lambda row: (row["class"].split(".")[0], int(row["class"].split(".")[1]))
    counts = {name(row): [row[f"n{i}"] for i in range(len(THRESHOLDS) + len(CHECKS))] for row in rows}
    found = {}
    for row in rows:
        if row["n"] >= SPARSE:
            least = _lowest(counts[name(row)])
        else:
            pool = _pool(counts, *name(row))
            alone = None if name(row)[0] in PLAIN else ALONE
            least = alone if pool is None else _lowest(pool)
        if least is not None:
            found[row["class"]] = least
    return found


def _reported(found: dict[str, float]) -> Column:
    """The token spans that their class reports, as (start, kind's number, end)."""
    least = F.create_map(*[F.lit(x) for pair in found.items() for x in pair]) if found else F.lit(None).cast("map<string,double>")
    kept = F.filter("tokens", lambda c: F.coalesce(c["p"] > F.element_at(least, c["class"]), F.lit(False)))
    return _numbered(kept, 3)


def _spelled(spans: Column) -> Column:
    kind = lambda c: F.get(F.array(*[F.lit(k) for k in KINDS]), c["kind"])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", kind(c), c["start"].cast("string"), c["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of start, kind's number in KINDS, end) of every row.

    Offsets are code points, ends exclusive, ordered by start and then kind.
    Null or empty texts have no spans; repeated rows are scanned each; a null
    doc_id stays null; extra columns are not read; an empty table gives no rows.
    One scan of the texts; the classes' thresholds come from its stored result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    rows = stored(candidates(texts).select("doc_id", "base", "tokens"), "spans")
    found = thresholds(rows.select(F.explode("tokens").alias("c")).select("c.class", "c.p"))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", _reported(found))).alias("spans"))


def report(scanned: DataFrame) -> DataFrame:
    """The digest columns of ``scan``'s rows."""
    count = lambda k: F.size(F.filter("base", lambda c: c["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(_spelled(F.col("base")), 256).alias("base_sha256"), _spelled(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents, all columns, each secret span (overlaps joined) replaced by ``[SECRET]``; n_chars follows the text.

    The texts are scanned twice, for the thresholds and for the spans, and never
    shuffled.  Texts without a span, null ones too, stay as they are.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
    seen = stored(candidates(whole.select("_t")).select(F.explode("tokens").alias("c")).select("c.class", "c.p"), "tokens")
    df = candidates(whole).withColumn("_all", F.array_sort(F.concat("base", _reported(thresholds(seen)))))
    piece = lambda at, n: F.substring(F.col("_t"), (at + 1).cast("int"), n.cast("int"))
    clear = F.aggregate(
        "_all", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, c: F.struct(
            F.when(c["start"] >= acc["at"], F.concat(acc["out"], piece(acc["at"], c["start"] - acc["at"]), F.lit(SECRET))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], c["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], piece(acc["at"], F.length("_t"))))
    df = df.withColumn("_new", F.when(F.size("_all") > 0, clear)).select("_row", "_new")
    after = {"text": F.coalesce("_new", "_row.text")}
    if "n_chars" in docs.columns:
        after["n_chars"] = F.when(F.col("_new").isNotNull(), F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return df.select(*[after.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
