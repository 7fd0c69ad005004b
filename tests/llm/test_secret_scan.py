import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from tallycast.llm import secret_scan as S


def base(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(m.start(), 0, m.end())] * (len(m[2]) >= 8)
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def spelled(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check(df):
    rows = S.report(S.scan(df)).collect()
    want = sorted(((r.doc_id, hashlib.sha256(spelled(base(r.text or "")).encode()).hexdigest(), *(sum(x[1] == k for x in base(r.text or "")) for k in range(3))) for r in df.collect()), key=str)
    assert sorted(((r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in rows), key=str) == want
    return rows


def test_patterns(spark, documents, hard, none):
    rng = random.Random(4)
    pieces = ["password", "PassWd = ", "token: ", "api_key='", "APIKEY=", "secret", '"', " ", ":", "=", "abcdefgh", "a.b=c-d_e", "AKIA", "AKIAABCDEFGH1234", "AKIAAKIA12345678", "é😀",
              "0123456789abcdef", "0123456789abcdef0123456789abcdef", "\n", "password: token: abcdefgh"]
    texts = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 30)))) for i in range(300)] + [(999, "token=abcdefghi " * 3_000)]
    check(spark.createDataFrame(texts, "doc_id long, text string"))
    check(documents)
    check(hard)
    assert S.scan(none).collect() == [] and S.redacted(none).collect() == []


def test_battery_tells_random_tokens(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        n = rng.choice((24, 32, 40, 64))
        token = ("".join(rng.choices(string.ascii_letters + string.digits + "+/", k=n)) if i % 3 == 0 else
                 ("Users/Alice2/projects/module_%d/src/Main" % i + "/common" * 3) if i % 3 == 1 else ("ABC123abc" * 10)[:n])
        rows.append((i, f"😀 see {token} and {token}."))
    found = {r.doc_id: r.spans for r in S.report(S.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert sum(bool(found[i]) for i in range(0, 300, 3)) >= 75
    assert not any(found[i] for i in range(300) if i % 3)
    text = dict(rows)
    for i in range(0, 300, 3):
        for kind, a, b in (x.split(":") for x in found[i].split(",") if x):
            assert kind == "random" and text[i][int(a):int(b)] in text[i].split()[2]


def battery(token, encoding):
    """The p-value of a token in plain Python."""
    import math
    x = [S.ALPHABETS[encoding].index(c) for c in (token.lower() if encoding in S.FOLDED else token)]
    n, a, mean = len(x), min(64, len(S.ALPHABETS[encoding])), sum(x) / len(x)
    chi = (a / n * sum(x.count(v) ** 2 for v in set(x)) - n - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n)
    up = [v >= a / 2 for v in x]
    n1, runs = sum(up), 1 + sum(p != q for p, q in zip(up, up[1:]))
    e = 2 * n1 * (n - n1) / n + 1
    run = (runs - e) / math.sqrt((e - 1) * (e - 2) / (n - 1)) if 1 < n1 < n - 1 else 8.0
    d = [v - mean for v in x]
    serial = (sum(p * q for p, q in zip(d, d[1:])) / sum(v * v for v in d) + 1 / n) * math.sqrt(n)
    tail = lambda z: max(math.erfc(z / math.sqrt(2)) / 2, 1e-12)
    h = -math.log(tail(chi)) - math.log(2 * tail(abs(run))) - math.log(2 * tail(abs(serial)))
    return math.exp(-h) * (1 + h + h * h / 2)


DRAWN = {"hex": "0123456789ABCDEF", "base32": S.ALPHABETS["base32"], "base36": S.ALPHABETS["base36"], "base64": S.ALPHABETS["base64"][:64],
         "letters": string.ascii_letters, "case": string.ascii_lowercase, "digits": string.digits}


def test_statistics(spark):
    """Encoding and p-value of random tokens against plain Python."""
    rng = random.Random(6)
    rows = [(f"{e}", "".join(rng.choices(abc, k=n))) for e, abc in DRAWN.items() for n in (20, 24, 40, 200) if n >= S.LEAST.get(e, 20) for _ in range(8)]
    df = S._with_battery(S._with_matches(spark.createDataFrame(rows, "e string, _t string"), "_t", "tokens", S.TOKEN), "tokens")
    got = df.select("e", "_t", F.explode("tokens").alias("c")).select("e", "_t", "c.*").collect()
    same = 0
    for r in got:
        encoding = r["class"].split(".")[0]
        assert (r.start, r.end) == (0, len(r._t)) and abs(r.p - battery(r._t, encoding)) < 0.01
        same += encoding == r.e
    assert len(got) >= 0.95 * len(rows) and same >= 0.9 * len(rows)  # by chance some show fewer kinds of characters


def test_recall_and_false_reports_by_alphabet(spark):
    """Random tokens of every alphabet and length among as many that are words, paths and numbers."""
    rng = random.Random(7)
    words = ("international", "government", "because", "understanding", "machine", "people", "information", "between", "relation", "settings", "another", "the", "temperature", "sentence")
    rows = []
    for e, abc in DRAWN.items():
        for n in (20, 24, 40):
            for i in range(100):
                rows.append((len(rows), e, n, True, "".join(rng.choices(abc, k=n))))
                some = [rng.choice(words) for _ in range(n)]
                plain = "".join(w.title() if e in ("letters", "base64") else w for w in some)[:n]
                plain = {"digits": f"{rng.randint(0, 99):02d}" + f"{rng.randint(0, 9)}0000" * 10, "hex": ("DEAD0000BEEF" * 5)[i % 7:], "base32": "".join(some).upper()[:n - 1] + "2",
                         "base36": plain[:-1] + "1"}.get(e, plain)[:n]
                rows.append((len(rows), e, n, False, plain))
    df = spark.createDataFrame([(r[0], "see " + r[4] + " .") for r in rows], "doc_id long, text string")
    found = {r.doc_id for r in S.report(S.scan(df)).collect() if "random" in r.spans}
    for e in DRAWN:
        for n in (20, 24, 40):
            hits, false = (sum(r[0] in found for r in rows if r[1] == e and r[2] == n and r[3] == random_) for random_ in (True, False))
            if n < S.LEAST.get(e, 20):
                assert hits + false <= 5  # some drawn letters of one case have no digit, or the reverse
            elif (e, n) == ("digits", 40):
                assert hits == false == 0  # 32 digits and more are found by the hexadecimal pattern
            elif n == 40:
                assert hits >= 75 and false <= 0.05 * hits
            else:  # little power: words among them are told from random less well
                assert hits >= 40 and false <= 0.5 * hits


def test_words_alone_are_not_reported(spark):
    """P-values that fall off towards one are no sign of random tokens, however many exceed one half."""
    rng = random.Random(10)
    falling = [("case.2", rng.betavariate(0.4, 3)) for _ in range(5_000)]
    level = [("hex.2", rng.random()) for _ in range(5_000)]
    assert set(S.thresholds(spark.createDataFrame(falling + level, "class string, p double"))) == {"hex.2"}
    assert S.thresholds(spark.createDataFrame([("case.2", 0.4), ("letters.3", 0.4), ("digits.1", 0.4)], "class string, p double")) == {}


def test_redaction(spark, hard, documents):
    for df in (hard, documents):
        after = S.redacted(df)
        assert after.columns == df.columns
        spans = {}
        for r in S.scan(df).collect():
            spans.setdefault(r.doc_id, []).append([(s.start, s.end) for s in r.spans])
        for r in after.collect():
            assert r.text is None or S.report(S.scan(spark.createDataFrame([(1, r.text)], "doc_id long, text string"))).first().n_hex == 0 or r.doc_id not in spans
            break
    texts = [(1, "a token=abcdefgh1 b " + "0123456789abcdef" * 2 + " c", 0), (2, None, None), (3, "clean", 5), (4, "password: " + "0123456789abcdef" * 3, 58)]
    got = {r.doc_id: (r.text, r.n_chars) for r in S.redacted(spark.createDataFrame(texts, "doc_id long, text string, n_chars int")).collect()}
    assert got == {1: ("a [SECRET] b [SECRET] c", 23), 2: (None, None), 3: ("clean", 5), 4: ("[SECRET]", 8)}


def test_no_python_in_the_plan(documents):
    plan = S.report(S.scan(documents))._jdf.queryExecution().executedPlan().toString() + S.candidates(documents.withColumn("_t", F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_tokens_after_an_equals_sign(spark):
    rng = random.Random(8)
    values = ["".join(rng.choices(string.ascii_letters + string.digits, k=40)) for _ in range(100)]
    forms = ("AWS_SECRET_ACCESS_KEY={}", "https://x.org/a?sig={}", "k={}==", "export KEY= {}")
    rows = [(i, "see " + forms[i % 4].format(v)) for i, v in enumerate(values)]
    text, found = dict(rows), {r.doc_id: r.spans for r in S.report(S.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for k in range(4):
        hits = [i for i in range(k, 100, 4) if any(text[i][int(a):int(b)] == values[i] for kind, a, b in (x.split(":") for x in found[i].split(",") if x) if kind == "random")]
        assert len(hits) >= 20, forms[k]


def test_lone_tokens_of_sparse_classes(spark):
    def of(rows):
        return S.thresholds(spark.createDataFrame(rows, "class string, p double"))

    assert of([("base64.6", 0.3)]) == {"base64.6": S.ALONE}  # the only token of its encoding
    many = [("hex.2", i / 100) for i in range(1, 100)]
    alone = of(many)
    assert of([*many, ("hex.3", 0.4), ("hex.9", 0.4)]) == {"hex.2": alone["hex.2"], "hex.3": alone["hex.2"], "hex.9": alone["hex.2"]}  # pooled
    none = [("base36.1", 1e-9)] * 50
    assert of([*none, ("base36.4", 0.4)]) == {"base36.4": S.ALONE}  # the pool has nothing to estimate from, the full class reports nothing
    token = "".join(random.Random(9).choices(string.ascii_letters + string.digits, k=200))
    spans = S.report(S.scan(spark.createDataFrame([(1, f"x {token} y")], "doc_id long, text string"))).first().spans
    assert spans == "random:2:202"
