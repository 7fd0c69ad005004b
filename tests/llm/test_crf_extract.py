import html
import re

from tallycast.llm import crf_extract as C


def article(page):
    """The article of a page of the test tables, by its tags."""
    inner = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1])
    parts = (" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(filter(None, parts))


def test_articles_of_the_table(pages):
    truth = {r.page_id: article(r.html) for r in pages.collect()}
    got = C.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == truth and all(r.n_chars == len(r.text) for r in got)


def test_held_out_templates():
    field = C.fit([(C.features(b), y) for b, y in C.labelled_template_pages(C.TEMPLATE_PAGES)])
    wrong = total = 0
    for found, labels in C.labelled_template_pages(150, seed=77):
        wrong += sum(a != b for a, b in zip(field.decode(C.features(found)), labels, strict=True))
        total += len(labels)
    assert wrong < 0.02 * total


def test_viterbi_and_marginals_against_enumeration():
    import itertools

    import numpy as np
    rng = np.random.default_rng(4)
    field = C.Field(rng.normal(size=(C.SLOTS, 2)), rng.normal(size=(2, 2)))
    slots = [[1, 5], [2], [3, 9, 11], [4]]
    s = field.scores(slots)
    value = {y: sum(s[i, v] for i, v in enumerate(y)) + sum(field.step[a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=4)}
    assert tuple(field.decode(slots)) == max(value, key=value.get)
    total = sum(np.exp(v) for v in value.values())
    p, moves = C._marginals(s, field.step)
    assert np.allclose(p[2, 1], sum(np.exp(v) for y, v in value.items() if y[2]) / total)
    assert np.allclose(moves[0, 1], sum(np.exp(v) * sum(z == (0, 1) for z in zip(y, y[1:])) for y, v in value.items()) / total)


def test_blocks():
    text = [b.text for b in C.blocks("<p>a&nbsp;b &amp;&lt;x\n<br>c<p>d<script>if(a<b){'</p>'}</script><!-- <p>no --><ul><li>e<li>f</ul>g <b>h</b>i<p cla")]
    assert text == ["a b &<x c", "d", "e", "f", "g hi"]
    nested = C.blocks("<div class='postBody x-y' id=main><p><b>q<p>r</div><p>s")
    assert [(b.text, b.tags, b.names) for b in nested] == [("q", ("div", "p"), ("post", "body", "x", "y", "main")), ("r", ("div", "p"), ("post", "body", "x", "y", "main")), ("s", ("p",), ())]


def test_nothing_but_the_listed_parts_is_dropped(spark):
    inside = "where <math><mi>x</mi><mo>=</mo></math> is <object>fallback text</object> or <svg><text>drawn</text></svg> <noscript>plain</noscript>, as written."
    html = f"<html><body><nav><a href=/a>Home</a></nav><article><p>{inside}</p><xmp>code sample</xmp><p>Then more text follows here.</p></article></body></html>"
    (got,) = C.extract(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).collect()
    assert got.text == "where x= is fallback text or drawn plain, as written.\n\ncode sample\n\nThen more text follows here."


def test_features_are_of_the_whole_block():
    long = "plain words of a notice " * 40
    (plain,), (cued,) = C.blocks(f"<p>{long}</p>"), C.blocks(f"<p>{long} accept all cookies, 2024</p>")
    assert C._slot("cue=cookie") in C.features([cued])[0] and C._slot("cue=cookie") not in C.features([plain])[0]
    assert C._slot("commas=1") in C.features([cued])[0]


def test_hard_pages(spark, none):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>one</p></article>"), (3, "v", "<nav><a href=x>menu</a></nav>"), (3, "v", "<nav><a href=x>menu</a></nav>"),
            (4, "w", "<article>" + "<p>long text, of words.</p>" * 20_000), (5, "x", '<a href="open>' * 2_000), (6, "y", "<" * 50_000), (7, "z", "no tags at all")]
    df = spark.createDataFrame([(*r, "t", 9) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = C.extract(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == texts[3] == "" and texts[None] == "one" and texts[4].count("\n\n") == 19_999
    assert C.extract(none.selectExpr("doc_id AS page_id", "text AS url", "html")).collect() == []
