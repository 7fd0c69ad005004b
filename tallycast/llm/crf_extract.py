"""Main-text extraction by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each with
its ancestors' tags and class, id and role words.  The field labels the sequence
of blocks as article or other; its features are the ancestors and the shape of
the text, its transitions favour unbroken stretches.  Weights are trained on
labelled pages (below) by AdaGrad on the exact likelihood; pages are decoded
by Viterbi where they are read, in one scan without a shuffle.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import hash_sample

#: Labelled pages: written from templates, and read from the table (those with an <article>, chosen by hash).
TEMPLATE_PAGES, TABLE_PAGES, TABLE_PAGE_CHARS = 400, 100, 20_000
SLOTS = 1 << 15
EPOCHS = 6

#: Fixed values of HTML: elements that do not part text, elements whose content is no text, and implied end tags.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark noscript object q s samp small span strike strong sub sup time tt u var wbr "
                   "g svg text tspan math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = "script|style|textarea|title|iframe|noembed|noframes|template"
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table td th tr button select body article section div aside nav main header footer form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<silent>{SILENT})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*>"  # an open quote: up to the next >
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    """A run of text with the words of its ancestors, outermost first, and its characters inside links."""

    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]
    linked: int


def _attribute_words(attrs: str) -> tuple[str, ...]:
    if not attrs or "=" not in attrs:
        return ()
    return tuple(w.lower() for groups in _NAMES.findall(attrs) for value in groups if value for w in _WORDS.findall(value))


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order.  White space, also of character references, becomes one space; empty blocks are left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, at = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, tuple(t for t, _ in stack if t not in INLINE), tuple(w for _, n in stack for w in n), linked))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if any(t == "a" for t, _ in stack):
                linked += len(text)

    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            elif m["end"] or m["end2"]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i]
                        break
            elif tag not in VOID:
                stack.append((tag, _attribute_words(m["attrs"] or "")))
            continue
        flush()
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        closed = CLOSES.get(tag, ()) + ("p",)
        for i in range(len(stack) - 1, -1, -1):
            name = stack[i][0]
            if name in closed:
                del stack[i:]
                if name == "p" or name == tag:
                    break
            elif name in SCOPE:
                break
        if tag not in VOID:
            stack.append((tag, _attribute_words(m["attrs"] or "")))
    add(page[at:])
    flush()
    return out


# ---------------------------------------------------------------- features

_SLOT: dict[str, int] = {}


def _slot(feature: str) -> int:
    slot = _SLOT.get(feature)
    if slot is None:
        if len(_SLOT) > 200_000:
            _SLOT.clear()
        slot = _SLOT[feature] = zlib.crc32(feature.encode("utf-8", "replace")) % SLOTS
    return slot


_CUES = re.compile(r"©|copyright|all rights reserved|cookie|subscri|newsletter|advert|sponsor|sign in|log in|repl(?:y|ies)|comment|share|related|read more|follow us|privacy|terms")


def features(page: list[Block]) -> list[list[int]]:
    """Feature slots of each block: every ancestor tag and name word, the nearest tags, and the text's shape."""
    out = []
    for i, b in enumerate(page):
        text, n = b.text, len(b.text)
        words = text.count(" ") + 1
        leaf = b.tags[-1] if b.tags else "none"
        found = {f"t={t}" for t in b.tags if t not in ("html", "body")} | {f"n={w}" for w in b.names}
        found |= {
            "bias", f"l={leaf}", f"l2={leaf}|{b.tags[-2] if len(b.tags) > 1 else ''}", f"words={min(words.bit_length(), 8)}", f"link={min(4, 4 * b.linked // max(n, 1))}",
            f"end={text[-1] if text[-1] in '.!?:,;|' else 'w' if text[-1].isalnum() else 'o'}",
            f"place={4 * i // len(page)}", f"commas={min(3, text.count(','))}", f"upper={int(4 * sum(map(str.isupper, text)) / n)}",
            f"digit={int(4 * sum(map(str.isdigit, text)) / n)}",
        }
        found |= {f"cue={c}" for c in set(_CUES.findall(text.lower()))}
        if i == len(page) - 1:
            found.add("last")
        out.append([_slot(f) for f in sorted(found)])
    return out


# ---------------------------------------------------------------- the field

@dataclass
class Field:
    """Weights of slots and transitions for the labels 0 (other) and 1 (article)."""

    state: np.ndarray
    step: np.ndarray

    def scores(self, slots: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((s for f in slots for s in f), dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum([len(f) for f in slots])[:-1]])
        return np.add.reduceat(self.state[flat], starts, axis=0)

    def decode(self, slots: list[list[int]]) -> list[int]:
        """The labels of highest probability together (Viterbi); ties go to other."""
        if not slots:
            return []
        (a, b), (c, d) = self.step.tolist()
        rows = self.scores(slots).tolist()
        zero, one = rows[0]
        back = []
        for s0, s1 in rows[1:]:
            from0, from1 = zero + a >= one + c, zero + b >= one + d
            back.append((0 if from0 else 1, 0 if from1 else 1))
            zero, one = s0 + (zero + a if from0 else one + c), s1 + (zero + b if from1 else one + d)
        labels = [1 if one > zero else 0]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


def _marginals(scores: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of each label of each block, and the expected transitions (forward and backward pass)."""
    n = len(scores)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = scores[i] + np.logaddexp(ahead[i - 1, 0] + step[0], ahead[i - 1, 1] + step[1])
    for i in range(n - 2, -1, -1):
        m = scores[i + 1] + behind[i + 1]
        behind[i] = np.logaddexp(step[:, 0] + m[0], step[:, 1] + m[1])
    total = np.logaddexp(*ahead[-1])
    pairs = ahead[:-1, :, None] + step[None] + (scores[1:] + behind[1:])[:, None, :] - total
    return np.exp(ahead + behind - total), np.exp(pairs).sum(axis=0)


def fit(pages: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-5, seed: int = 5) -> Field:
    """Maximum likelihood by AdaGrad, one page a step."""
    field = Field(np.zeros((SLOTS, 2)), np.zeros((2, 2)))
    squares, step_squares = np.full((SLOTS, 2), 1e-6), np.full((2, 2), 1e-6)
    order = random.Random(seed)
    pages = [p for p in pages if p[0]]
    for _ in range(epochs):
        for slots, labels in order.sample(pages, len(pages)):
            probability, moves = _marginals(field.scores(slots), field.step)
            truth = np.eye(2)[labels]
            flat = np.fromiter((s for f in slots for s in f), dtype=np.int64)
            each = np.repeat(probability - truth, [len(f) for f in slots], axis=0)
            used, at = np.unique(flat, return_inverse=True)
            slope = np.stack([np.bincount(at, weights=each[:, y]) for y in (0, 1)], axis=1) + decay * field.state[used]
            squares[used] += slope ** 2
            field.state[used] -= rate * slope / np.sqrt(squares[used])
            np.add.at(moves, (labels[:-1], labels[1:]), -1)
            step_squares += moves ** 2
            field.step -= rate * moves / np.sqrt(step_squares)
    return field


# ---------------------------------------------------------------- labelled pages

#: Words of the names that containers have, for the templates and for labelling pages of the table.
OTHER_NAMES = ("ad ads advert advertisement aside banner breadcrumb comments comment cookie consent footer header login masthead menu nav navbar navigation newsletter "
               "notice pagination popup promo related reply share sharing sidebar social sponsored subscribe toolbar widget").split()
ARTICLE_NAMES = "article body content entry main post story text".split()


def template_pages(n: int, seed: int = 3) -> Iterator[tuple[str, str]]:
    """Labelled pages of many layouts: the page and its article, whose blocks carry the letter X in front."""
    rng = random.Random(seed)
    syllables = "ba ce di fo gu la me ni po ru sa te vi wo ly an er in on st".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.choice((1, 1, 2, 2, 3))))
    line = lambda k: " ".join(word() for _ in range(k))

    def prose() -> str:
        return " ".join(line(rng.randint(1, 14)).capitalize() + rng.choice((".", ".", ".", ",", "!", "?", "")) for _ in range(rng.choice((1, 1, 2, 4, 8, 15))))

    def inline(text: str) -> str:
        tag = rng.choice(("b", "i", "em", "a href='/x'", "span", "strong"))
        cut = rng.randint(0, len(text))
        return rng.choice((text, f"<{tag}>{text[:cut]}</{tag.split()[0]}>{text[cut:]}", f"<b>{text}<br>"))

    def article_part() -> str:
        kind = rng.choice(("p", "p", "p", "p", "p", "h2", "li", "blockquote", "pre", "td"))
        text = "X" + (line(rng.randint(1, 8)) if kind == "h2" else prose())
        return {"li": f"<ul><li>{text}</li></ul>", "td": f"<table><tr><td>{text}</td></tr></table>"}.get(kind, f"<{kind}>{inline(text)}</{kind}>" if rng.random() < 0.9 else f"<{kind}>{text}")

    def links() -> str:
        return "<ul>" + "".join(f"<li><a href='/{word()}'>{line(rng.randint(1, 3))}</a></li>" for _ in range(rng.randint(2, 8))) + "</ul>"

    def other(name: str | None = None) -> str:
        name = name or rng.choice(OTHER_NAMES)
        tag = {"nav": "nav", "menu": "nav", "footer": "footer", "header": "header", "aside": "aside", "sidebar": "aside", "login": "form", "subscribe": "form", "newsletter": "form"}.get(name, "div")
        tag = tag if rng.random() < 0.6 else "div"
        mark = f"{rng.choice(('class', 'id'))}='{rng.choice(('', 'site-', 'page_', 'main-'))}{name}{rng.choice(('', '-box', 'Area', ' ' + word()))}'"
        mark = "" if tag != "div" and rng.random() < 0.5 else mark
        inner = rng.choice((links(), f"<p>{prose()}</p>", prose(), f"<h3>{line(2)}</h3><p>{prose()}</p>", f"<label>{line(2)}</label><button>{word()}</button>",
                            f"&copy; {line(2)} &middot; {prose()}", "".join(f"<div class='{name}'><b>{word()}</b><p>{prose()}</p></div>" for _ in range(rng.randint(1, 4)))))
        return f"<{tag} {mark}>{inner}</{tag}>"

    for _ in range(n):
        holder = rng.choice(("article", "article", "article", "main", "section", "div"))
        mark = f"class='{rng.choice(('', 'post-', 'entry-', 'article-', 'story-'))}{rng.choice(ARTICLE_NAMES)}'" if holder in ("div", "section") or rng.random() < 0.3 else ""
        parts = [article_part() for _ in range(rng.choice((1, 2, 4, 8, 16)))]
        for _ in range(rng.choice((0, 0, 0, 1, 2))):
            parts.insert(rng.randint(0, len(parts)), other(rng.choice(("ad", "share", "related", "newsletter", "aside", "comments", "promo", "cookie"))))
        head = f"<h1>X{line(rng.randint(2, 9))}</h1>" if rng.random() < 0.8 else ""
        before = [other(rng.choice(("nav", "header", "menu", "banner", "cookie", "ad", "breadcrumb", "login"))) for _ in range(rng.randint(0, 4))]
        after = [other(rng.choice(("footer", "comments", "related", "sidebar", "ad", "newsletter", "social", "notice"))) for _ in range(rng.randint(0, 4))]
        yield (f"<html><head><title>{line(4)}</title><script>var t='</p>';</script></head><body>{''.join(before)}<{holder} {mark}>{head}{''.join(parts)}</{holder}>{''.join(after)}"
               + rng.choice(("</body></html>", "")), holder)


def labelled_template_pages(n: int, seed: int = 3) -> Iterator[tuple[list[Block], list[int]]]:
    """The templates' blocks and labels; the marking X is taken out of the texts."""
    for page, _ in template_pages(n, seed):
        found = blocks(page)
        labels = [int(b.text.startswith("X")) for b in found]
        for b, y in zip(found, labels, strict=True):
            b.text = b.text[1:] or "x" if y else b.text
        yield found, labels


def labelled_table_pages(pages: list[str]) -> Iterator[tuple[list[Block], list[int]]]:
    """Pages with one <article>, labelled by it; inside it, containers with names of other parts are other."""
    out, others = ("nav", "aside", "footer", "form"), frozenset(OTHER_NAMES) - {"header"}
    for page in pages:
        if len(re.findall(r"<article\b", page, re.I)) == 1:
            found = blocks(page)
            yield found, [int("article" in b.tags and not others.intersection(b.names) and not any(t in out for t in b.tags)) for b in found]


def train(pages: DataFrame) -> Field:
    """The field of the template pages and a bounded sample of the table's own."""
    own = pages.select(F.col("html").cast("string").alias("html"), F.col("page_id").cast("long").alias("page_id"))
    own = own.where(F.length("html").between(1, TABLE_PAGE_CHARS) & F.contains("html", F.lit("<article")))
    sample = [r["html"] for r in hash_sample(own, F.xxhash64("page_id", "html"), TABLE_PAGES).collect()]
    labelled = [*labelled_template_pages(TEMPLATE_PAGES), *labelled_table_pages(sample)]
    return fit([(features(b), y) for b, y in labelled])


def main_text(field: Field, page: str) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, y in zip(found, field.decode(features(found)), strict=True) if y)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points of text) of every row.

    Null or empty html and pages without article blocks have an empty text.
    Repeated rows are extracted each, null ids and urls stay null, extra columns
    are not read, an empty table gives no rows.
    """
    field = pages.sparkSession.sparkContext.broadcast(train(pages))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                texts = [main_text(field.value, p or "") for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
