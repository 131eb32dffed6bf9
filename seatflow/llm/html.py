"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the markup.

A page is read once from left to right into blocks: runs of text between tags that break lines. Each block has
features of its open tags, with words of their class and id, and of its text (length, links, sentence
marks). The field has two states, main text and the rest; it is fitted by gradient ascent on labelled pages and
decoded by Viterbi. Labelled pages are made from a bounded sample of pages: their texts, put into
layouts drawn at random whose parts are known to be article, menu, header, footer, sidebar, notice, advert, form or comment.

NULL and empty pages give an empty text. Script, style and similar elements, comments and tags
that never close hide what follows them up to the end of the page, as in a browser. A '<' that begins no tag is text; texts
of formulas are read, those of datalists are not. Any nesting depth works: a tag's
features are handed down once. White space is what Python's `str.split` takes for it. Repeated pages are read one by one; columns of the
table named `text` or `n_chars` are replaced, all others are kept.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

SAMPLE_PAGES = 300
SAMPLE_TEXTS = 6000
LABELLED_PAGES = 400

HIDDEN = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg select".split())
#: Elements whose texts are not shown, but whose end other tags may imply.
UNSEEN = frozenset("datalist annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike "
    "strong sub sup time tt u var wbr br img input button "
    "math semantics annotation annotation-xml mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced "
    "menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction".split())
_TOLD = frozenset(
    "html body article main section nav header footer aside form ul ol li dl table td p h1 h2 h3 h4 blockquote pre figure "
    "figcaption button a div fieldset details address".split())
_MEANS = {word: group for group, words in {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar tabs toc",
    "head": "header masthead banner logo topbar brand hero",
    "foot": "footer foot copyright colophon legal bottom",
    "side": "sidebar side aside rail widget widgets secondary complementary",
    "note": "cookie cookies notice consent gdpr alert popup modal overlay warning message privacy",
    "ad": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion adbox adsense",
    "form": "form search login signup subscribe subscription newsletter contact register",
    "talk": "comment comments commentlist reply replies respond discussion disqus responses reader readers",
    "more": "related recommended share sharing social more popular trending tags meta byline links",
    "main": "article content post entry story main body text page-content maincontent",
}.items() for word in words.split()}
#: A '<' that begins markup; any other is text.
_MARKUP = re.compile(r"<(?:[a-zA-Z!?]|/.)", re.S)
_BEGINS = re.compile(r"</?[a-zA-Z]")
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…](?:\s|$)")


@dataclass
class Block:
    text: str
    start: int  # place of its first text in the page
    above: frozenset  # features of the open tags
    linked: int  # characters inside links


@lru_cache(1 << 16)
def _handed(above: frozenset, tag: str, names: str) -> frozenset:
    own = {f"in:{tag}"} if tag in _TOLD else set()
    own |= {f"as:{_MEANS[w]}" for w in _WORD.findall(names.lower()) if w in _MEANS}
    if tag in ("header", "footer", "aside", "section") and "in:article" in above:
        own.add(f"inner:{tag}")
    return above | own if own else above


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order; white space is single and character references are decoded."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset]] = []
    parts: list[str] = []
    linked, links, unseen, start, above = 0, 0, 0, 0, frozenset()
    here = above

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, start, here, min(linked, len(text))))
            parts.clear()
        linked = 0

    i, n = 0, len(page)
    open_count: dict[str, int] = {}
    while i < n:
        sign = _MARKUP.search(page, i)
        j = sign.start() if sign else n
        if j > i and not unseen:
            if not parts:
                start, here = i, stack[-1][1] if stack else above
            parts.append(page[i:j])
            if links:
                linked += j - i
        if j >= n:
            break
        if page.startswith("<!--", j):
            k = page.find("-->", j + 4)
            i = n if k < 0 else k + 3
            continue
        if not _BEGINS.match(page, j):
            k = page.find(">", j)
            i = n if k < 0 else k + 1
            continue
        m = _TAG.match(page, j) or _LOOSE.match(page, j)
        if not m:
            break
        tag, i = m[1].lower(), m.end()
        if tag not in INLINE:
            close()
        elif tag == "br":
            parts.append(" ") if parts else None
        if page[j + 1] == "/":
            if open_count.get(tag):
                while True:
                    name, _ = stack.pop()
                    open_count[name] -= 1
                    links -= name == "a"
                    unseen -= name in UNSEEN
                    if name == tag:
                        break
            continue
        if tag in HIDDEN:
            if m[2].endswith("/") and tag == "svg":
                continue
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, i)
            i = n if not end else end.end()
            continue
        if tag in VOID or m[2].endswith("/") and tag in INLINE:
            continue
        if tag not in INLINE and open_count.get("p"):  # a line-breaking tag ends an open paragraph
            while stack and open_count.get("p"):
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE), -1)
                if depth < 0 or stack[depth][0] != "p":
                    break
                for name, _ in stack[depth:]:
                    open_count[name] -= 1
                    links -= name == "a"
                    unseen -= name in UNSEEN
                del stack[depth:]
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(m[2])) if "=" in m[2] else ""
        stack.append((tag, _handed(stack[-1][1] if stack else above, tag, names)))
        open_count[tag] = open_count.get(tag, 0) + 1
        links += tag == "a"
        unseen += tag in UNSEEN
    close()
    return out


def features(block: Block, place: int, total: int) -> tuple[frozenset, list[str]]:
    """Features of the open tags and of the text."""
    n = len(block.text)
    words = block.text.count(" ") + 1
    share = block.linked / n if n else 0
    own = [
        "one", f"chars:{min(n.bit_length(), 10)}", f"links:{0 if share == 0 else 1 if share < 0.5 else 2}",
        f"words:{0 if words < 4 else 1 if words < 12 else 2}",
    ]
    if _SENTENCE.search(block.text):
        own.append("sentence")
    if block.text[0] in "©®" or "©" in block.text[:40]:
        own.append("rights")
    if place == 0:
        own.append("first")
    if place == total - 1:
        own.append("last")
    if "in:article" not in block.above and "in:main" not in block.above and "as:main" not in block.above:
        own.append("outside")
    return block.above, own


@dataclass
class Field:
    """Weights of features for main text against the rest, and of the four transitions."""

    weights: dict[str, float]
    steps: np.ndarray  # 2 x 2
    first: np.ndarray
    last: np.ndarray

    def decode(self, page: list[Block]) -> list[int]:
        """The likeliest states by Viterbi."""
        if not page:
            return []
        (s00, s01), (s10, s11) = self.steps.tolist()
        a, b = self.first.tolist()
        back = []
        for place, block in enumerate(page):
            above, own = features(block, place, len(page))
            lean = self._above(above) + sum(self.weights.get(f, 0.0) for f in own)
            if place:
                to0, to1 = (a + s00, b + s10), (a + s01, b + s11)
                back.append((to0[1] > to0[0], to1[1] > to1[0]))
                a, b = max(to0), max(to1)
            b += lean
        state = int(b + self.last[1] > a + self.last[0])
        states = [state]
        for choice in reversed(back):
            state = int(choice[state])
            states.append(state)
        return states[::-1]

    def _above(self, above: frozenset) -> float:
        if not hasattr(self, "_memo") or len(self._memo) > 1 << 16:
            self._memo: dict[frozenset, float] = {}
        if above not in self._memo:
            self._memo[above] = sum(self.weights.get(f, 0.0) for f in above)
        return self._memo[above]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_memo"}

    def extract(self, page: str | None) -> str:
        found = blocks(page) if page else []
        return "\n".join(b.text for b, s in zip(found, self.decode(found), strict=True) if s)


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 250, penalty: float = 1e-3) -> Field:
    """Fit a field on labelled pages by Adam on the penalised log-likelihood, all pages at once."""
    pages = [p for p in pages if p[0]]
    told: dict[str, int] = {}
    rows: list[list[list[int]]] = []
    for found, _ in pages:
        rows.append([[told.setdefault(f, len(told)) for f in (*above, *own)] for above, own in (
            features(b, k, len(found)) for k, b in enumerate(found))])
    size, longest = len(pages), max(len(r) for r in rows)
    x = np.zeros((size, longest, len(told)), np.float32)
    y, real = np.zeros((size, longest), int), np.zeros((size, longest), bool)
    for i, (row, (_, labels)) in enumerate(zip(rows, pages, strict=True)):
        real[i, : len(row)], y[i, : len(row)] = True, labels
        for t, f in enumerate(row):
            x[i, t, f] = 1
    ends = real.sum(1) - 1
    everyone = np.arange(size)
    theta = np.zeros(len(told) + 8)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    follows = real[:, 1:]
    for turn in range(1, rounds + 1):
        w, steps, first, last = theta[:-8], theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:]
        lean = np.zeros((size, longest, 2))
        lean[..., 1] = x @ w
        lean[everyone, ends] += last
        alpha = np.zeros((size, longest, 2))
        alpha[:, 0] = first + lean[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + steps, axis=1) + lean[:, t]
            alpha[:, t] = np.where(real[:, t, None], step, alpha[:, t - 1])
        whole = np.logaddexp.reduce(alpha[:, -1], axis=1)
        beta = np.zeros((size, longest, 2))
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(steps + (lean[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], step, 0)
        state = np.exp(np.minimum(alpha + beta - whole[:, None, None], 0)) * real[..., None]
        pair = alpha[:, :-1, :, None] + steps + (lean[:, 1:] + beta[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        pair = np.exp(np.minimum(pair, 0)) * follows[..., None, None]
        truth = np.stack([(y == 0) & real, (y == 1) & real], -1).astype(float)
        both = truth[:, :-1, :, None] * truth[:, 1:, None, :]
        slope = np.concatenate([
            np.einsum("itf,it->f", x, truth[..., 1] - state[..., 1]), (both - pair).sum((0, 1)).ravel(),
            (truth[:, 0] - state[:, 0]).sum(0), (truth[everyone, ends] - state[everyone, ends]).sum(0),
        ]) / size - penalty * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in told.items()}
    return Field(weights, theta[-8:-4].reshape(2, 2), theta[-4:-2], theta[-2:])


def layouts(texts: list[str], count: int = LABELLED_PAGES, seed: int = 0) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages: texts in random layouts whose parts are known."""
    rng = random.Random(seed)
    texts = texts or ["A few plain words stand here.", "More words follow, and then an end."]
    esc = references.escape

    def some(low: int, high: int) -> str:
        words = rng.choice(texts).split()
        k = rng.randint(low, high)
        at = rng.randrange(max(1, len(words) - k + 1))
        return esc(" ".join(words[at : at + k]) or "word", quote=False)

    line = lambda: some(6, 60) + rng.choice([".", ".", "", "!"])
    link = lambda: f'<a href="/{rng.randrange(99)}">{some(1, 3)}</a>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 7))) + "</ul>"
    box = lambda names, inner, tags=("div", "section", "div"): (lambda t: f'<{t} {rng.choice(["class", "id"])}="{rng.choice(names)}">{inner}</{t}>')(rng.choice(tags))

    def side() -> str:
        """A part that is not main text."""
        inner = lambda: rng.choice([line(), f"<p>{line()}</p>", f"<h3>{some(1, 4)}</h3>{links()}", f"<p>{line()}</p><p>{line()}</p>", links()])
        talk = lambda: "".join(f'<div class="{rng.choice(["comment", "comment-body", "reply"])}"><p>{line()}</p></div>' for _ in range(rng.randint(1, 4)))
        return rng.choice([
            lambda: f"<nav>{links()}</nav>", lambda: box(["menu", "nav", "navbar", "breadcrumb"], links()),
            lambda: f"<aside>{inner()}</aside>", lambda: box(["sidebar", "widget", "side"], inner(), ("aside", "div")),
            lambda: box(["ad", "ads", "advert", "sponsored", "promo"], inner()), lambda: box(["cookie-notice", "notice", "consent", "alert"], f"<p>{line()}</p><button>{some(1, 2)}</button>"),
            lambda: f'<form action="/s"><label>{some(1, 3)}</label><input name="q"><p>{line()}</p><button>{some(1, 2)}</button></form>',
            lambda: box(["newsletter", "login", "search"], f"<form><p>{line()}</p></form>"),
            lambda: box(["comments", "comment-list", "discussion"], f"<h2>{some(1, 3)}</h2>{talk()}"),
            lambda: box(["comments", "responses"], "".join(f"<p>{line()}</p>" for _ in range(rng.randint(1, 5)))),
            lambda: box(["comments"], "<ul>" + "".join(f"<li>{line()}</li>" for _ in range(3)) + "</ul>"),
            lambda: box(["related", "share", "social", "popular"], inner()),
        ])()

    def body() -> list[tuple[str, int]]:
        out = [(f"<h1>{some(3, 12)}</h1>", 1)]
        if rng.random() < 0.2:
            out = [("<header>", 1), *out, ("</header>", 1)]
        for _ in range(rng.randint(1, 12)):
            out.append(rng.choice([
                lambda: (f"<p>{line()}</p>", 1), lambda: (f"<p>{line()} {link()} {line()}</p>", 1), lambda: (f"<p><b>{line()}<br>", 1),
                lambda: (f"<p>{line()}</p>", 1), lambda: (f"<h2>{some(1, 8)}</h2>", 1), lambda: (f"<blockquote>{line()}</blockquote>", 1),
                lambda: ("<ul>" + "".join(f"<li>{some(1, 20)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>", 1), lambda: (f"<p>{some(1, 5)}.</p>", 1),
            ])())
            if rng.random() < 0.12:
                out.append((side(), 0))
        return out

    made = []
    for _ in range(count):
        opened, closed = rng.choice([
            ("<article>", "</article>"), ("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"),
            ('<div class="content">', "</div>"), ('<div class="post"><div class="entry-content">', "</div></div>"), ('<div id="main"><article class="story">', "</article></div>"), ("", ""), ("<section>", "</section>"), ("<div>", "</div>"),
        ])
        pieces = [(f"<!DOCTYPE html><html><head><title>{some(2, 8)}</title><style>p{{}}</style></head><body>", 0)]
        if rng.random() < 0.6:
            pieces.append((f"<header><h1>{some(1, 4)}</h1>{rng.choice(['', '<p>' + line() + '</p>'])}{rng.choice(['', links()])}</header>", 0))
        pieces += [(side(), 0) for _ in range(rng.randint(0, 3))]
        pieces += [(opened, 0), *body(), *[(side(), 0) for _ in range(rng.random() < 0.3)], (closed, 0)]
        pieces += [(side(), 0) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.8:
            pieces.append((f"<footer>{rng.choice(['&copy; ', ''])}{line()}{rng.choice(['', links()])}</footer>", 0))
        page = "".join(p for p, _ in pieces)
        edges = np.cumsum([len(p) for p, _ in pieces])
        found = blocks(page)
        made.append((found, [pieces[int(np.searchsorted(edges, b.start, side="right"))][1] for b in found]))
    return made


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES, seed: int = 0, sample_texts: int = SAMPLE_TEXTS) -> Field:
    """A field from layouts filled with the texts of about `sample` pages, `sample_texts` blocks of them at most."""
    count = pages.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), "page_id", F.length("html")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = pages.where(draw < min(1.0, sample / max(1, count))).orderBy(F.xxhash64("page_id", "html")).limit(2 * sample).select("html").collect()
    texts = [b.text for r in rows if r.html for b in blocks(r.html) if b.text.count(" ") >= 5]
    return train(layouts(texts[:sample_texts], seed=seed))


def extracted(pages: DataFrame, field: Field) -> DataFrame:
    """`pages` with `text`, the main text of the whole `html`, and `n_chars`, its code points."""
    pages = pages.drop("text", "n_chars")
    schema = StructType([*pages.schema.fields, StructField("text", StringType()), StructField("n_chars", LongType())])
    at, shared = pages.columns.index("html"), pages.sparkSession.sparkContext.broadcast(field)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.extract(page) for page in batch.column(at).to_pylist()]
            more = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "text", "n_chars"])

    return pages.mapInArrow(read, schema)
