"""Personal data: base patterns, and spans that boosted trees choose among overlapping candidates.

The base (`base_spans`) is fixed: e-mail, IP, card and phone patterns with their checks. Beyond it, generous generators propose
spans of the same kinds in other spellings: addresses written out, numbers without a plus,
cards in other groupings, IPv6. Gradient-boosted trees score a candidate from its format and from the words around it; a
kind's threshold is the lowest at which held-out examples keep the stated precision. Of chosen spans that overlap, the
surest stays, and none may overlap the base. The trees are fitted on examples written from templates into
words drawn by their counts in all whole texts; words that no feature tells apart are counted together.

NULL texts count as empty and have no spans. Texts are read whole; offsets are code points. Repeated rows are judged one by one. Columns of
the table that bear a result's name are replaced, all others are kept; redaction keeps the columns, and updates `n_chars` where it exists.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

KINDS = ("email", "ip", "card", "phone")
EXAMPLES = 6000
PRECISION = 0.99
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """All base spans, by start, then kind; per kind the leftmost that do not overlap."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append(("email", start, match.end()))
            done = match.end()
        else:
            done = at + 1  # a local part has no @, so none begins before it
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = digits_of(m[0]) if m.end() - m.start() < 64 else ""  # 19 digits and their separators are fewer
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_AT = r"(?:\s?[\[({<]\s?(?:at|@|＠)\s?[\])}>]\s?|\s(?:at|AT)\s|\s?[@＠]\s?)"
_DOT = r"(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s|\.)"
GENERATORS = {
    "email": re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,3}}(?![A-Za-z0-9])"),
    "ip": re.compile(r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6}|[0-9]{1,3}(?:\s?[\[(]?\.[\])]?\s?[0-9]{1,3}){3})(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ ._/\-– ]{0,2}[0-9]){12,18}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:00|\+)?[ .]?\(?[0-9]{1,4}\)?(?:[ ./\-– ]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])"),
}
#: What Python's \s takes; RE2's takes less.
_SPACES = "".join(c for c in map(chr, range(0x10000)) if c.isspace())
#: Texts without any of these hold no span and no candidate: all but addresses written out need a digit or a colon, and
#: those need the middle of their generator. For RE2, which looks over a text once.
_TRACE = rf"[0-9@＠:]|{_AT}[A-Za-z0-9-]+{_DOT}[A-Za-z0-9-]".replace(r"\s", f"[{_SPACES}]")
_CUES = {
    "email": ("mail", "contact", "write", "reach", "send"), "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "ring", "dial"),
    "card": ("card", "visa", "credit", "debit", "payment", "mastercard", "pay"), "ip": ("ip", "address", "host", "server", "ping"),
    "no": ("order", "invoice", "version", "token", "isbn", "date", "id", "sku", "page", "serial", "key", "secret", "password", "total", "ref", "no", "year", "score"),
}
_ALL_WORDS = re.compile(r"[A-Za-z]+")
_ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu")
_CUE = re.compile(f"(?=({'|'.join(sorted({c for cues in _CUES.values() for c in cues}, key=len, reverse=True))}))")
#: Characters before a candidate that are looked at, and letters beyond which a generator takes no word.
_BEFORE, _LONG = 32, 65


def candidates(text: str) -> list[Span]:
    """Spans of all generators; those of different kinds may overlap."""
    return [(kind, m.start(), m.end()) for kind, pattern in GENERATORS.items() for m in pattern.finditer(text)]


def features(text: str, span: Span) -> list[float]:
    """Format of a candidate and its surroundings."""
    kind, start, end = span
    own, before, after = text[start:end], text[max(0, start - _BEFORE) : start], text[end : end + 16]
    digits = digits_of(own)
    groups = re.findall(r"[0-9]+", own)
    near = [w.lower() for w in _ALL_WORDS.findall(before)[-4:]]
    parts = [p for p in re.split(r"[^A-Za-z0-9]+", own) if p]
    return [
        *(float(kind == k) for k in KINDS), len(own), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        float(luhn(digits)) if 12 < len(digits) < 20 else -1.0, float(own[:1] == "+"), float(own[:2] == "00"), float("(" in own), own.count("."),
        own.count("-"), own.count(" "), own.count("/"), own.count(":"), float(any(c.isalpha() for c in own)),
        *(float(any(w.startswith(c) for w in near for c in cues)) for cues in _CUES.values()),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "=\"'#$€£"), float(after[:1] in "\"'%€$"),
        float(len(groups) == 3 and sorted(map(len, groups)) in ([2, 2, 4], [1, 2, 4], [1, 1, 4])), float("@" in own or "＠" in own),
        float("[" in own or "{" in own or "(" in own and any(c.isalpha() for c in own)), float(" dot " in own.lower()),
        len(parts[-1]) if parts else 0, float(bool(parts) and parts[-1].lower() in _ENDINGS),
        float(len(digits) > 6 and len(set(digits)) == 1),
    ]


@dataclass
class Trees:
    """Boosted trees of one depth: split features and cuts level by level, then leaves."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (len(leaf) - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss with level-wise trees on exact cuts."""
    share = np.clip(y.mean(), 0.01, 0.99)
    start = float(np.log(share / (1 - share)))
    score = np.full(len(y), start)
    cuts = [(u := np.unique(x[:, f]))[:-1][:: max(1, len(u) // 32)] for f in range(x.shape[1])]
    above = [x[:, f][:, None] > c for f, c in enumerate(cuts)]
    found: tuple[list, list, list] = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for at in range(2**depth - 1):
            own = np.flatnonzero(node == at)
            best = (1e-6, 0, np.inf, None)
            gs, hs = g[own].sum(), h[own].sum()
            for f, c in enumerate(cuts):
                if not len(c) or not len(own):
                    continue
                right = above[f][own]
                gr, hr = g[own] @ right, h[own] @ right
                gain = gr**2 / (hr + ridge) + (gs - gr) ** 2 / (hs - hr + ridge) - gs**2 / (hs + ridge)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, c[k], right[:, k])
            feature[at], cut[at] = best[1], best[2]
            node[own] = 2 * at + 1 + (best[3] if best[3] is not None else 0)
        leaf_of = node - (2**depth - 1)
        leaf = np.array([rate * g[leaf_of == k].sum() / (h[leaf_of == k].sum() + ridge) for k in range(2**depth)])
        score = score + leaf[leaf_of]
        for store, value in zip(found, (feature, cut, leaf), strict=True):
            store.append(value)
    return Trees(*map(np.array, found), start)


@dataclass
class Model:
    trees: Trees
    thresholds: dict[str, float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Chosen spans beside the base."""
        free = _clear(candidates(text), base)
        if not free:
            return []
        sure = self.trees.predict(np.array([features(text, s) for s in free]))
        chosen = sorted(((-p, s) for p, s in zip(sure, free, strict=True) if p >= self.thresholds[s[0]]), key=lambda c: (c[0], c[1][1], c[1][2]))
        out: list[Span] = []
        for _, span in chosen:
            if _clear([span], sorted(out, key=lambda s: s[1])):
                bisect.insort(out, span, key=lambda s: s[1])
        return out


def _clear(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that overlap none of `taken`, which is in order of start."""
    if not taken:
        return spans
    starts = [s[1] for s in taken]
    reach = np.maximum.accumulate([s[2] for s in taken])
    out = []
    for span in spans:
        k = bisect.bisect_left(starts, span[2])  # those that begin before its end
        if not k or reach[k - 1] <= span[1]:
            out.append(span)
    return out


def form(word: str) -> str:
    """A word that gives the same features in every example: only cues near its end, parts of addresses and its length are kept."""
    low = word.lower()
    if low in _ENDINGS or low in ("at", "dot"):
        return word
    low = low[-_LONG:]
    kept = ["z"] * len(low)  # no cue has a z
    for cue in _CUE.finditer(low, max(0, len(low) - _BEFORE)):
        kept[cue.start() : cue.start() + len(cue[1])] = cue[1]
    return "".join(kept)


def examples(words: list[str], count: int = EXAMPLES, seed: int = 0, counts: Sequence[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of candidates in texts written from templates into `words`, which are drawn by their `counts`, if given."""
    rng = random.Random(seed)
    words = words or ["some", "words", "stand", "here", "and", "there"]
    reach = list(accumulate(counts or [1] * len(words)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9)))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    tld = lambda: rng.choice(["com", "org", "net", "io", "de", "fr", "es", "info", "edu"])

    def paid() -> str:
        body = rng.choice("3456") + num(rng.choice([11, 12, 13, 14, 14, 14, 15]))
        whole = next(body + c for c in "0123456789" if luhn(body + c))
        sep = rng.choice([" ", "-", ".", "  ", "", "/"])
        return sep.join(whole[i : i + 4] for i in range(0, len(whole), 4))

    def dialled() -> str:
        a, b, c = num(3), num(3), num(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{num(2)} {num(3)} {num(3)} {num(4)}", f"{a} {b} {c}", f"0{num(3)}/{num(4)} {num(3)}", f"1-{a}-{b}-{c}"])

    def written() -> str:
        at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("{at}", "."), (" @ ", "."), ("(at)", ".")])
        return f"{name()}{rng.choice(['', '.' + name(), num(2)])}{at}{name()}{dot}{tld()}"

    def numbered() -> str:
        return rng.choice([":".join(hexes(4) for _ in range(8)), f"{hexes(4)}:{hexes(3)}::{hexes(4)}", "[.]".join(str(rng.randint(1, 254)) for _ in range(4)), "(.)".join(str(rng.randint(1, 254)) for _ in range(4))])

    yes = {"card": paid, "phone": dialled, "email": written, "ip": numbered}
    no = [
        lambda: f"20{num(2)}-{num(2)}-{num(2)}", lambda: f"{num(2)}.{num(2)}.20{num(2)}", lambda: f"{num(2)}/{num(2)}/19{num(2)}", lambda: num(rng.randint(3, 20)),
        lambda: f"{num(1)}.{num(1)}.{num(2)}", lambda: f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"{num(3)} {num(3)}",
        lambda: f"{num(2)}-{num(2)}", lambda: f"{num(1)} {num(3)} {num(3)}.{num(2)}", lambda: f"{num(4)}-{num(4)}", lambda: f"{num(4)} {num(4)} {num(4)} {num(4)}",
        lambda: f'"{hexes(40)}"', lambda: f"{hexes(6)}:{hexes(6)}", lambda: f"{name()} at {name()}. {name()}", lambda: f"{name()} at the dot {name()}", lambda: f"{num(3)}-{num(4)}",
        lambda: f"@{name()}", lambda: f"{name()} @ {name()}", lambda: f"{num(1)}-{num(1)}-{num(1)}", lambda: f"{num(5)}-{num(4)}", lambda: f"{num(2)} {num(2)} {num(2)}",
        lambda: f"{num(3)}.{num(3)}", lambda: f"{num(4)}/{num(2)}", lambda: f"{rng.choice('abcdef')}:{hexes(2)}:{hexes(2)}", lambda: f"{num(10)}", lambda: f"{num(3)} {num(4)}",
    ]
    some = lambda a, b: " ".join(rng.choices(words, cum_weights=reach, k=rng.randint(a, b)))
    x, y = [], []
    while len(x) < count:
        kind = rng.choice([*KINDS, None, None, None, None])
        cue = ""
        if rng.random() < 0.5:
            cue = rng.choice(_CUES[kind if kind and rng.random() < 0.8 else "no"]) + rng.choice([" ", ": ", " is "])
        own = yes[kind]() if kind else rng.choice(no)()
        lead = f"{some(2, 8)} {cue}"
        text = f"{lead}{own}{rng.choice([' ', ', ', '. ', chr(10)])}{some(2, 6)}"
        a, b = len(lead), len(lead) + len(own)
        for span in _clear(candidates(text), base_spans(text)):
            if span[1] >= b or span[2] <= a:
                continue
            hit = kind == span[0] and abs(span[1] - a) + abs(span[2] - b) <= 1
            x.append(features(text, span))
            y.append(float(hit))
    return np.array(x), np.array(y)


def word_forms(docs: DataFrame) -> dict[str, int]:
    """Occurrences of the words of all whole texts by `form`, in order: a row per form, of which there are few however many the words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter[str] = Counter()
            for text in batch.column(0):
                words.update(_ALL_WORDS.findall(text.as_py() or ""))
            sums: Counter[str] = Counter()
            for word, n in words.items():
                sums[form(word)] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], ["form", "n"])

    rows = docs.select("text").mapInArrow(count, "form string, n long").groupBy("form").agg(F.sum("n").alias("n")).collect()
    return {r.form: r.n for r in sorted(rows, key=lambda r: r.form)}


def fit(docs: DataFrame, sample: int | None = None, precision: float = PRECISION, seed: int = 0) -> Model:
    """Trees and thresholds; the examples' words follow the counts of all words of `docs`, or of about `sample` documents, if given."""
    if sample is not None:
        draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.length("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        docs = docs.where(draw < min(1.0, sample / max(1, docs.count())))
    forms = word_forms(docs)
    words, counts = list(forms), list(forms.values())
    trees = boost(*examples(words, seed=seed, counts=counts))
    x, y = examples(words, EXAMPLES // 2, seed + 1, counts)
    p = trees.predict(x)
    thresholds = {}
    for k, kind in enumerate(KINDS):
        own = x[:, k] > 0
        order = np.argsort(-p[own], kind="stable")
        right = np.cumsum(y[own][order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= precision)
        thresholds[kind] = max(0.5, float(p[own][order][good[-1]])) if len(good) else 2.0  # 2: never
    return Model(trees, thresholds)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _all_spans(texts: pa.Array, model: Model) -> Iterator[tuple[list[Span], list[Span]]]:
    """(base, all) spans per text."""
    texts = texts.fill_null("")
    some = pc.match_substring_regex(texts, _TRACE).to_pylist()
    for i, hit in enumerate(some):
        text = texts[i].as_py() if hit else ""
        base = base_spans(text)
        yield base, ordered(base + model.added(text, base))


_RESULTS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def found(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with counts of the base, its digest, and all spans as `kind:start:end`."""
    kinds = StructType.fromDDL(_RESULTS)
    docs = docs.drop(*kinds.names)
    schema = StructType([*docs.schema.fields, *[StructField(f.name, f.dataType) for f in kinds]])
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = list(_all_spans(batch.column(at), shared.value))
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in spans], pa.int64()) for k in KINDS]
            digests = pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in spans], pa.string())
            every = pa.array([_listed(s) for _, s in spans], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts, digests, every], [*batch.schema.names, *kinds.names])

    return docs.mapInArrow(scan, schema)


def redact(text: str, spans: list[Span]) -> str:
    """`text` with each run of overlapping spans replaced by the kind of its first."""
    out, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"<{kind}>"]
        done = end
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with all spans in `text` replaced by `<kind>`."""
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(model)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, texts = list(batch.columns), batch.column(at)
            spans = [s for _, s in _all_spans(texts, shared.value)]
            new = [t if not s or t is None else redact(t, s) for t, s in zip(texts.to_pylist(), spans, strict=True)]
            columns[at] = pa.array(new, texts.type)
            if counted is not None:
                old = columns[counted]
                columns[counted] = pa.array([len(t) if s else n for t, s, n in zip(new, spans, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(scan, docs.schema)
