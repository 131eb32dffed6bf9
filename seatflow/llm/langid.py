"""Language of a text: multinomial naive Bayes over hashed character n-grams.

The n-grams (1 to 3 characters) lie inside words in lower case, with a mark for a word's edge; anything
that is no letter only separates words. Counts per language are summed over all labelled rows; the matrix of log-probabilities (bins x languages) is broadcast, and texts are
scored in batches: each n-gram's bin picks a row, and running sums give the total per text.

NULL texts and texts without a letter get `und` with score 0, as does everything when no
labelled row exists. Rows without a language, and rows with a NULL id where the caller splits by id, teach nothing.
A model that is `calibrated` also knows how usual the n-grams of a text must be for it to be in one of its languages, and
gives `und` with score 0 to texts in none.
Ties go to the language first in order. Repeated rows count as often as they occur. Columns of the
table named `lang_pred` or `score` are replaced; all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from seatflow.llm.text import mixed
from seatflow.operators.ordering import quantiles

UNDECIDED = "und"
BITS = 16
LONGEST = 3
#: Bins of a language that are added up together.
_BLOCK = 1 << 10
#: The share of a language's rows that may be labelled wrongly or be hardly text, and how far from the rest of it, towards n-grams
#: never seen, the n-grams of a text may lie on the mean.
STRAYS, MARGIN = 0.01, 0.4
_CHARS = 1 << 20
_KNOWN = 0x32000
_FACTORS = mixed(np.arange(1, 8, dtype=np.uint64)) | np.uint64(1)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Each code point in lower case, 0 for what is no letter."""
    table = np.zeros(_KNOWN + 1, np.uint32)
    for c in range(_KNOWN):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low[0])
    return table


def grams(texts: list[str], bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the bins of all n-grams and where each text's begin and the last ends."""
    joined = "\n" + "".join(t + "\n" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[np.minimum(codes, _KNOWN)]
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    is_letter = letters > 0
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one mark after each word
    keep[0] = True
    places = np.flatnonzero(keep)
    kept, whole = letters[places].astype(np.uint64), is_letter[places]
    starts = np.searchsorted(places, begins)
    for n in range(1, LONGEST + 1):
        if len(kept) < n:
            break
        m = len(kept) - n + 1
        code = np.full(m, n, np.uint64)
        for j in range(n):
            code += kept[j : j + m] * _FACTORS[j]
        inner = whole[:m] | whole[n - 1 : n - 1 + m] if n < 3 else np.logical_and.reduce([whole[j : j + m] for j in range(1, n - 1)])
        at = np.flatnonzero(inner)
        code = code[at]
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        # an n-gram that begins at the mark before a text's first word belongs to that text
        first = np.searchsorted(at, starts - (1 if n > 1 else 0))
        first[-1] = len(at)
        yield (code >> np.uint64(64 - bits)).astype(np.int64), first


def pieces(texts: list[str], limit: int = _CHARS) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most `limit` characters together; a longer text is a run of its own."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, i
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, len(texts)


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # languages x bins
    #: Per language, the log-probability of an n-gram of a text in no learned language: a further class, all of whose n-grams are alike.
    unknown: np.ndarray | None = None

    def totals(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Runs of texts: first, end, log-likelihoods by language without priors, n-grams and letters of each text."""
        bits = self.log_prob.shape[1].bit_length() - 1
        for a, z in pieces(texts):
            total = np.zeros((z - a, len(self.languages)))
            letters = size = np.zeros(z - a, np.int64)
            for n, (bins, first) in enumerate(grams(texts[a:z], bits)):
                if n == 0:
                    letters = np.diff(first)
                size = size + np.diff(first)
                for k, row in enumerate(self.log_prob):
                    sums = np.concatenate([[0.0], np.cumsum(row[bins], dtype=np.float64)])
                    total[:, k] += sums[first[1:]] - sums[first[:-1]]
            yield a, z, total, size, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        texts = [t or "" for t in texts]
        if not self.languages:
            return [UNDECIDED] * len(texts), np.zeros(len(texts))
        labels: list[str] = []
        scores = np.zeros(len(texts))
        for a, z, likely, size, letters in self.totals(texts):
            total = likely + self.log_prior
            best = total.argmax(1)
            share = np.exp(total - total.max(1, keepdims=True))
            share = share.max(1) / share.sum(1)
            named = letters > 0
            if self.unknown is not None:
                named &= likely[np.arange(z - a), best] >= self.unknown[best] * size
            labels += [self.languages[b] if c else UNDECIDED for b, c in zip(best, named, strict=True)]
            scores[a:z] = np.where(named, share, 0.0)
        return labels, scores


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")


def fit(labelled: DataFrame, bits: int = BITS) -> Model:
    """A model from all (text, lang) rows; each task sums a table of counts per language, and the tables are added up in blocks of bins."""
    block = min(_BLOCK, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for lang in set(langs):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                table = sums.setdefault(lang, np.zeros(1 << bits, np.int64))
                rows[lang] = rows.get(lang, 0) + len(own)
                for a, z in pieces(own):
                    for bins, _ in grams(own[a:z], bits):
                        table += np.bincount(bins, minlength=1 << bits)
        for lang, table in sums.items():
            parts = [part.tobytes() for part in table.reshape(-1, block)]
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(parts), "block": range(len(parts)), "n": [rows[lang]] * len(parts), "counts": parts})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        rows: dict[tuple[str, int], int] = {}
        for batch in batches:
            lang, at, n, counts = (column.to_pylist() for column in batch.columns)
            for key, own_n, own in zip(zip(lang, at, strict=True), n, counts, strict=True):
                sums[key] = sums.get(key, 0) + np.frombuffer(own, np.int64)
                rows[key] = rows.get(key, 0) + own_n
        if sums:
            langs, places = zip(*sums, strict=True)
            yield pa.RecordBatch.from_pydict({"lang": langs, "block": places, "n": list(rows.values()), "counts": [t.tobytes() for t in sums.values()]})

    kind = "lang string, block long, n long, counts binary"
    found = _labelled(labelled).mapInArrow(count, kind).repartition("lang", "block").mapInArrow(add, kind).collect()  # a table per language
    if not found:
        return Model([], np.zeros(0), np.zeros((0, 1 << bits)))
    known = {r.lang: r.n for r in sorted(found, key=lambda r: r.lang)}
    counts = {(r.lang, r.block): np.frombuffer(r.counts, np.int64) for r in found}
    matrix = np.array([np.concatenate([counts[lang, at] for at in range((1 << bits) // block)]) for lang in known], np.float64) + 0.5
    matrix = np.log(matrix / matrix.sum(1, keepdims=True))
    prior = np.array(list(known.values()), float)
    return Model(list(known), np.log(prior / prior.sum()), matrix.astype(np.float32))


def calibrated(model: Model, labelled: DataFrame, strays: float = STRAYS, margin: float = MARGIN) -> Model:
    """`model` that can tell texts in none of its languages, by the n-grams of all labelled rows.

    Of each language the `strays` quantile of the mean log-probability of a text's n-grams is taken, over the texts that the model
    gives it; `margin` of the way from there to an n-gram never seen lies the class of unknown languages. A
    language that gets no text turns none away.
    """
    if not model.languages:
        return model
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, likely, size, letters in shared.value.totals(batch.column(0).to_pylist()):
                best = (likely + shared.value.log_prior).argmax(1)
                mean = likely[np.arange(z - a), best] / np.maximum(size, 1)
                yield pa.RecordBatch.from_pydict({"best": best[letters > 0], "mean": mean[letters > 0]})

    means = _labelled(labelled).select("text").mapInArrow(measure, "best long, mean double")
    low = {r.best: r.quantile for r in quantiles(means, "best", "mean", strays).collect()}  # a row per language
    unseen = model.log_prob.min(1).astype(np.float64)
    usual = np.array([low.get(k, -np.inf) for k in range(len(model.languages))])
    turned = np.where(np.isfinite(usual), usual, 0.0)
    return replace(model, unknown=np.where(np.isfinite(usual), turned - margin * (turned - unseen), -np.inf))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with `lang_pred` and `score` (posterior probability) from `text` alone."""
    docs = docs.drop("lang_pred", "score")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = shared.value.predict(batch.column(at).to_pylist())
            names = [*batch.schema.names, "lang_pred", "score"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string()), pa.array(scores)], names)

    return docs.mapInArrow(label, schema)


def fold(of: int) -> Column:
    """The fold of a row's id; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))
