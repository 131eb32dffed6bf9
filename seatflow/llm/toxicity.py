"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

Each dictionary holds what its class repeats and the other does not (by the likelihood ratio of document counts); all windows of the
sample that pass go in, so the dictionaries grow with its vocabulary. A window, a word or a piece of a long one, or a few
characters in a row of a script that sets no spaces, is compressed with either dictionary; its advantage is how much
shorter the toxic dictionary makes it, as a part of what a window that this dictionary holds whole would gain. A text's largest advantages go into a
logistic curve, fitted across parts of the sample, each measured with
dictionaries made from the others, which turns them into a probability.
Around the window stand fixed bytes that both dictionaries hold, since zstandard looks for no match near the
end of its input and stores a block that does not shrink as it is.

NULL, empty and letterless texts have no windows and get the score of no advantage; without labelled
rows of both classes all scores are the share of toxic ones (0 if none). Labels with a NULL id or mark are ignored, a
repeated doc_id is toxic if any of its labels is, of texts that agree in the least two hashes of four or more long words one counts in the fit. Long texts are scored whole. Columns of the table named
`score` or `predicted` are replaced; all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from seatflow.llm import text as words_of
from seatflow.runtime import stored

THRESHOLD = 0.3
#: Expected number of labelled documents of each class that the model is fitted on, at most.
SAMPLE_PER_CLASS = 2000
#: Size up to which a dictionary takes the smallest tables of the compressor; beyond it they grow.
DICTIONARY_BYTES = 6144
#: A word tells if it is so many times as common in toxic documents, and its likelihood ratio is one that
#: chance gives to no word of the sample at this level.
LEAST_TIMES, LEVEL = 4.0, 0.05
PARTS = 4
_LETTERS = words_of.word_table([(0x00, 0x60), (0x7B, 0x7F)])
#: A window that costs fewer bytes beyond the least than these tells little.
LEAST_SAVED = 3
_PIECE = 48
#: Characters of a window in scripts without spaces: Thai to Lao, Burmese, Khmer, and radicals to ideographs, as ranges of the
#: first three bytes of a character.
GRAMS = (2, 4)
_UNSPACED = [(0xE0B880, 0xE0BBBF), (0xE18080, 0xE1829F), (0xE19E80, 0xE19FBF), (0xE2BA80, 0xE9BFBF), (0xF0A080, 0xF0B3BF)]
_BEFORE, _AFTER = b"<0123456789#ABCDEFGHIJKLMNOPQRS>", b'!"%&()*+,-./'
#: Marks of a window's ends, shorter than the shortest match, so that a part of a word in the dictionary costs more than the whole.
_FIRST, _LAST = b"\x01\x02\x03", b"\x04\x05\x06"
_CACHED = 1 << 20


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3))
    base: float = 0.0

    def __post_init__(self) -> None:
        self.known, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "values", "_pair", "_least")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def lengths(self, windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Compressed lengths with the ordinary and the toxic dictionary."""
        if not hasattr(self, "_pair"):
            size = max(len(self.toxic), len(self.ordinary))
            more = max(0, -(-size // DICTIONARY_BYTES) - 1).bit_length()
            how = zstandard.ZstdCompressionParameters(
                window_log=14 + more, hash_log=12 + more, chain_log=12 + more, search_log=4 + more, min_match=4, target_length=64, strategy=zstandard.STRATEGY_BTOPT,
                write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            own = lambda body: zstandard.ZstdCompressionDict(
                body.ljust(size) + _BEFORE + _AFTER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self._pair = [zstandard.ZstdCompressor(dict_data=own(b), compression_params=how) for b in (self.ordinary, self.toxic)]
        framed = [_BEFORE + _FIRST + w + _LAST + _AFTER for w in windows]
        size = np.array([len(w) for w in framed], np.uint64)
        places = np.stack([np.cumsum(size) - size, size], 1)
        held = zstandard.BufferWithSegments(b"".join(framed), places.tobytes())
        return tuple(np.array([len(x) for x in c.multi_compress_to_buffer(held)], np.int64) for c in self._pair)

    def least(self) -> float:
        """The usual length of a window that the toxic dictionary holds whole."""
        if not hasattr(self, "_least"):
            self._least = float(np.median(self.lengths([w.removeprefix(_FIRST) for w in self.toxic.split(_LAST)[:-1]])[1]))
        return self._least

    def advantages(self, hashes: np.ndarray, windows) -> np.ndarray:
        """What the toxic dictionary saves on each window, 1 at most; `windows(i)` gives the bytes of window i."""
        names, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.append(self.known, 0)[np.searchsorted(self.known, names)] != names
        if new.any():
            ordinary, toxic = self.lengths([windows(i) for i in first[new]])
            gain = np.clip((ordinary - toxic) / np.maximum(ordinary - self.least(), LEAST_SAVED), -1, 1)
            known, values = np.concatenate([self.known, names[new]]), np.concatenate([self.values, gain])
            order = np.argsort(known, kind="stable")
            self.known, self.values = known[order], values[order]
        out = self.values[np.searchsorted(self.known, names)][which]
        if len(self.known) > _CACHED:  # the cache is bounded; windows are then compressed anew
            self.known, self.values = np.zeros(0, np.uint64), np.zeros(0)
        return out

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text: its largest advantage, and the mean of its three largest."""
        parts = []
        for data, starts, ends, bounds in windows(texts):
            hashes = words_of.word_hashes(data, starts, ends)
            gain = self.advantages(hashes, lambda i: data[starts[i] : ends[i]].tobytes())  # noqa: B023
            out = np.zeros((len(bounds) - 1, 2))
            for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                if b > a:
                    own = gain[a:b]
                    top = np.partition(own, len(own) - 3)[-3:] if len(own) > 3 else own
                    out[row] = top.max(), np.maximum(top, 0).sum() / 3
            parts.append(out)
        return np.concatenate(parts) if parts else np.zeros((0, 2))

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not self.toxic:
            return np.full(len(texts), self.base)
        return 1 / (1 + np.exp(-np.clip(_design(self.features(texts)) @ self.weights, -30, 30)))


def pieces(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut into windows of at most `_PIECE` bytes."""
    times = (ends - starts + _PIECE - 1) // _PIECE
    if len(times) == 0 or times.max() == 1:
        return starts, ends, bounds
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    first = np.repeat(starts, times) + nth * _PIECE
    last = np.minimum(first + _PIECE, np.repeat(ends, times))
    return first, last, np.concatenate([[0], np.cumsum(times)])[bounds]


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word) of all runs of `GRAMS` characters within words whose script sets no spaces."""
    none = np.zeros(0, np.int64)
    lead = np.flatnonzero(data >= 0xE0)
    lead = lead[lead + 2 < len(data)]
    code = (data[lead].astype(np.int64) << 16) | (data[lead + 1].astype(np.int64) << 8) | data[lead + 2]
    lead = lead[np.logical_or.reduce([(code >= a) & (code <= b) for a, b in _UNSPACED])]
    if not len(lead):
        return none, none, none
    stop = lead + np.where(data[lead] >= 0xF0, 4, 3)
    word = np.searchsorted(starts, lead, side="right") - 1
    joined = np.concatenate([[False], (lead[1:] == stop[:-1]) & (word[1:] == word[:-1])])
    run = np.cumsum(~joined)  # characters without a gap, in one word
    found = []
    for n in GRAMS:
        k = np.flatnonzero(run[: len(run) - n + 1] == run[n - 1 :]) if len(run) >= n else none
        found.append((lead[k], stop[k + n - 1] if len(k) else none, word[k]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def windows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, ends, first window of each row and the total) of lower-cased texts, some rows at a time."""
    for _, _, data, offsets in words_of.chunks(pc.utf8_lower(texts.cast(pa.large_string()))):
        starts, ends, bounds = words_of.words(data, offsets, _LETTERS)
        more, until, word = grams(data, starts, ends)
        row = np.searchsorted(bounds, word, side="right") - 1
        starts, ends, bounds = pieces(starts, ends, bounds)
        if len(more):
            rows = np.concatenate([np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), row])
            order = np.argsort(rows, kind="stable")
            starts, ends = np.concatenate([starts, more])[order], np.concatenate([ends, until])[order]
            bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(bounds) - 1))])
        yield data, starts, ends, bounds


def _design(features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(features)), features])


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.02, steps: int = 50) -> np.ndarray:
    """Newton's method with a small penalty on all but the constant."""
    w = np.zeros(x.shape[1])
    ridge = penalty * np.diag([1e-3, *np.ones(x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge @ w
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, slope)
        if np.abs(slope).max() < 1e-8:
            break
    return w


def _body(words: list[bytes], limit: int | None = None) -> bytes:
    """The words, the most telling last; with a limit, as far as they fit."""
    out, size = [], 0
    for word in words:
        entry = _FIRST + word + _LAST
        size += len(entry)
        if limit is not None and size > limit:
            break
        out.append(entry)
    return b"".join(reversed(out))


def _dictionaries(held: DataFrame, size: dict[tuple[int, int], int], parts: tuple[int, ...], ratio: float) -> tuple[bytes, bytes]:
    """Toxic and ordinary content of equal size from counts of documents per word in some parts of the sample."""
    n1, n0 = (sum(size.get((c, h), 0) for h in parts) for c in (1, 0))
    if not n1 or not n0:
        return b"", b""
    held = held.select("word", *[sum((F.col(f"n{c}{h}") for h in parts[1:]), F.col(f"n{c}{parts[0]}")).alias(f"c{c}") for c in (0, 1)])
    term = lambda c, n: F.col(c) * F.log(F.greatest(F.col(c), F.lit(0.5)) * (n1 + n0) / ((F.col("c1") + F.col("c0")) * n))
    held = held.where("c1 + c0 > 0").withColumn("ratio", 2 * (term("c1", n1) + term("c0", n0)))
    tells = (F.col("ratio") >= ratio) & (F.col("c1") / n1 >= LEAST_TIMES * (F.col("c0") + 0.5) / n0)
    toxic = _body([bytes(r.word) for r in held.where(tells).orderBy(F.desc("ratio"), "word").collect()])
    most = len(toxic) // 7 + 1  # entries that fit
    usual = held.where(~tells & (F.col("c1") / n1 <= 2 * F.col("c0") / n0)).orderBy(F.desc("c0"), "word").limit(most).collect()
    return toxic, _body([bytes(r.word) for r in usual], len(toxic))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, seed: int = 0) -> Model:
    """A model from the documents that `labels` (doc_id, toxic) marks; about `per_class` of each class at most."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    counts = {r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(base=float(1 in counts))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("toxic") == 1, F.lit(per_class / counts[1])).otherwise(F.lit(per_class / counts[0]))
    chosen = F.broadcast(marks.where(draw < share))  # about twice `per_class` rows
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z\x{80}-\x{10FFFF}]+"), F.lit(0))
    long = F.array_distinct(F.filter("words", lambda w: F.length(w) > 8))
    least = lambda turn: F.when(
        F.size("long") >= 4, F.array_min(F.transform("long", lambda w: F.xxhash64(F.lit(turn), w))))  # fewer tell no copy
    sample = docs.where("text IS NOT NULL").select("doc_id", "text").join(chosen, "doc_id").withColumn("words", words).withColumn("long", long)
    sample = sample.withColumns({f"_{t}": F.coalesce(least(t), F.xxhash64("text")) for t in (1, 2)})
    sample = sample.dropDuplicates(["toxic", "_1", "_2"]).drop("_1", "_2", "words", "long")  # of near copies one counts
    sample = stored(sample.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(PARTS))), "toxicity-sample")
    rate = counts[1] / (counts[0] + counts[1])
    size = {(r.toxic, r.part): r.n for r in sample.groupBy("toxic", "part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for data, starts, ends, bounds in windows(batch.column(0)):
                whole, starts, ends = data.tobytes(), starts.tolist(), ends.tolist()
                own = [{whole[starts[i] : ends[i]] for i in range(a, b)} for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                of = pa.array(np.repeat(np.arange(row, row + len(own)), [len(x) for x in own]), pa.int64())
                words = pa.array([w for x in own for w in x], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(1).take(of), batch.column(2).take(of), words], ["toxic", "part", "word"])
                row += len(own)

    kinds = dict(sample.dtypes)
    held = sample.select("text", "toxic", "part").mapInArrow(cut, f"toxic {kinds['toxic']}, part {kinds['part']}, word binary")
    held = stored(held.groupBy("word").agg(*[
        F.count_if((F.col("toxic") == c) & (F.col("part") == h)).alias(f"n{c}{h}") for c in (0, 1) for h in range(PARTS)]), "toxicity-words")
    ratio = 2 * np.log(max(2, held.count()) / LEVEL)
    made = lambda parts: _dictionaries(held, size, parts, ratio)
    every = tuple(range(PARTS))
    model = Model(*made(every), np.zeros(3), rate)
    crossed = {h: Model(*made(tuple(x for x in every if x != h))) for h in every}
    if not model.toxic or not all(m.toxic for m in crossed.values()):
        return Model(base=rate)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column(2).to_numpy()
            found = np.zeros((len(part), 2))
            for h, other in crossed.items():
                found[part == h] = other.features(batch.column(0).filter(pa.array(part == h)))
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), batch.column(1)], ["most", "mean", "toxic"])

    rows = sample.select("text", "toxic", "part").mapInArrow(measure, "most double, mean double, toxic int").collect()
    x, y = np.array([[r.most, r.mean] for r in rows]), np.array([r.toxic for r in rows], float)
    model.weights = _logistic(_design(x), y)
    # the sample holds the classes in other parts than the labels do
    taken = [min(1.0, per_class / counts[c]) for c in (0, 1)]
    model.weights[0] += np.log(taken[0] / taken[1])
    return model


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from the threshold on), from `text` alone."""
    docs = docs.drop("score", "predicted")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    at, shared = docs.columns.index("text"), docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(batch.column(at))
            more = [pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(score, schema)
