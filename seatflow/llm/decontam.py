"""Benchmark decontamination with suffix arrays over the words of the training texts.

Documents are taken in shards of bounded bytes. A shard's suffix array orders the places of all its words by
the words that follow, up to the end of their document: one sort by the first two words, then
prefix doubling of whatever is still tied, until it has the depth of the longest benchmark item. Every suffix of every
item is looked up by binary search, one more word at a time, which gives the length and a place of its longest
verbatim match, and at window length the range of all places where the window occurs. Words compare
by 22 bits of their hash in the order and by 64 bits in what is reported. No document is shuffled; tasks hash the items into
a table of the shared folder, whose files every executor fetches and reads in blocks of `BLOCK_WORDS` words, an item of more
being a block of its own.

NULL and empty texts have no words and are clean. Items without words or without an id take no part; rows
that repeat an item_id are one item with all their windows. A text longer than a shard's bytes
is a shard of its own. Repeated documents are judged one by one. Empty tables give no rows, or clean rows.
Columns of the table that bear a result's name are replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from seatflow.llm import text as words_of
from seatflow.runtime import stored_with

WINDOW = 10
#: Words of benchmark items that a task holds at a time.
BLOCK_WORDS = 1 << 20
_BITS = 20
_RESULTS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, " \
    "longest long, longest_at long, longest_item string, longest_item_word long"


def hashed(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, word hashes, bounds of rows) for each shard of the texts."""
    for first, last, data, offsets in words_of.chunks(texts):
        data = words_of.lowered(data)
        starts, ends, bounds = words_of.words(data, offsets, words_of.ALNUM)
        yield first, last, words_of.word_hashes(data, starts, ends), bounds


def _order(high: np.ndarray, low: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """Indices of `places` by (high, low, place); three numbers of 20 bits sort as one."""
    if n < 1 << _BITS:
        b = np.uint64(_BITS)
        key = (high.astype(np.uint64) << (b + b)) | (low.astype(np.uint64) << b) | np.arange(len(places), dtype=np.uint64)
        key.sort()
        return (key & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    return np.lexsort((low, high))


class SuffixArray:
    """The order of all word places of a shard, to `depth` words; `bounds` are the documents' first words."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, depth: int):
        n = len(hashes)
        self.n, self.hashes, self.bounds = n, hashes, bounds
        counts = np.diff(bounds)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.stop = np.repeat(bounds[1:], counts)  # where the document of a place ends
        self.short = np.concatenate([(hashes >> np.uint64(42)).astype(np.int64) | 1, [0]])  # 0: beyond the end
        place = np.arange(n)
        after = np.where(place + 1 < self.stop, self.short[1:], 0)
        pair = (self.short[:-1] << 22) | after
        if n < 1 << _BITS:  # 44 bits of two words and 20 of the place
            key = (pair.astype(np.uint64) << np.uint64(_BITS)) | place.astype(np.uint64)
            key.sort()
            self.places = (key & np.uint64((1 << _BITS) - 1)).astype(np.int64)
            self.pairs = (key >> np.uint64(_BITS)).astype(np.int64)
        else:
            self.places = np.argsort(pair, kind="stable")
            self.pairs = pair[self.places]
        fresh = np.ones(n, bool)
        fresh[1:] = self.pairs[1:] != self.pairs[:-1]
        self._refine(fresh, depth)

    def _refine(self, fresh: np.ndarray, depth: int) -> None:
        """Prefix doubling of the tied places; `fresh` marks the first of each group of equal prefixes."""
        n, known = self.n, 2
        rank = np.zeros(n + 1, np.int64)  # 1 + first position of a place's group; 0 beyond the end
        group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) if n else np.zeros(0, np.int64)
        rank[self.places] = group + 1
        rank[n] = 0
        while known < depth:
            alone = fresh & np.append(fresh[1:], True)
            tied = np.flatnonzero(~alone)
            if not len(tied):
                return
            places = self.places[tied]
            ahead = places + known
            low = np.where(ahead < self.stop[places], rank[np.minimum(ahead, n)], 0)
            high = rank[places]
            order = _order(high, low, places, n)
            places, high, low = places[order], high[order], low[order]
            self.places[tied] = places
            first = np.ones(len(tied), bool)
            first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            fresh[tied] = first
            rank[places] = np.maximum.accumulate(np.where(first, tied, 0)) + 1
            known *= 2

    def _word(self, position: np.ndarray, j: np.ndarray) -> np.ndarray:
        place = self.places[position]
        return np.where(place + j < self.stop[place], self.short[np.minimum(place + j, self.n)], 0)

    def _bound(self, low: np.ndarray, high: np.ndarray, j: int, value: np.ndarray, right: bool) -> np.ndarray:
        low, high = low.copy(), high.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            found = self._word(middle, j)
            below = found <= value[open_] if right else found < value[open_]
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
        return low

    def search(self, items: np.ndarray, ends: np.ndarray, window: int):
        """Looks up each suffix of the items; `ends` says where the item of a word ends.

        Returns the length of its longest match, a place of it, and the range of positions whose
        first `window` words (or the whole item, where that is shorter) agree, empty if none.
        """
        m = len(items)
        longest, where = np.zeros(m, np.int64), np.zeros(m, np.int64)
        begin, end = np.zeros(m, np.int64), np.zeros(m, np.int64)
        if not m or not self.n:
            return longest, where, begin, end
        short = np.concatenate([(items >> np.uint64(42)).astype(np.int64) | 1, [0]])
        suffix = np.arange(m)
        first = short[:-1] << 22
        low, high = np.searchsorted(self.pairs, first), np.searchsorted(self.pairs, first + (1 << 22))
        j = 1
        while True:
            some = low < high
            suffix, low, high = suffix[some], low[some], high[some]
            longest[suffix], where[suffix] = j, self.places[low]
            done = suffix + j >= ends[suffix]
            full = (j == window) | ((j < window) & done)
            begin[suffix[full]], end[suffix[full]] = low[full], high[full]
            suffix, low, high = suffix[~done], low[~done], high[~done]
            if not len(suffix):
                return longest, where, begin, end
            value = short[suffix + j]
            if j == 1:
                pair = (short[suffix] << 22) | value
                low, high = np.searchsorted(self.pairs, pair), np.searchsorted(self.pairs, pair, "right")
            else:
                low, high = self._bound(low, high, j, value, False), self._bound(low, high, j, value, True)
            j += 1

    def occurrences(self, items: np.ndarray, suffixes: np.ndarray, lengths: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """(suffix, place, length) of all places in the given ranges at which all words agree in 64 bits."""
        counts = end - begin
        which = np.repeat(np.arange(len(suffixes)), counts)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
        places, length = self.places[begin[which] + inside], lengths[which]
        same = places + length <= self.stop[places] if len(places) else np.zeros(0, bool)
        for j in range(int(lengths.max(initial=0))):
            at = np.flatnonzero(same & (j < length))
            same[at] = self.hashes[places[at] + j] == items[suffixes[which[at]] + j]
        return suffixes[which[same]], places[same], length[same]


@dataclass
class Block:
    """The hashed words of some benchmark items, one after another."""

    names: list[str]
    hashes: np.ndarray
    bounds: np.ndarray

    def __post_init__(self) -> None:
        counts = np.diff(self.bounds)
        self.item = np.repeat(np.arange(len(counts)), counts)
        self.start = np.arange(len(self.hashes)) - self.bounds[self.item]
        self.ends = np.repeat(self.bounds[1:], counts)
        left = self.ends - np.arange(len(self.hashes))
        self.windowed = (left >= WINDOW) | (left == np.repeat(counts, counts))  # suffixes that begin a window
        self.lengths = np.minimum(left, WINDOW)


@dataclass
class Items:
    """Benchmark items hashed by tasks, in files that every executor fetches; tasks read them block by block."""

    files: list[str]
    words: int
    longest: int
    block_words: int

    def _read(self) -> Iterator[Block]:
        names, parts, size = [], [], 0
        for file in self.files:
            for batch in pq.ParquetFile(SparkFiles.get(file)).iter_batches(256, columns=["item_id", "hashes"]):
                for name, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    part = np.frombuffer(part.as_buffer(), "<u8")
                    if names and size + len(part) > self.block_words:
                        yield Block(names, np.concatenate(parts), np.cumsum([0, *map(len, parts)]))
                        names, parts, size = [], [], 0
                    names.append(name)
                    parts.append(part)
                    size += len(part)
        if names:
            yield Block(names, np.concatenate(parts), np.cumsum([0, *map(len, parts)]))

    def blocks(self) -> Iterable[Block]:
        """All items; a task keeps them if they are one block, and reads them again for each shard otherwise."""
        if self.words > self.block_words:
            return self._read()
        if not hasattr(self, "_kept"):
            self._kept = list(self._read())
        return self._kept


def items_of(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Items:
    """Hash the items in tasks into a table of the shared folder, and name its files to all executors."""

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, bounds in hashed(batch.column(1)):
                rows = [hashes[a:b].astype("<u8").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                counts = np.diff(bounds)
                found = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(rows, pa.binary()), pa.array(counts, pa.int64())],
                    ["item_id", "hashes", "n"])
                yield found.filter(pa.array(counts > 0))

    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string"), "text")
    rows = rows.mapInArrow(hash_rows, "item_id string, hashes binary, n long").hint("rebalance")
    held, seen = stored_with(rows, "benchmark-items", [F.sum("n").alias("words"), F.max("n").alias("longest")])
    files = held.inputFiles()
    for file in files:
        benchmark.sparkSession.sparkContext.addFile(file)
    return Items(sorted(file.rsplit("/", 1)[-1] for file in files), seen.words or 0, seen.longest or 0, block_words)


class _Verdict:
    """What the blocks of items tell about the documents of a shard."""

    def __init__(self, array: SuffixArray):
        self.array, self.cover = array, np.zeros(array.n + 1, np.int64)
        docs = len(array.bounds) - 1
        self.named: list[set[str]] = [set() for _ in range(docs)]
        self.best: list[tuple | None] = [None] * docs

    def add(self, items: Block) -> None:
        array = self.array
        _, _, begin, end = array.search(items.hashes, items.ends, WINDOW)
        some = np.flatnonzero(items.windowed & (end > begin))
        suffix, place, length = array.occurrences(items.hashes, some, items.lengths[some], begin[some], end[some])
        if not len(place):
            return
        np.add.at(self.cover, place, 1)
        np.add.at(self.cover, place + length, -1)
        doc, item = array.doc[place], items.item[suffix]
        for pair in np.unique(doc * len(items.names) + item).tolist():
            self.named[pair // len(items.names)].add(items.names[pair % len(items.names)])
        # windows that follow each other in a document and an item are one longer match
        order = np.lexsort((place, place - suffix))
        suffix, place, length, doc, item = (x[order] for x in (suffix, place, length, doc, item))
        fresh = np.ones(len(place), bool)
        fresh[1:] = (np.diff(place) != 1) | (np.diff(suffix) != 1) | (np.diff(doc) != 0) | (np.diff(item) != 0)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(place)) - 1
        whole = place[last] + length[last] - place[first]
        longest = np.zeros(len(self.best), np.int64)
        np.maximum.at(longest, doc[first], whole)
        for i in np.flatnonzero(whole == longest[doc[first]]).tolist():
            k = first[i]
            d = int(doc[k])
            found = (-int(whole[i]), int(place[k] - array.bounds[d]), items.names[item[k]], int(items.start[suffix[k]]))
            if self.best[d] is None or found < self.best[d]:
                self.best[d] = found

    def hit(self) -> np.ndarray:
        """Hit words per document."""
        covered = np.concatenate([[0], np.cumsum(np.cumsum(self.cover[:-1]) > 0)])
        return np.diff(covered[self.array.bounds])

    def columns(self) -> list[pa.Array]:
        n_hit, names = self.hit(), [sorted(x) for x in self.named]
        best = [(None, None, None, None) if b is None else (-b[0], *b[1:]) for b in self.best]
        digests = [hashlib.sha256(",".join(n).encode()).hexdigest() for n in names]
        return [
            pa.array(np.diff(self.array.bounds), pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(n) for n in names], pa.int64()),
            pa.array(digests, pa.string()), pa.array(n_hit > 0),
            *[pa.array([b[j] for b in best], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int64()))],
        ]


def judged(docs: DataFrame, benchmark: DataFrame, keep_clean: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with words, hit words, items, and the longest verbatim match that holds a window.

    The match is given by its words, its first word in the document, its item and its first word there, NULL without one;
    of equal lengths the first in the document, then by item. With `keep_clean` only clean rows and no new columns.
    """
    items = items_of(benchmark, block_words)
    kinds = StructType.fromDDL(_RESULTS)
    if not keep_clean:
        docs = docs.drop(*kinds.names)
    schema = docs.schema if keep_clean else StructType([*docs.schema.fields, *[StructField(f.name, f.dataType) for f in kinds]])
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, bounds in hashed(batch.column(at)):
                found = _Verdict(SuffixArray(hashes, bounds, items.longest))
                for block in items.blocks():
                    found.add(block)
                rows = batch.slice(first, last - first)
                if keep_clean:
                    yield rows.filter(pa.array(found.hit() == 0))
                else:
                    yield pa.RecordBatch.from_arrays([*rows.columns, *found.columns()], [*batch.schema.names, *kinds.names])

    return docs.mapInArrow(scan, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of any item occurs."""
    return judged(docs, benchmark, keep_clean=True)


def longest_matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(item_id, item_word, length, doc_id, doc_word): per suffix of an item its longest verbatim match in any document.

    One location is given, the smallest doc_id and word among the shards' own.
    """
    items = items_of(benchmark, block_words)

    def matches(array: SuffixArray, block: Block, ids: pa.Array) -> pa.RecordBatch:
        longest, where, _, _ = array.search(block.hashes, block.ends, WINDOW)
        some = np.flatnonzero(longest)
        same = np.ones(len(some), bool)  # words that agree in 64 bits, in front
        length = np.zeros(len(some), np.int64)
        for j in range(int(longest.max(initial=0))):
            at = np.flatnonzero(same & (longest[some] > j))
            same[at] = array.hashes[where[some[at]] + j] == block.hashes[some[at] + j]
            length[at] += same[at]
        doc = array.doc[where[some]]
        return pa.RecordBatch.from_arrays([
            pa.array([block.names[i] for i in block.item[some]], pa.string()), pa.array(block.start[some], pa.int64()),
            pa.array(length, pa.int64()), ids.take(pa.array(doc)), pa.array(where[some] - array.bounds[doc], pa.int64()),
        ], ["item_id", "item_word", "length", "doc_id", "doc_word"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, bounds in hashed(batch.column(1)):
                array = SuffixArray(hashes, bounds, items.longest)
                for block in items.blocks():
                    yield matches(array, block, batch.column(0).slice(first, last - first))

    kind = f"item_id string, item_word long, length long, doc_id {dict(docs.dtypes)['doc_id']}, doc_word long"
    found = docs.select("doc_id", "text").mapInArrow(scan, kind).where("length > 0")
    best = F.min_by(F.struct("doc_id", "doc_word"), F.struct(-F.col("length"), F.col("doc_id"), F.col("doc_word")))
    return found.groupBy("item_id", "item_word").agg(F.max("length").alias("length"), best.alias("at")).select(
        "item_id", "item_word", "length", "at.doc_id", "at.doc_word")
