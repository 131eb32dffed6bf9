"""Pack tokenised documents into sequences of bounded length, each partition's number of sequences held against a bound.

Texts become token ids, closed by the id 0; only documents longer than a sequence are cut, the shorter piece first. Full
pieces are sequences as they are. The others are dealt into partitions of bounded size, and each partition is packed
by best-fit decreasing: the longest piece first, into the fullest sequence that takes it. Dual feasible functions then give
lower bounds of the number of sequences: such a function never sums to over 1 on pieces that fit into one sequence, so
its sum over all pieces is a number that no packing can go below. A partition that meets its bound is certified and keeps its
sequences, all but the loosest. The others have a gap: they release all sequences with room left and a seeded share of the full ones,
the released documents are dealt anew, and best-fit decreasing runs again. Rounds end when the whole table meets its
bound, or when a round saves nothing; then the packing before it stands.

A partition holds lengths and row numbers only, no text. NULL texts are empty; an empty text is the closing id alone.
Runs of characters in a batch are told apart by
64-bit hashes. NULL or repeated ids and repeated texts are documents like others; equal lengths are told apart by row number, so a stored
table is always packed alike. An empty table gives no rows. Long texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seatflow.llm.text import chunks, word_hashes
from seatflow.runtime import stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
CAPACITY = 2048
CLOSING = 0
#: Pieces that one task packs at once, and the share of full sequences that a partition with a gap releases.
PIECES_PER_PARTITION = 16384
SHARE = 0.25
ROUNDS = 8

#: Letters whose class no version of Unicode has changed, and all other characters that are cut here; texts with others are encoded as a whole.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏА-яぁ-ゖァ-ヺ一-龥가-힣"
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e¡-¬®-±´-¸»¿×÷‐-‧{_LETTERS}]*")
#: Fixed value: the parts of such texts that the vocabulary's tokenizer encodes one by one.
_PARTS = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")
_CACHED = 500_000
_CHUNK_BYTES = 8 << 20
_BLANK = np.isin(np.arange(256), [0x09, 0x0A, 0x0D, 0x20])
_FLUSH_BYTES = 8 << 20


def _packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Spelled(dict):
    """Per code point the characters that stand for its bytes in the vocabulary: printable bytes for themselves, others from 256 on."""

    def __init__(self):
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in plain]
        self.of = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def __missing__(self, code: int) -> str:
        self[code] = "".join(self.of[b] for b in chr(code).encode())
        return self[code]


class Encoder:
    """Ids of texts, by runs of characters up to the next single space: no part that is encoded crosses such a place.

    A run that occurs often in a batch is looked up once. Ids of a bounded number of runs and parts are kept.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.spelled = self.tokenizer.model, _Spelled()
        self.runs: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _plain(self, text: str | None) -> bool:
        return text is None or bool(_PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def _encoded(self, run: bytes) -> bytes:
        out, parts = [], self.parts
        for part in _PARTS.findall(run.decode()):
            ids = parts.get(part)
            if ids is None:
                ids = _packed_ids([t.id for t in self.model.tokenize(part.translate(self.spelled))])
                if len(part) < 64:
                    if len(parts) >= _CACHED:
                        parts.clear()
                    parts[part] = ids
            out.append(ids)
        return b"".join(out)

    def _lists(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        runs, raw, out = self.runs, data.tobytes(), []
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            run = raw[start:end]
            ids = runs.get(run)
            if ids is None:
                ids = self._encoded(run)
                if end - start < 64:
                    if len(runs) >= _CACHED:
                        runs.clear()
                    runs[run] = ids
            out.append(ids)
        return out

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in order; NULL has none."""
        for first, last, data, offsets in chunks(texts, _CHUNK_BYTES):
            own = texts.slice(first, last - first).to_pylist()
            plain = np.array([self._plain(text) for text in own], bool)
            blank = np.zeros(len(data) + 2, bool)  # also in front and behind
            blank[1:-1] = _BLANK[data]
            begins = (data == 0x20) & ~blank[:-2] & ~blank[2:]
            edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
            begins[edges - 1] = False  # a space that ends a row
            begins[offsets[:-1][np.diff(offsets) > 0]] = True
            starts = np.flatnonzero(begins)
            ends = np.append(starts[1:], len(data))[: len(starts)]
            row = np.searchsorted(offsets, starts, side="right") - 1
            kept = plain[row]
            starts, ends, row = starts[kept], ends[kept], row[kept]
            _, one, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
            lists = self._lists(data, starts[one], ends[one])
            flat, sizes = np.frombuffer(b"".join(lists), "<u4"), np.array([len(ids) // 4 for ids in lists], np.int64)
            at = np.cumsum(sizes) - sizes
            n = sizes[which] if len(which) else np.zeros(0, np.int64)
            upto = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.repeat(at[which] - upto[:-1], n) + np.arange(upto[-1])] if len(which) else flat
            bounds = upto[np.searchsorted(row, np.arange(len(own) + 1))]
            for i, text in enumerate(own):
                if plain[i]:
                    yield ids[bounds[i] : bounds[i + 1]]
                else:
                    yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenised(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, doc_id, piece, start, length, ids) of every piece; `ids` is binary, four bytes a token. Stored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids binary"
    names = ["doc_id", "piece", "start", "length", "ids"]
    closing = np.array([CLOSING], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            rows, pieces, starts, lengths, ids, held = [], [], [], [], [], 0

            def flush(doc_ids=batch.column(0)) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([
                    doc_ids.take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())], names)

            for row, encoded in enumerate(own.encode(batch.column(1))):
                data = encoded.tobytes() + closing
                n, at, piece = len(data) // 4, 0, 0
                step = n % capacity or capacity
                while at < n:
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at)
                    lengths.append(step)
                    ids.append(data[4 * at : 4 * (at + step)])
                    at, piece, held, step = at + step, piece + 1, held + 4 * step, capacity
                    if held >= _FLUSH_BYTES:
                        yield flush()
                        rows, pieces, starts, lengths, ids, held = [], [], [], [], [], 0
            if rows:
                yield flush()

    pieces = docs.select("doc_id", "text").mapInArrow(cut, schema)
    return stored(pieces.withColumn("key", F.monotonically_increasing_id()), "packing-pieces")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence and place of each piece, room left in each sequence) of lengths that fall."""
    sequence, place, room = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by the room that they have left
    some = 0  # bit r: a sequence with room r waits
    for i, length in enumerate(lengths.tolist()):
        enough = some >> length
        if enough:
            left = length + (enough & -enough).bit_length() - 1
            at = waiting[left].pop()
            if not waiting[left]:
                some ^= 1 << left
        else:
            left, at = capacity, len(room)
            room.append(capacity)
        sequence[i], place[i] = at, capacity - left
        left -= length
        room[at] = left
        if left:
            some |= 1 << left
            waiting[left].append(at)
    return sequence, place, np.array(room, np.int64)


@lru_cache(2)
def dual_feasible(capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(values of functions at lengths 0 to capacity, as whole numbers; what each function counts as 1).

    For every multiset of lengths that fits into `capacity` the values of a function sum to no more than its 1. Three families: lengths
    over a half counted whole where all below a threshold are dropped; lengths rounded down to multiples of a
    fraction unless they are such a multiple; large ones counted by what they leave for pieces of a threshold's size.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    values, ones = [x], [capacity]
    thresholds = np.unique(np.linspace(1, capacity // 2, min(capacity // 2, 256)).astype(np.int64)) if capacity > 1 else []
    for e in thresholds:
        values.append(np.where(x > capacity - e, capacity, np.where(x < e, 0, x)))
        ones.append(capacity)
    for k in range(1, 33):
        whole = x * (k + 1) % capacity == 0
        values.append(np.where(whole, x * k, x * (k + 1) // capacity * capacity))
        ones.append(capacity * k)
    for e in thresholds:
        most = capacity // e
        large = most - (capacity - x) // e  # what stays of `most` beside a length over a half
        values.append(np.where(2 * x > capacity, 2 * large, np.where(2 * x == capacity, most, np.where(x >= e, 2, 0))))
        ones.append(2 * most)
    return np.array(values), np.array(ones, np.int64)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing of counts[l] pieces of each length l has fewer sequences."""
    values, ones = dual_feasible(capacity)
    some = np.flatnonzero(counts)
    sums = [sum(int(v) * int(c) for v, c in zip(row, counts[some], strict=True)) for row in values[:, some]] \
        if int(counts.sum()) * int(values.max()) >= 2**62 else (values[:, some] @ counts[some].astype(np.int64)).tolist()
    return max((-(-s // int(one)) for s, one in zip(sums, ones, strict=True)), default=0)


_PACKED = "key bigint, length int, part bigint, bin int, place int, open boolean, bound int"


def _packed(pool: DataFrame, number: int, capacity: int, per_partition: int) -> DataFrame:
    """`pool` (key, length) dealt into partitions and packed; `open` marks what is released for another round."""
    parts = -(-pool.count() // per_partition) or 1

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, lengths = table["key"].to_numpy(), table["length"].to_numpy()
        order = np.lexsort((keys, -lengths.astype(np.int64)))
        keys, lengths = keys[order], lengths[order]
        sequence, place, room = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        if len(room) > bound:
            seeded = np.random.default_rng([number, key[0].as_py()])
            released = (room > 0) | (seeded.random(len(room)) < SHARE)
        else:
            released = (np.arange(len(room)) == room.argmax()) & (room > 0)
        n = len(keys)
        return pa.table({
            "key": keys, "length": lengths, "part": np.full(n, key[0].as_py(), np.int64), "bin": sequence.astype(np.int32),
            "place": place.astype(np.int32), "open": released[sequence], "bound": np.full(n, bound, np.int32)})

    dealt = pool.select("key", "length", F.pmod(F.xxhash64("key", F.lit(number)), F.lit(parts)).cast("bigint").alias("part"))
    return stored(dealt.groupBy("part").applyInArrow(pack, _PACKED), f"packing-round-{number}")


def _bins(packed: DataFrame) -> int:
    return packed.where("place = 0").count()


def _bound(pool: DataFrame, capacity: int) -> int:
    """The lower bound of a whole pool: at most one row per length comes to the driver."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pool.groupBy("length").count().collect():
        counts[length] = n
    return lower_bound(counts, capacity)


def packed(pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION, rounds: int = ROUNDS) -> DataFrame:
    """(key, sequence_id, offset, bound) of `pieces` (key, length); `bound` is the least number of sequences for all of them.

    Lengths run from 1 to `capacity`; keys differ.
    """
    pool = pieces.where(F.col("length") < capacity).select("key", F.col("length").cast("int").alias("length"))
    now = _packed(pool, 0, capacity, per_partition)
    least, used = _bound(now, capacity), _bins(now)
    done = []
    numbered = lambda rows, number: rows.select(
        "key", (F.lit(number << 56) + F.shiftleft("part", 24) + F.col("bin")).alias("sequence_id"), F.col("place").cast("bigint").alias("offset"))
    last = 0
    for number in range(1, rounds + 1):
        if used == least:
            break
        free = now.where("open")
        before = _bins(free)
        if before <= 1:
            break
        again = _packed(free.select("key", "length"), number, capacity, per_partition)
        after = _bins(again)
        if after >= before:
            break
        done.append(numbered(now.where("NOT open"), last))
        now, last, used = again, number, used - before + after
    done.append(numbered(now, last))
    full = pieces.where(F.col("length") == capacity)
    out = full.select("key", (-F.col("key") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    for rows in done:
        out = out.unionByName(rows)
    return out.withColumn("bound", F.lit(least).cast("bigint") + F.lit(full.count()))


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, doc_id, piece, start, length, ids, sequence_id, offset, bound): every piece with its ids and its place."""
    pieces = tokenised(docs, capacity, vocabulary)
    return pieces.join(packed(pieces.select("key", "length"), capacity), "key")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of what `packed_documents` returns: the ids of its pieces, one after the other."""
    members = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(members, F.lit(b""), lambda all_, one: F.concat(all_, one["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
