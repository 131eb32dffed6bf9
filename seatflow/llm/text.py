"""Words and their hashes for whole Arrow batches of texts, as numpy arrays.

A batch is cut into chunks of a bounded number of bytes (a longer text is a chunk of its own), so
that a task's memory does not follow its partition. Words are runs of bytes that a table marks; all
bytes of a character beyond ASCII belong to words, so UTF-8 bytes and code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

#: Multipliers of the multilinear hash, one per place in a word, and of the words of a shingle.
_PLACES = np.random.default_rng(20240229).integers(1, 2**63, size=1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_table(separators: list[tuple[int, int]]) -> np.ndarray:
    """256 flags: which bytes belong to words; `separators` are closed ranges of bytes that do not."""
    table = np.ones(256, bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


#: Fixed values: `[^\\x20\\x09-\\x0D]+` and, after lower-casing, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`.
SPACED = word_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = word_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of rows) of consecutive rows; NULL counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the total) of the words in lower-cased `data`.

    A word never crosses the end of a row.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = table[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = offsets[:-1][np.diff(offsets) > 0]
    begins[rows] = inside[rows]
    starts = np.flatnonzero(begins)
    stops = np.zeros(len(data) + 1, bool)
    stops[1:] = inside[:-1] & ~inside[1:]
    stops[rows] |= inside[rows - 1] & (rows > 0)
    return starts, np.flatnonzero(stops), np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """`data` with A-Z in lower case, other bytes as they are."""
    return _LOWER[data]


def _long_word(own: np.ndarray) -> np.uint64:
    n = len(own)
    factors = _PLACES[:n]
    if n > len(_PLACES):
        factors = np.concatenate([_PLACES, mixed(np.arange(len(_PLACES), n, dtype=np.uint64)) | np.uint64(1)])
    return ((own.astype(np.uint64) + np.uint64(1)) * factors).sum(dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, short: int = 64) -> np.ndarray:
    """A 64-bit hash of each word: multilinear over its bytes, then mixed."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    for i in np.flatnonzero(lengths > short):
        out[i] = _long_word(data[starts[i] : ends[i]])
    some = np.flatnonzero(lengths <= short)
    order = some[np.argsort(-lengths[some].astype(np.int16), kind="stable")]  # longest first: place j concerns a prefix
    at, sums = starts[order], np.zeros(len(order), np.uint64)
    reach = np.searchsorted(-lengths[order], -np.arange(short), side="left")
    for j in range(short):
        if not (k := reach[j]):
            break
        sums[:k] += (data[at[:k] + j].astype(np.uint64) + np.uint64(1)) * _PLACES[j]
    out[order] = sums
    return mixed(out)


_STEPS = np.random.default_rng(7).integers(1, 2**63, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles, sorted per row; bounds per row) from words and their bounds per row.

    A row of fewer words than `width`, but not none, has its whole sequence as its only shingle.
    """
    counts = np.diff(bounds)
    n = len(hashes)
    full = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        full += hashes[j : j + len(full)] * _STEPS[j]
    full = mixed(full)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(edges[-1], np.uint64)
    for i in range(len(counts)):
        a, b, at = edges[i], edges[i + 1], bounds[i]
        if counts[i] >= width:
            out[a:b] = full[at : at + b - a]
            out[a:b].sort()
        elif counts[i]:
            whole = (hashes[at : at + counts[i]] * _STEPS[: counts[i]]).sum(dtype=np.uint64)
            out[a] = mixed(np.array([whole + np.uint64(counts[i])], np.uint64))[0]
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[edges[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[edges]
