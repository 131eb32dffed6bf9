"""Whitening of embeddings: projection on the leading eigenvectors of their covariance, each scaled to variance 1.

Entries become whole numbers, so sums are exact in any order: one pass counts vectors and sums dimensions, a second
sums products of entries less the nearest whole mean, and the small rest of the mean is taken out exactly. A lost executor or another
partitioning changes no bit of the covariance. Tasks return a matrix each at most, Spark adds them up, and one matrix (its size is that of a
vector squared, whatever the number of vectors) reaches the driver. There Householder reflections make it
tridiagonal, Sturm counts and bisection give the leading eigenvalues, and inverse iteration their vectors; vectors of eigenvalues that
lie close together are made orthogonal to each other. A last pass projects all vectors on the few components, which it gets with its code.

Vectors that are NULL, or hold a NULL or a non-finite entry, or one beyond 2^40, take no part. Shorter vectors count as
if filled up with zeros to the longest one, of `MAX_WIDTH` entries at most; a longer one stops the fit with an error. Repeated rows and NULL or repeated ids
are rows like others. Fewer components than asked come back where the covariance has fewer eigenvalues beyond rounding: none for
an empty table, a single vector or equal vectors. Components of equal eigenvalues are some orthogonal basis of their space. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MAX_WIDTH = 2048
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Entries beyond this are no whole numbers that doubles and sums hold.
_LARGEST = float(2**40)
_EPS = np.finfo(float).eps


def usable(embeddings: DataFrame) -> DataFrame:
    """The rows whose vector takes part."""
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) > _LARGEST)
    return embeddings.where(F.col("embedding").isNotNull() & ~F.exists("embedding", bad))


def _whole(lists: pa.Array, width: int, scale: int, shift: int) -> np.ndarray:
    """The entries of a batch as whole numbers, floor(scale * entry) + shift, a row per vector."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    out = np.full((len(lengths), width), shift, np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = np.floor(flat * scale).astype(np.int64) + shift
    return out


def _products(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of `y`, as Python's whole numbers unless they fit into 63 bits."""
    most = int(np.abs(y).max(initial=0))
    rows = max(1, 2**53 // max(1, most * most))
    if most >= 2**26:
        own = y.astype(object)
        return own.T @ own
    total = np.zeros((y.shape[1], y.shape[1]), object if most * most * len(y) >= 2**62 else np.int64)
    doubles = y.astype(np.float64)
    for a in range(0, len(y), rows):  # doubles hold these sums exactly
        part = doubles[a : a + rows]
        total = total + (part.T @ part).astype(np.int64)
    return total


def householder(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(diagonal, off-diagonal, reflections) of a tridiagonal matrix similar to the symmetric `a`."""
    a = np.array(a, np.float64)
    n, reflections = len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.abs(x[1:]).max(initial=0.0)
        if size == 0:
            continue
        scaled = x / max(size, abs(x[0]))
        v = scaled.copy()
        v[0] += np.copysign(np.linalg.norm(scaled), scaled[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = 2 * (block @ v)
        w = p - (v @ p) * v
        block -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * v * (v @ x)
        a[k, k + 1 :] = a[k + 1 :, k]
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each number in `at`."""
    squares = np.concatenate([[0.0], off * off])
    least = max(np.finfo(float).tiny, squares.max(initial=0.0) * np.finfo(float).tiny * 4)
    counts, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for d, square in zip(diagonal, squares, strict=True):
        q = d - at - square / q
        q = np.where(np.abs(q) < least, -least, q)
        counts += q < 0
    return counts


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection to the last bits."""
    n = len(diagonal)
    k = min(k, n)
    beside = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low_end, high_end = float((diagonal - beside).min()), float((diagonal + beside).max())
    pad = 4 * n * _EPS * max(abs(low_end), abs(high_end)) + np.finfo(float).tiny
    low, high = np.full(k, low_end - pad), np.full(k, high_end + pad)
    below = n - 1 - np.arange(k)  # eigenvalues below the wanted one
    for _ in range(200):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        upper = sturm_counts(diagonal, off, middle) > below
        high, low = np.where(upper, middle, high), np.where(upper, low, middle)
    return low + (high - low) / 2


def _factors(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """Gauss elimination with row exchanges of the tridiagonal matrix less `value`: rows of three, multipliers, exchanges."""
    n = len(diagonal)
    d, u, s = diagonal - value, np.append(off, 0.0), np.zeros(n)
    multipliers, exchanged = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        below = off[i]
        if abs(below) > abs(d[i]):
            exchanged[i] = True
            multipliers[i] = d[i] / below
            after = u[i + 1]
            d[i], u[i], s[i], d[i + 1], u[i + 1] = below, d[i + 1], after, u[i] - multipliers[i] * d[i + 1], -multipliers[i] * after
        else:
            d[i] = d[i] if abs(d[i]) > least else least
            multipliers[i] = below / d[i]
            d[i + 1] -= multipliers[i] * u[i]
    d[-1] = d[-1] if abs(d[-1]) > least else least
    return d, u, s, multipliers, exchanged


def _solved(factors, b: np.ndarray) -> np.ndarray:
    d, u, s, multipliers, exchanged = factors
    x, n = b.copy(), len(b)
    for i in range(n - 1):
        if exchanged[i]:
            x[i], x[i + 1] = x[i + 1], x[i] - multipliers[i] * x[i + 1]
        else:
            x[i + 1] -= multipliers[i] * x[i]
    for i in range(n - 1, -1, -1):
        later = (u[i] * x[i + 1] if i + 1 < n else 0.0) + (s[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - later) / d[i]
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors as columns; those of a cluster are made orthogonal to the earlier ones of it in every round."""
    n = len(diagonal)
    norm = float((np.abs(diagonal) + np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])).max())
    least = max(_EPS * norm, np.finfo(float).tiny)
    out, first, shift = np.zeros((n, len(values))), 0, 0.0
    rng = np.random.default_rng(1)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # equal values get shifts apart, else all would run to one vector
        shift = float(value) if j == first else min(float(value), shift - 10 * _EPS * norm)
        factors, cluster = _factors(diagonal.copy(), off, shift, least), out[:, first:j]
        x = rng.normal(size=n)
        for _ in range(rounds):
            x /= np.abs(x).max()
            x = _solved(factors, x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= cluster @ (cluster.T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the k largest of a symmetric matrix."""
    n = len(matrix)
    if n == 0:
        return np.zeros(0), np.zeros((0, 0))
    size = float(np.abs(matrix).max()) or 1.0
    diagonal, off, reflections = householder(matrix / size)
    values = leading(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for start, v in reversed(reflections):
        vectors[start:] -= 2 * np.outer(v, v @ vectors[start:])
    return values * size, vectors / np.linalg.norm(vectors, axis=0)


@dataclass
class Whitening:
    """What projects a vector: of the size of a vector times the number of components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int
    shift: int
    #: The covariance that the components came from.
    covariance: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole numbers; the mean is taken off exactly before it is rounded."""
        near = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return ((x - near).astype(np.float64) - rest) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * entry - sum)^2; None where that is beyond a long."""
        sums = np.array(self.sums, object)
        most = int(np.abs(x).max(initial=0))
        if (self.n * most + max(map(abs, self.sums), default=0)) ** 2 * self.width < 2**63:
            apart = self.n * x - sums.astype(np.int64)
            return (apart * apart).sum(axis=1).tolist()
        near = np.array([s // self.n for s in self.sums], np.int64)
        close, rest = x - near, np.array([s % self.n for s in self.sums], np.int64)  # n * x - sum = n * close - rest
        if (self.n * (int(np.abs(close).max(initial=0)) + 1)) ** 2 * self.width < 2**63:
            apart = self.n * close - rest
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in (self.n * x.astype(object) - sums).tolist()]
        return [v if v < 2**63 else None for v in exact]


def fit(embeddings: DataFrame, k: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening:
    """The k leading components of all vectors that take part."""
    rows = usable(embeddings).select("embedding")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} entries; at most {MAX_WIDTH} fit the covariance")
    none = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, scale, shift, np.zeros((0, 0)))
    if not width:
        return none

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = _whole(batch.column(0), width, scale, shift)
            n, total = n + len(x), total + x.sum(axis=0, dtype=np.int64)
        if n:
            yield pa.RecordBatch.from_pydict({"i": [-1, *range(width)], "v": [str(n), *map(str, total)]}, schema=pa.schema([("i", pa.int32()), ("v", pa.string())]))

    sums = rows.mapInArrow(summed, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r.i: int(r.v) for r in sums.collect()}
    n = found.pop(-1)
    totals = [found[i] for i in range(width)]
    near = np.array([round(Fraction(t, n)) for t in totals], np.int64)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            total = total + _products(_whole(batch.column(0), width, scale, shift) - near)
        for i in range(width):
            if any(total[i]):
                yield pa.RecordBatch.from_pydict(
                    {"i": [i], "v": [list(map(str, total[i, : i + 1]))]}, schema=pa.schema([("i", pa.int32()), ("v", pa.list_(pa.string()))]))

    products = rows.mapInArrow(multiplied, "i int, v array<string>").select("i", F.posexplode("v").alias("j", "v"))
    products = products.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    apart = [t - n * int(c) for t, c in zip(totals, near, strict=True)]  # what the whole means leave
    exact = {(r.i, r.j): int(r.v) for r in products.collect()}
    covariance = np.zeros((width, width))
    for i in range(width):
        for j in range(i + 1):
            value = (n * exact.get((i, j), 0) - apart[i] * apart[j]) / (n * n)  # one rounding, of an exact quotient
            covariance[i, j] = covariance[j, i] = value
    trace = float(sum(Fraction(n * exact.get((i, i), 0) - apart[i] ** 2, n * n) for i in range(width)))
    values, vectors = eigenpairs(covariance, k)
    real = values > width * 64 * _EPS * max(trace, 0.0)
    return Whitening(n, totals, values[real], vectors[:, real], trace, scale, shift, covariance)


def whitened(embeddings: DataFrame, model: Whitening) -> DataFrame:
    """The rows that take part, with `whitened` (an entry per component) and `deviation`; replaces columns of those names."""
    rows = usable(embeddings).drop("whitened", "deviation")
    at, names = rows.columns.index("embedding"), rows.columns
    if not model.n:
        return rows.where("false").withColumns({"whitened": F.lit(None).cast("array<double>"), "deviation": F.lit(None).cast("bigint")})

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _whole(batch.column(at), model.width, model.scale, model.shift)
            z, k = model.project(x), len(model.values)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(model.deviations(x), pa.int64())], [*names, "whitened", "deviation"])

    schema = StructType([*rows.schema.fields, *StructType.fromDDL("whitened array<double>, deviation bigint").fields])
    return rows.mapInArrow(project, schema)


def identity_error(rows: DataFrame, k: int) -> float | None:
    """The largest absolute entry of the covariance of `whitened` less the identity, measured over all rows."""
    if not k:
        return None

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, sums = 0, np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            n, total, sums = n + len(z), total + z.T @ z, sums + z.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(1 + k + k * k), pa.int32()), pa.array(np.concatenate([[n], sums, total.ravel()]))], ["i", "v"])

    parts = rows.select("whitened").mapInArrow(multiplied, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    if not parts:
        return None
    found = np.zeros(1 + k + k * k)
    for i, v in parts:
        found[i] = v
    mean = found[1 : 1 + k] / found[0]
    covariance = found[1 + k :].reshape(k, k) / found[0] - np.outer(mean, mean)  # means are 0 but for rounding
    return float(np.abs(covariance - np.eye(k)).max())
