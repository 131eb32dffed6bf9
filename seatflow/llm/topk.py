"""Exact top-k by inner product with Fagin's threshold algorithm over sorted per-dimension lists.

Candidates and queries are dealt into blocks of bounded size, and every pair of blocks is one group: a
block of candidates keeps one list of its rows per dimension, sorted by that component. A query reads
all lists in step, from the top where its component is positive and from the bottom where it
is negative, scores each row when it is first seen, and stops when the best score that an unseen row
could reach is below its kth score. What the blocks return, k rows per query each, meets in one top-k.

Vectors that are NULL, or hold a NULL or a non-finite component, take no part. A vec_id that is NULL takes no part. Rows that share a
vec_id are candidates, and queries, of their own; only the query's own row is left out. A missing component of a shorter vector
counts as 0; vectors without components score 0. Ties go to the smaller vec_id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatflow.runtime import stored

CANDIDATES_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 1024
#: Entries read from each list before the bound is looked at again; doubles each time.
FIRST_STEP = 8


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, one row per row that takes part."""
    x = lambda c: c.cast("double")
    bad = lambda c: c.isNull() | F.isnan(x(c)) | (F.abs(x(c)) == float("inf"))
    v = F.transform("embedding", lambda c: F.floor(x(c) * scale))
    whole = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad)
    return embeddings.where(whole).select("vec_id", v.alias("v"))


class SortedLists:
    """A block of vectors with the order of its rows by each component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keys: np.ndarray | None = None):
        keys = ids if keys is None else keys  # what tells rows of the same id apart
        by_id = np.lexsort((keys, ids))
        self.ids, self.vectors, self.keys = ids[by_id], vectors[by_id], keys[by_id]
        # products are summed as doubles while that is exact
        bound = float(np.abs(vectors).max(initial=0)) ** 2 * vectors.shape[1]
        self.dense = self.vectors.astype(np.float64) if bound < 2**53 / 2 else self.vectors
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(self.vectors, self.order.T, axis=0).T.copy()

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, rows scored) of the k best rows for `query`, without the row whose key is `own`."""
        n, d = self.vectors.shape
        used = np.flatnonzero(query)
        if not len(used):
            rows = np.flatnonzero(self.keys != own)[:k]
            return self.ids[rows], np.zeros(len(rows), np.int64), len(rows)
        falling = query[used] > 0
        weights = query[used]
        factors = query.astype(self.dense.dtype)
        seen = np.zeros(n, bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, self.dense.dtype)
        depth, step, scored = 0, FIRST_STEP, 0
        while True:
            upto = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[used[falling], n - upto : n - depth]] = True
            fresh[self.order[used[~falling], depth:upto]] = True
            fresh &= ~seen
            seen |= fresh
            new = np.flatnonzero(fresh)
            scored += len(new)
            new_scores = self.dense[new] @ factors
            others = self.keys[new] != own
            rows, scores = np.concatenate([rows, new[others]]), np.concatenate([scores, new_scores[others]])
            if len(rows) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                some = scores >= kth
                rows, scores = rows[some], scores[some]
                best = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[best], scores[best]
            if upto == n or seen.all():
                break
            edge = np.where(falling, self.sorted[used, n - upto], self.sorted[used, upto - 1])
            if len(rows) == k and int((edge * weights).sum()) < int(scores.min()):
                break
            depth, step = upto, step * 2
        best = np.lexsort((rows, -scores))[:k]
        return self.ids[rows[best]], scores[best].astype(np.int64), scored


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row whose vec_id `every` divides."""
    rows = stored(quantised(embeddings, scale).withColumn("key", F.monotonically_increasing_id()), "topk-vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    n, m = rows.count(), asked.count()
    shards, blocks = -(-n // CANDIDATES_PER_BLOCK) or 1, -(-m // QUERIES_PER_BLOCK) or 1
    slot = lambda of: F.pmod(F.xxhash64("key"), F.lit(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    left = rows.select("vec_id", "key", "v", slot(shards).alias("shard"), each(blocks).alias("block"))
    right = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("own"), F.col("v").alias("q"), each(shards).alias("shard"), slot(blocks).alias("block"))

    def search(key, candidates: pd.DataFrame, queries: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(candidates) or not len(queries):
            return
        width = max(1, candidates["v"].map(len).max(), queries["q"].map(len).max())
        lists = SortedLists(candidates["vec_id"].to_numpy(np.int64), _matrix(candidates["v"], width), candidates["key"].to_numpy(np.int64))
        for query, own, vector in zip(
            queries["query_id"].to_numpy(np.int64), queries["own"].to_numpy(np.int64), _matrix(queries["q"], width), strict=True):
            ids, scores, scored = lists.top(vector, own, k)
            yield pd.DataFrame({"own": np.full(len(ids), own), "query_id": query, "vec_id": ids, "score": scores, "scored": scored})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        lambda key, a, b: pd.concat([*search(key, a, b), EMPTY]), "own long, query_id long, vec_id long, score long, scored long"
    )
    place = Window.partitionBy("own").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(place).cast("int")).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


EMPTY = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("own", "query_id", "vec_id", "score", "scored")})
