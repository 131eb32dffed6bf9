"""Ranked lexical search: for each item the k documents whose terms weigh most, exactly, by a hybrid of two ways to read lists.

The items asked for, in blocks of bounded size, name the terms. One pass over all documents cuts whole texts into terms and
writes an index in shards of bounded size: for every term asked for its list of documents and occurrences, and the counts
that weights need. Sums over the shards give the weights. A second pass searches shard by shard:

- Term at a time: an item's short lists are added up into accumulators, one sum per document that any of them names.
- Document at a time: the accumulators then count as one more list, bounded by its largest sum, beside the long lists. Lists are read
  in step, a window of documents after the other. A window whose lists' largest weights cannot reach the kth score is
  skipped. In others, lists that cannot reach it together are not read, only asked for the documents that the rest
  names, the one with the largest weight first, while a document can still reach the kth score.

The kth score starts from the accumulators and carries over from shard to shard of a task. What tasks return, k rows per item each, meets in one ranking.

NULL and empty texts have no terms. NULL or repeated ids of documents or items are rows like others; equal scores go
by ascending doc_id, NULL last. An item without terms, or none of whose terms has weight in any document, has no rows; nor has an
empty table. Long texts are read whole. Terms are told apart by 64-bit hashes. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatflow.llm.text import ALNUM, chunks, lowered, word_hashes, words
from seatflow.runtime import stored

#: Bytes of item texts whose terms one block asks for; each block reads the documents once.
BLOCK_BYTES = 8 << 20
SHARD_DOCS, SHARD_BYTES = 8192, 16 << 20
#: Documents of a window, and postings that short lists hold together.
WINDOW = 512
ACCUMULATED = 2048


def _terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, hashes of the terms, bounds per row)."""
    for first, last, data, offsets in chunks(texts):
        data = lowered(data)
        starts, ends, bounds = words(data, offsets, ALNUM)
        yield first, last, word_hashes(data, starts, ends), bounds


def asked(items: DataFrame) -> DataFrame:
    """(key, item_id, block, terms) of the items, `terms` the distinct hashes. Stored."""
    numbered = items.select("item_id", "text").withColumn("key", F.monotonically_increasing_id())
    kind = items.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, bounds in _terms(batch.column(1)):
                lists = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([rows.column(2), rows.column(0), pa.array(lists, pa.list_(pa.int64()))], ["key", "item_id", "terms"])

    rows = stored(numbered.mapInArrow(cut, f"key bigint, item_id {kind}, terms array<bigint>"), "ranked-items")
    held = rows.agg(F.sum(8 * F.size("terms"))).first()[0] or 0
    blocks = -(-held // BLOCK_BYTES) or 1
    return rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))


def _shard(ids: list, sizes: list, rows: list, terms: list, counts: list) -> dict:
    """A shard's documents in order of id and, per term, those that hold it."""
    ids, sizes, rows = pa.concat_arrays(ids), np.concatenate(sizes), np.concatenate(rows)
    terms, counts = np.concatenate(terms), np.concatenate(counts)
    order = pc.array_sort_indices(ids, null_placement="at_end").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    held, docs = np.unique(place[rows], return_inverse=True)
    by = np.lexsort((docs, terms))
    own, starts = np.unique(terms[by], return_index=True)
    return {
        "n_docs": int((sizes > 0).sum()), "n_terms": int(sizes.sum()), "ids": ids.take(pa.array(order[held])), "sizes": sizes[order[held]],
        "terms": own, "starts": np.append(starts, len(by)), "docs": docs[by], "counts": counts[by]}


def indexed(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """The index of the terms in `vocabulary` (sorted hashes): a row per shard. Stored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = ["sizes", "terms", "starts", "docs", "counts"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, n_bytes = ([], [], [], [], []), 0, 0

        def flush() -> pa.RecordBatch:
            shard = _shard(*held)
            whole = lambda name: pa.array([shard[name]], pa.list_(pa.int32()))
            ids = pa.ListArray.from_arrays(pa.array([0, len(shard["ids"])], pa.int32()), shard["ids"])
            return pa.RecordBatch.from_arrays(
                [pa.array([shard["n_docs"]]), pa.array([shard["n_terms"]]), ids, *map(whole, lists)], ["n_docs", "n_terms", "ids", *lists])

        for batch in batches:
            for first, last, hashes, bounds in _terms(batch.column(1)):
                sizes = np.diff(bounds)
                at = np.searchsorted(vocabulary, hashes)
                at[at == len(vocabulary)] = 0
                known = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
                row = np.repeat(np.arange(len(sizes)), sizes)[known]
                pairs, counts = np.unique(row * max(1, len(vocabulary)) + at[known], return_counts=True)
                row, term = np.divmod(pairs, max(1, len(vocabulary)))
                for of, values in zip(held, (batch.column(0).slice(first, last - first), sizes, row + n, term, counts), strict=True):
                    of.append(values)
                n, n_bytes = n + last - first, n_bytes + 8 * len(hashes)
                if n >= SHARD_DOCS or n_bytes >= SHARD_BYTES:
                    yield flush()
                    held, n, n_bytes = ([], [], [], [], []), 0, 0
        if n:
            yield flush()

    schema = f"n_docs bigint, n_terms bigint, ids array<{kind}>, " + ", ".join(f"{name} array<int>" for name in lists)
    return stored(docs.select("doc_id", "text").mapInArrow(build, schema), "ranked-index")


def weights(index: DataFrame, n_docs: int, n_vocabulary: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) of each term of a block: one row per term comes to the driver."""
    lengths = F.transform(F.sequence(F.lit(1), F.size("terms")), lambda i: F.element_at("starts", i + 1) - F.element_at("starts", i))
    rows = index.where(F.size("terms") > 0).select(F.explode(F.arrays_zip(F.col("terms").alias("term"), lengths.alias("n"))).alias("x"))
    out = np.zeros(n_vocabulary, np.int64)
    for term, df in rows.groupBy("x.term").agg(F.sum("x.n")).collect():
        out[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return out


class Shard:
    """A shard's lists with the largest weight of each list in each window."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, starts: np.ndarray, docs: np.ndarray, counts: np.ndarray,
                 weight: np.ndarray, n_docs: int, n_terms: int):
        self.docs, self.terms, self.n = docs.astype(np.int64), terms, len(sizes)
        self.starts, self.sizes = starts, np.diff(starts)
        n = sizes.astype(np.int64)
        if 90 * int(n.max(initial=0)) * n_docs >= 2**63:
            n = n.astype(object)
        m = (10 + 90 * n * n_docs // max(1, n_terms)).astype(np.int64)
        tf = counts.astype(np.int64)
        term = np.repeat(np.arange(len(terms)), self.sizes)
        self.impacts = weight[terms][term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.docs]))
        self.windows = -(-self.n // WINDOW)
        self.most = np.zeros((len(terms), self.windows), np.int64)
        np.maximum.at(self.most, (term, self.docs // WINDOW), self.impacts)
        # where each list enters each window
        keys = term * (self.n + WINDOW) + self.docs
        edges = np.arange(self.windows + 1) * WINDOW
        self.edges = np.searchsorted(keys, np.arange(len(terms))[:, None] * (self.n + WINDOW) + edges)

    def _accumulated(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and their sums over whole lists, read term by term."""
        if not len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spans = [slice(self.starts[i], self.starts[i + 1]) for i in lists]
        docs, impacts = np.concatenate([self.docs[s] for s in spans]), np.concatenate([self.impacts[s] for s in spans])
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        return docs[first], np.add.reduceat(impacts[order], first)

    def top(self, wanted: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, postings read in step) of the k best with a score of `least` or more, and above 0."""
        at = np.searchsorted(self.terms, wanted)
        at = at[at < len(self.terms)]
        lists = at[np.isin(self.terms[at], wanted)]
        lists = lists[self.most[lists].any(axis=1)] if len(lists) else lists
        lists = np.unique(lists)
        lists = lists[np.argsort(self.sizes[lists], kind="stable")]
        short = int(np.searchsorted(np.cumsum(self.sizes[lists]), ACCUMULATED, side="right"))
        sum_docs, sums = self._accumulated(lists[:short])
        long = lists[short:]
        least = max(1, least)
        if len(sums) >= k:
            least = max(least, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        bounds = np.zeros((len(long) + 1, self.windows), np.int64)
        bounds[:-1] = self.most[long]
        np.maximum.at(bounds[-1], sum_docs // WINDOW, sums)
        sum_edges = np.searchsorted(sum_docs, np.arange(self.windows + 1) * WINDOW)
        best_docs, best, read = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        reach = bounds.sum(axis=0)
        for w in range(self.windows):
            if reach[w] < least:
                continue
            order = np.argsort(bounds[:, w], kind="stable")
            upto = np.cumsum(bounds[order, w])
            asked_only = int(np.searchsorted(upto, least))  # these lists cannot reach the kth score together
            scores = np.zeros(WINDOW, np.int64)

            def part(i: int, w: int = w) -> tuple[np.ndarray, np.ndarray]:
                if i == len(long):
                    a, b = sum_edges[w], sum_edges[w + 1]
                    return sum_docs[a:b] - w * WINDOW, sums[a:b]
                a, b = self.edges[long[i], w], self.edges[long[i], w + 1]
                return self.docs[a:b] - w * WINDOW, self.impacts[a:b]

            for i in order[asked_only:]:
                docs, impacts = part(i)
                scores[docs] += impacts
                read += len(docs)
            found = np.flatnonzero(scores)
            for j in range(asked_only - 1, -1, -1):
                found = found[scores[found] + upto[j] >= least]
                if not len(found):
                    break
                docs, impacts = part(order[j])
                if not len(docs):
                    continue
                place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                same = docs[place] == found
                scores[found[same]] += impacts[place[same]]
            found = found[scores[found] >= least]
            if len(found):
                best_docs, best = np.concatenate([best_docs, found + w * WINDOW]), np.concatenate([best, scores[found]])
                if len(best) > k:
                    keep = np.lexsort((best_docs, -best))[:k]
                    best_docs, best = best_docs[keep], best[keep]
                if len(best) == k:
                    least = max(least, int(best.min()))
        keep = np.lexsort((best_docs, -best))
        return best_docs[keep], best[keep], read


def _searched(index: DataFrame, items: list[tuple[int, np.ndarray]], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(key, doc_id, score): the k best of every task's shards, per item."""
    kind = index.schema["ids"].dataType.elementType.simpleString()
    names = ["sizes", "terms", "starts", "docs", "counts"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        id_type = None
        for batch in batches:
            ids = batch.column(0)
            id_type = ids.type.value_type
            for row in range(len(batch)):
                arrays = [batch.column(1 + j)[row].values.to_numpy(zero_copy_only=False) for j in range(len(names))]
                if not len(arrays[0]):
                    continue
                shard, own = Shard(*arrays, weight, n_docs, n_terms), ids[row].values
                for key, wanted in items:
                    had = best.get(key, [])
                    docs, scores, _ = shard.top(wanted, k, had[-1][0] if len(had) == k else 0)
                    if len(docs):
                        had = had + list(zip(scores.tolist(), own.take(pa.array(docs)).to_pylist(), strict=True))
                        best[key] = sorted(had, key=lambda r: (-r[0], True) if r[1] is None else (-r[0], False, r[1]))[:k]
        rows = [(key, doc, score) for key, found in best.items() for score, doc in found]
        if rows:
            keys, docs, scores = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(docs, id_type), pa.array(scores, pa.int64())], ["key", "doc_id", "score"])

    return index.select("ids", *names).mapInArrow(search, f"key bigint, doc_id {kind}, score bigint")


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0."""
    rows, out = asked(items), None
    place = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for block in sorted(r.block for r in rows.select("block").distinct().collect()) or [0]:
        own = [(r.key, np.array(r.terms, np.int64).view(np.uint64)) for r in rows.where(F.col("block") == block).select("key", "terms").collect()]
        vocabulary = np.unique(np.concatenate([t for _, t in own] or [np.zeros(0, np.uint64)]))
        index = indexed(docs, vocabulary)
        n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        wanted = [(key, np.searchsorted(vocabulary, t).astype(np.int32)) for key, t in own if len(t)]
        found = _searched(index, wanted, weights(index, n_docs, len(vocabulary)), n_docs, n_terms, k)
        found = found.withColumn("rank", F.row_number().over(place).cast("int")).where(F.col("rank") <= k)
        out = found if out is None else out.unionByName(found)
    return out.join(rows.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
