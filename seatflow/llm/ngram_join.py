"""Exact self-join of documents by the Jaccard distance of their word shingles, in a metric space.

Distinct sets of shingles are the points; copies share a point. Three steps, none of which emits the
pairs of a group:

1. Neighbourhoods. In this space nearly all distances are 1, and pivots drawn at random would share nothing with nearly all
   points. So points first meet through their rare shingles: linked sets share at least `OVERLAP` of
   the first ones in a common order, the rarer first (an estimate from fixed-size counters over all documents). Holders
   of one of these are cut where sizes jump too far for a link. Up to `FEW` holders are counted as pairs; more form a region.
2. Projection. Counts of a set's shingles by hash class form a vector, and the weighted Jaccard distance of these
   vectors is a metric that never exceeds the distance of the sets. Points whose
   vectors are too far apart are not linked; what remains connected forms a group.
3. Regions. Inside a group, pivots create Voronoi regions, and a point is copied to every region whose pivot is at most
   two radii farther than its own, by the triangle inequality. Regions are joined recursively; what no longer shrinks is compared
   exactly, point by point, skipping what is already connected. Groups too large for a task are
   split the same way by Spark; regions that do not shrink are compared in blocks.

Words are runs without white space, A-Z lower-cased; a text of fewer words than a shingle has its whole sequence as its only
shingle. NULL and empty texts have no shingles and link with nothing: each is its own component. Rows that repeat a doc_id are documents of their own; a component's id is the
smallest doc_id in it, NULL only if all are. Shingles and sets compare by 64-bit hashes. Other columns are
ignored, apart from `deduplicated`, which keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatflow.llm import text as words_of
from seatflow.llm.components import components
from seatflow.llm.hot import left_join
from seatflow.runtime import stored

WIDTH = 4
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 85
OVERLAP = 4
FEW = 16
CLASSES = 256
COUNTERS = 20
#: Holders of one shingle that one task may get; beyond that they are dealt to several.
ENTRIES_PER_TASK = 2_000_000
MEMBERS_PER_TASK = 512
VECTORS_PER_TASK = 4096
PIVOTS = 8
LEAF = 64
_BITMAP = 25
_FLUSH = 1 << 20
_SALT = np.uint64(0x9E3779B97F4A7C15)


def needed(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of `n` must share with any set that it links with."""
    return (PERCENT * n + 99) // 100


def linked(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * common >= PERCENT * (n + m - common)


def distance(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1.0 - common / np.maximum(n + m - common, 1)


RADIUS = 1 - PERCENT / 100


def sets_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, sorted distinct shingles of all rows, bounds) per chunk."""
    for first, last, data, offsets in words_of.chunks(texts):
        data = words_of.lowered(data)
        starts, ends, bounds = words_of.words(data, offsets, words_of.SPACED)
        found, edges = words_of.shingles(words_of.word_hashes(data, starts, ends), bounds, WIDTH)
        yield first, last, found, edges


def keys_of(found: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A 64-bit number per set, the same for equal sets."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words_of.mixed(found ^ _SALT), dtype=np.uint64)])
    n = np.diff(edges).astype(np.uint64)
    return words_of.mixed(sums[edges[1:]] - sums[edges[:-1]] + n * _SALT).view(np.int64)


def _vector(own: np.ndarray) -> bytes:
    counts = np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=CLASSES)
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size, key and vector; at the end one row with the task's counters."""
    counters = np.zeros(1 << COUNTERS, np.int64)
    kind = pa.schema([("row", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("vector", pa.binary()), ("counters", pa.binary())])
    names = None
    for batch in batches:
        names = names or [batch.schema.field(0), *kind]
        for first, last, found, edges in sets_of(batch.column(2)):
            n = np.diff(edges)
            counters += np.bincount((found >> np.uint64(64 - COUNTERS)).astype(np.int64), minlength=1 << COUNTERS)
            vectors = [_vector(found[a:b]) if b > a else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
            rows = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(1), pa.array(n, pa.int64()), pa.array(keys_of(found, edges), mask=n == 0),
                pa.array(vectors, pa.binary()), pa.nulls(last - first, pa.binary()),
            ], schema=pa.schema(names))
    if names:
        packed = zstandard.ZstdCompressor(level=1).compress(counters.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, names[0].type), *[pa.nulls(1, f.type) for f in names[1:-1]], pa.array([packed], pa.binary())], schema=pa.schema(names))


def _frequencies(profiles: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """How frequent the shingles of each counter are, as small numbers, 0 where nothing stands out; and
    the counters whose shingles may have too many holders for a task, with the tasks that they need."""
    total = np.zeros(1 << COUNTERS, np.int64)
    for row in profiles.where("counters IS NOT NULL").select("counters").toLocalIterator():  # a row of fixed size per task
        total += np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row[0])), np.int64)
    usual = float(np.median(total))
    over = np.maximum(0, total - usual) / (3 * np.sqrt(max(usual, 1)))
    hot = np.flatnonzero(total > ENTRIES_PER_TASK)
    return np.minimum(np.floor(np.log2(1 + over)), 255).astype(np.uint8), {int(i): int(-(-total[i] // ENTRIES_PER_TASK)) for i in hot}


def _firsts(found: np.ndarray, edges: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each set's first shingles in the common order (level, hash), and how many per set."""
    level = levels[(found >> np.uint64(64 - COUNTERS)).astype(np.int64)]
    n = np.diff(edges)
    enough = needed(n)
    length = n - enough + np.minimum(OVERLAP, enough)
    out = []
    for a, b, k in zip(edges[:-1], edges[1:], length, strict=True):
        own = level[a:b]
        out.append(a + (np.argsort(own, kind="stable")[:k] if own.any() else np.arange(k)))
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), length


def _holders(rows: pd.DataFrame, dealt: bool) -> pd.DataFrame:
    """Pairs, and regions of more than `FEW`, among the holders of each shingle of one range.

    Where the holders of a shingle are `dealt` to several tasks, all of them are members of its region.
    """
    load = lambda c, kind: np.concatenate([np.frombuffer(b, kind) for b in rows[c]])
    shingle, key, n = load("shingles", np.uint64), load("keys", np.int64), load("sizes", np.uint32).astype(np.int64)
    order = np.lexsort((key, n, shingle))
    shingle, key, n = shingle[order], key[order], n[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])
    shingle, key, n = shingle[fresh], key[fresh], n[fresh]
    if dealt:
        return pd.DataFrame({"region": words_of.mixed(shingle ^ _SALT).view(np.int64), "a": key, "b": 0, "need": 0, "shared": 0})
    begins = np.ones(len(key), bool)
    begins[1:] = (shingle[1:] != shingle[:-1]) | (100 * n[:-1] < PERCENT * n[1:])
    start = np.flatnonzero(begins)
    size = np.diff(np.append(start, len(key)))
    a, b = [], []
    for g in range(2, FEW + 1):
        own = start[size == g]
        i, j = np.triu_indices(g, 1)
        a.append((own[:, None] + i).ravel())
        b.append((own[:, None] + j).ravel())
    a, b = np.concatenate(a), np.concatenate(b)
    fits = 100 * n[a] >= PERCENT * n[b]
    a, b = a[fits], b[fits]
    share = np.minimum(OVERLAP, needed(n))
    pairs = pd.DataFrame({
        "region": 0, "a": np.minimum(key[a], key[b]), "b": np.maximum(key[a], key[b]), "need": np.minimum(share[a], share[b]), "shared": 1,
    }).groupby(["region", "a", "b", "need"], as_index=False)["shared"].sum()
    large = np.flatnonzero(size > FEW)
    seen, parts = set(), [pairs]
    for s, g in zip(start[large], size[large], strict=True):
        own = key[s : s + g]
        name = int(words_of.mixed(np.array([words_of.mixed(own.view(np.uint64)).sum(dtype=np.uint64)]) + np.uint64(g)).view(np.int64)[0])
        if name not in seen:  # shingles with the same holders make the same region
            seen.add(name)
            parts.append(pd.DataFrame({"region": name or 1, "a": own, "b": 0, "need": 0, "shared": 0}))
    return pd.concat(parts)[["region", "a", "b", "need", "shared"]]


def _stacked(vectors) -> np.ndarray:
    wide = [np.frombuffer(v, np.uint8 if len(v) == CLASSES else np.uint32) for v in vectors]
    return np.stack([v.astype(np.uint32) for v in wide]) if any(v.dtype != np.uint8 for v in wide) else np.stack(wide)


def _near_vectors(rows: pd.DataFrame) -> np.ndarray:
    """A number per row, equal for rows that steps within the radius connect in the projection."""
    vectors = _stacked(rows["vector"])
    n = vectors.sum(1, dtype=np.int64)
    label = np.arange(len(rows))
    left = np.arange(len(rows))
    while len(left):
        queue, left = [left[0]], left[1:]
        root = queue[0]
        while queue and len(left):
            x = queue.pop()
            common = np.minimum(vectors[left], vectors[x]).sum(1, dtype=np.int64)
            near = linked(common, n[left], n[x])
            label[left[near]] = root
            queue += left[near].tolist()
            left = left[~near]
    return label


class Points:
    """Sets of shingles of one region, with fast counts of what one shares with others."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.n)])
        _, self.codes = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_inverse=True)
        self.mark = np.zeros(int(self.codes.max(initial=-1)) + 1, bool)
        self.root = np.arange(len(sets))

    def own(self, i: int) -> np.ndarray:
        return self.codes[self.starts[i] : self.starts[i + 1]]

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        self.mark[self.own(i)] = True
        codes = np.concatenate([self.own(j) for j in others]) if len(others) else np.zeros(0, np.int64)
        sums = np.concatenate([[0], np.cumsum(self.mark[codes])])
        self.mark[self.own(i)] = False
        at = np.concatenate([[0], np.cumsum(self.n[others])])
        return sums[at[1:]] - sums[at[:-1]]

    def join(self, i: int, others: np.ndarray) -> None:
        """Put the components of `others` and of `i` together."""
        roots = np.unique(np.append(self.root[others], self.root[i]))
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def connect(self, members: np.ndarray) -> None:
        """Join one region recursively and exactly."""
        if len(np.unique(self.root[members])) < 2:
            return
        if len(members) <= LEAF:
            return self._compare(members, None)
        pivots = members[:: len(members) // PIVOTS][:PIVOTS]
        away = np.stack([distance(self.common(p, members), self.n[members], self.n[p]) for p in pivots], 1)
        for q, p in enumerate(pivots):
            self.join(p, members[away[:, q] <= RADIUS + 1e-12] if PERCENT < 100 else members[away[:, q] == 0])
        nearest = away.min(1)
        regions = [members[away[:, q] <= nearest + 2 * RADIUS + 1e-9] for q in range(len(pivots))]
        own = away.argmin(1)
        if max(map(len, regions)) > 0.8 * len(members):
            return self._compare(members, away)
        for q, region in enumerate(regions):
            if (own == q).any():
                self.connect(region)

    def _compare(self, members: np.ndarray, away: np.ndarray | None) -> None:
        """Each point against the later ones of other components that no pivot rules out."""
        for at, i in enumerate(members[:-1]):
            rest = np.arange(at + 1, len(members))
            rest = rest[self.root[members[rest]] != self.root[i]]
            if away is not None and len(rest):
                rest = rest[np.abs(away[rest] - away[at]).max(1) <= RADIUS + 1e-9]
            others = members[rest]
            if len(others):
                found = linked(self.common(i, others), self.n[others], self.n[i])
                if found.any():
                    self.join(i, others[found])


def _connected(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that connect the exact components of one region's rows (key, shingles)."""
    rows = rows.drop_duplicates("key").sort_values("key")
    points = Points([np.frombuffer(b, np.uint64) for b in rows["shingles"]])
    points.connect(np.arange(len(rows)))
    key = rows["key"].to_numpy(np.int64)
    return pd.DataFrame({"a": key, "b": key[points.root]}).query("a != b")


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n, key, vector, counters): one row per document, and one of counters per task."""
    doc_id = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    return stored(rows.mapInArrow(_profiles, f"doc_id {doc_id}, row long, n long, key long, vector binary, counters binary"), "profiles")


def candidates(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) keys of points whose vectors are near: enough to connect every pair of linked points."""
    spark = docs.sparkSession
    levels, hot = _frequencies(found)
    levels, hot = spark.sparkContext.broadcast(levels), spark.sparkContext.broadcast(hot)
    points = found.where("key IS NOT NULL")
    total = points.agg(F.sum("n")).first()[0] or 0
    bits = max(8, int(total * (100 - PERCENT) / 100 / 2e6).bit_length())  # ranges of about two million entries

    def first_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def flush() -> Iterator[pa.RecordBatch]:
            shingle, key, n = (np.concatenate(c) for c in zip(*held, strict=True))
            at = (shingle >> np.uint64(64 - bits)).astype(np.int64) << 32  # the range, and the deal of a hot shingle
            counter = (shingle >> np.uint64(64 - COUNTERS)).astype(np.int64)
            for i in np.flatnonzero(np.isin(counter, list(hot.value))):
                at[i] += 1 + int(words_of.mixed(key[i : i + 1].view(np.uint64))[0] % np.uint64(hot.value[int(counter[i])]))
            order = np.argsort(at, kind="stable")
            ranges, first = np.unique(at[order], return_index=True)
            cut = lambda x, kind: pa.array([p.astype(kind).tobytes() for p in np.split(x[order], first[1:])], pa.binary())
            yield pa.RecordBatch.from_pydict({
                "range": pa.array(ranges, pa.int64()), "shingles": cut(shingle, np.uint64), "keys": cut(key, np.int64), "sizes": cut(n, np.uint32)})

        for batch in batches:
            for _, _, shingles, edges in sets_of(batch.column(0)):
                keys = keys_of(shingles, edges)
                chosen, length = _firsts(shingles, edges, levels.value)
                owner = np.repeat(np.arange(len(keys)), length)
                new = np.zeros(len(keys), bool)
                for i, k in enumerate(keys.tolist()):  # copies within a task are one point
                    if k not in seen:
                        seen.add(k)
                        new[i] = True
                some = new[owner]
                held.append((shingles[chosen[some]], keys[owner[some]], np.diff(edges)[owner[some]]))
                size += int(some.sum())
                if size > _FLUSH:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    entries = docs.select("text").mapInArrow(first_shingles, "range long, shingles binary, keys binary, sizes binary")
    met = entries.groupBy("range").applyInPandas(
        lambda key, rows: _holders(rows, key[0] & 0xFFFFFFFF > 0), "region long, a long, b long, need int, shared long")
    met = stored(met, "holders")
    vectors = stored(points.groupBy("key").agg(F.min("vector").alias("vector")), "vectors")
    pairs = met.where("region = 0").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("need").alias("need"))
    pairs = pairs.where("shared >= need").select("a", "b")
    of = lambda end: vectors.select(F.col("key").alias(end), F.col("vector").alias(f"_{end}"))
    pairs = pairs.join(of("a"), "a").join(of("b"), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_pylist() for i in (2, 3))
            x, y = _stacked(a + b)[: len(a)], _stacked(a + b)[len(a) :]
            common = np.minimum(x, y).sum(1, dtype=np.int64)
            keep = linked(common, x.sum(1, dtype=np.int64), y.sum(1, dtype=np.int64))
            yield batch.select([0, 1]).filter(pa.array(keep))

    pairs = pairs.select("a", "b", "_a", "_b").mapInArrow(near, "a long, b long")
    regions = stored(met.where("region <> 0").select("region", F.col("a").alias("key")).distinct(), "regions")
    sizes = stored(regions.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "region-sizes")
    members = regions.join(sizes, "region").join(vectors, "key")

    def around(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows["key"].to_numpy(np.int64)
        return pd.DataFrame({"a": key, "b": key[_near_vectors(rows)]}).query("a != b")

    small = members.where(F.col("size") <= VECTORS_PER_TASK)
    pairs = pairs.union(small.groupBy("region").applyInPandas(around, "a long, b long"))
    if sizes.where(F.col("size") > VECTORS_PER_TASK).isEmpty():
        return pairs
    large = members.where(F.col("size") > VECTORS_PER_TASK).withColumnRenamed("vector", "point")

    def measure(points: list[bytes], pivots: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        x, y = (v.astype(np.int64) for v in np.split(_stacked([*points, *pivots]), [len(points)]))
        common = np.stack([np.minimum(x, p).sum(1) for p in y], 1)
        return common, x.sum(1)[:, None] + y.sum(1)

    to_pivots, open_ = _around_pivots(large, "region", VECTORS_PER_TASK, measure, regions=False)
    cells = in_cells(open_, "region", VECTORS_PER_TASK).join(vectors, "key")
    return pairs.union(to_pivots).union(cells.groupBy("region", "i", "j").applyInPandas(around, "a long, b long"))


def _around_pivots(members: DataFrame, by: str, limit: int, measure, regions: bool) -> tuple[DataFrame, DataFrame]:
    """(links to pivots, (`by`, key, open)) for groups of any size; `members` has `by`, key, point and size.

    Points are dealt in chunks, each of which gets its group's pivots. A point near the pivot that most are
    near to is settled: all such are connected through it. Only the others, `open`, need meet everyone, and with
    `regions` only in the Voronoi regions that the triangle inequality leaves them.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.xxhash64(F.lit(1), "key")))
    pivots = members.withColumn("_place", place).where(F.col("_place") <= PIVOTS)
    chunks = F.ceil(F.col("size") / limit).cast("int")
    pivots = pivots.select(F.col(by).alias("g"), F.col("_place").alias("q"), F.col("key").alias("pivot"), F.col("point").alias("set"),
                           F.explode(F.sequence(F.lit(0), chunks - 1)).alias("c"))
    dealt = members.withColumn("chunk", F.pmod(F.xxhash64("key"), chunks).cast("int"))

    def assign(key, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(own):
            return pd.DataFrame({c: [] for c in ("g", "key", "q", "near", "pivot")}).astype("int64")
        own = own.sort_values("q")
        common, both = measure(rows["point"].tolist(), own["set"].tolist())
        away = 1.0 - common / np.maximum(both - common, 1)
        near = 100 * common >= PERCENT * (both - common)
        at, q = np.nonzero(near | (away <= away.min(1, keepdims=True) + 2 * RADIUS + 1e-9))
        return pd.DataFrame({
            "g": rows[by].iloc[0], "key": rows["key"].to_numpy()[at], "q": q, "near": near[at, q].astype(np.int64),
            "pivot": own["pivot"].to_numpy()[q]})

    rows = stored(dealt.groupBy(by, "chunk").cogroup(pivots.groupBy("g", "c")).applyInPandas(
        assign, "g long, key long, q long, near long, pivot long"), "around-pivots")
    to_pivots = rows.where("near = 1 AND key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    busiest = rows.where("near = 1").groupBy("g", "q").agg(F.count(F.lit(1)).alias("n"))
    busiest = busiest.groupBy("g").agg(F.max_by("q", F.struct("n", "q")).alias("best"))
    settled = rows.where("near = 1").join(busiest, "g").where("q = best").select("g", "key").distinct()
    named = rows.select("g", F.xxhash64("g", "q").alias(by), "key") if regions else rows.select("g", F.col("g").alias(by), "key").distinct()
    named = named.join(settled.withColumn("_settled", F.lit(True)), ["g", "key"], "left")
    return to_pivots, named.select(by, "key", F.col("_settled").isNull().alias("open"))


def in_cells(members: DataFrame, by: str, limit: int) -> DataFrame:
    """Members of groups with cells (i, j) of at most about `limit` rows, in which any two meet of which one is `open`.

    Blocks of open members (i) meet blocks of all (j); a group without open members has no cells.
    """
    sizes = members.groupBy(by).agg(F.count(F.lit(1)).alias("_all"), F.count_if("open").alias("_open"))
    blocks = lambda n: F.ceil(F.col(n) * 2 / limit).cast("int")
    sizes = sizes.where("_open > 0").select(F.col(by).alias("_by"), blocks("_open").alias("_is"), blocks("_all").alias("_js"))
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    there = F.transform(each("_is"), lambda i: cell(i, own("_js")))
    here = F.transform(each("_js"), lambda j: cell(own("_is"), j))
    cut = members.join(sizes, F.col(by) == F.col("_by"))
    cut = cut.withColumn("_cell", F.explode(F.when(F.col("open"), F.array_union(there, here)).otherwise(there)))
    return cut.select(by, "key", "_cell.i", "_cell.j").distinct()


def labels(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(key, label) of the points that link with others, a label being one key of the exact component."""
    groups = components(candidates(docs, found)).select(F.col("label").alias("group"), F.col("v").alias("key"))
    sets = stored(_sets(docs, found, groups), "sets")
    members = groups.join(sets, "key")
    sizes = stored(groups.groupBy("group").agg(F.count(F.lit(1)).alias("size")), "group-sizes")
    small = members.join(sizes.where(F.col("size") <= MEMBERS_PER_TASK), "group")
    out = small.groupBy("group").applyInPandas(_connected, "a long, b long").select(F.col("a").alias("key"), F.col("b").alias("label"))
    large = sizes.where(F.col("size") > MEMBERS_PER_TASK)
    if large.isEmpty():
        return out
    joined_up = components(_large(members.join(large, "group")))
    return out.union(joined_up.select(F.col("v").alias("key"), "label"))


def _sets(docs: DataFrame, found: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, shingles) of the points in `groups`, from one document each.

    The rows wanted are marked in a bitmap of fixed size; a row let through by chance is dropped by the join.
    """
    wanted = found.where("key IS NOT NULL").groupBy("key").agg(F.min("row").alias("row")).join(groups.select("key"), "key", "left_semi")
    place = lambda rows: (words_of.mixed(rows.view(np.uint64)) >> np.uint64(64 - _BITMAP)).astype(np.int64)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << _BITMAP, bool)
        for batch in batches:
            bits[place(batch.column(0).to_numpy())] = True
        if bits.any():
            packed = zstandard.ZstdCompressor(level=1).compress(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_pydict({"bits": pa.array([packed], pa.binary())})

    bitmap = np.zeros(1 << (_BITMAP - 3), np.uint8)
    for row in wanted.select("row").mapInArrow(marks, "bits binary").toLocalIterator():
        bitmap |= np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(row[0])), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            batch = batch.filter(pa.array(bits[place(batch.column(0).to_numpy())]))
            for _, _, shingles, edges in sets_of(batch.column(1)):
                n = np.diff(edges)
                blobs = [shingles[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                out = pa.RecordBatch.from_pydict({"key": pa.array(keys_of(shingles, edges)), "shingles": pa.array(blobs, pa.binary())})
                yield out.filter(pa.array(n > 0))

    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text").mapInArrow(read, "key long, shingles binary")
    return rows.join(groups.select("key"), "key", "left_semi").groupBy("key").agg(F.min("shingles").alias("shingles"))


def _large(members: DataFrame) -> DataFrame:
    """Links within groups of any size: one level of Voronoi regions, then cells of blocks."""

    def measure(points: list[bytes], pivots: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        own = Points([np.frombuffer(b, np.uint64) for b in [*points, *pivots]])
        n = len(points)
        common = np.stack([own.common(n + i, np.arange(n)) for i in range(len(pivots))], 1)
        return common, own.n[:n, None] + own.n[n:]

    to_pivots, open_ = _around_pivots(members.withColumnRenamed("shingles", "point"), "group", MEMBERS_PER_TASK, measure, regions=True)
    cells = in_cells(open_, "group", MEMBERS_PER_TASK).join(members.select("key", "shingles"), "key")
    return to_pivots.union(cells.groupBy("group", "i", "j").applyInPandas(_connected, "a long, b long"))


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document, with its row and label for those who look it up."""
    found = profiles(docs)
    rows = stored(found.where("counters IS NULL").select("doc_id", "row", F.col("n").alias("n_shingles"), "key"), "joined-rows")
    rows = left_join(rows, stored(labels(docs, found), "joined-labels"), "key")
    rows = stored(rows.withColumn("label", F.coalesce("label", "key")), "joined-labelled")
    ids = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    rows = left_join(rows, ids, "label")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return rows.select("doc_id", "row", "label", "n_shingles", component.alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with its id, all columns kept.

    Of rows that are alike in id and text one stays. Documents without shingles all stay.
    """
    found = joined(docs)
    chosen = found.where("n_shingles > 0 AND doc_id <=> component_id").groupBy("label").agg(F.min("row").alias("_row"))
    empty = found.where("n_shingles = 0").select(F.col("row").alias("_row")).distinct()
    stays = chosen.select("_row", F.lit(False).alias("_all")).union(empty.select("_row", F.lit(True)))
    rows = docs.select(F.xxhash64("doc_id", "text").alias("_row"), F.struct(*docs.columns).alias("_doc")).join(stays, "_row")
    nth = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    return rows.withColumn("_nth", nth).where("_all OR _nth = 1").select("_doc.*")
