"""Ranked search, packing and whitening, against brute force, round trips and dense linear algebra."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import lower
from tokenizers import Tokenizer

import __spark_entry__ as contract
from seatflow.llm import packing, ranked, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TABLES = "/root/testdata/sf0.001"


def ranking(docs, items, k=10):
    held = [(d, Counter(map(lower, TERM.findall(t or "")))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, total, df = len(held), sum(n for *_, n in held), Counter(w for _, c, _ in held for w in c)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for w, f in df.items()}
    out = []
    for item, text in items:
        asked, scored = set(map(lower, TERM.findall(text or ""))), []
        for d, c, n in held:
            m = 100 - 90 + ((90 * n * n_docs) // total)
            score = sum(weight[w] * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in asked if w in c)
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort(key=lambda r: r[:2] if r[1] else r)
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:k])]
    return sorted(out, key=str)


def odd_documents(seed, n=300):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(8)], [f"r{i}é" for i in range(60)]
    text = lambda m: " ".join(rng.choice(common if rng.random() < 0.8 else rare) for _ in range(m))
    rows = [(i, text(rng.choice([0, 1, 3, 20, 60]))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " ,;\n"), (n + 3, "C1 " * 5000), (None, rows[5][1]), (7, rows[7][1]), (7, "r1É r2é"), (None, "r3é c1")]
    items = [(i, text(rng.choice([1, 4, 25]))) for i in range(25)] + [(3, text(5)), (None, "C1 r1é"), (90, None), (91, ""), (92, "nowhere")]
    return rows, items


@pytest.mark.parametrize("short,window,shard,blocks", [(2048, 512, 8192, 8 << 20), (0, 16, 64, 8 << 20), (40, 32, 50, 400)])
def test_ranking_agrees_with_all_pairs(spark, monkeypatch, short, window, shard, blocks):
    """With no, some and only long lists, few and many shards, one block of items and several."""
    for name, value in {"ACCUMULATED": short, "WINDOW": window, "SHARD_DOCS": shard, "BLOCK_BYTES": blocks}.items():
        monkeypatch.setattr(ranked, name, value)
    rows, items = odd_documents(short)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, rank string, key int")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    got = sorted((tuple(r) for r in ranked.top_documents(docs, bench).collect()), key=str)
    assert got == ranking(rows, items)


def test_ranking_takes_other_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "y x"), ("c", "x"), (None, "x y")], "doc_id string, text string")
    bench = spark.createDataFrame([("q", "x z")], "item_id string, text string")
    got = ranked.top_documents(docs, bench).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in got] == [("q", 1, "c"), ("q", 2, "a"), ("q", 3, "b"), ("q", 4, None)]
    assert ranked.top_documents(docs.where("false"), bench).count() == 0
    assert ranked.top_documents(docs, bench.where("false")).count() == 0


def test_windows_below_the_kth_score_are_not_read():
    """A rare term lifts the kth score so that most postings of a common one are never read."""
    n = 8000
    docs = np.concatenate([np.arange(n), np.arange(0, 400, 20)])
    starts = np.array([0, n, n + 20])
    shard = ranked.Shard(np.full(n, 10), np.array([0, 1]), starts, docs, np.ones(n + 20, np.int64), np.array([5, 9000]), n, 10 * n)
    found, _, read = shard.top(np.array([0, 1]), 10)
    assert found.tolist() == list(range(0, 200, 20)) and read < 500


def test_no_sum_of_a_dual_feasible_function_passes_its_one():
    for capacity in (1, 2, 3, 7, 10, 12, 13, 60):
        for row, one in zip(*packing.dual_feasible(capacity), strict=True):
            most = [0] * (capacity + 1)
            for c in range(1, capacity + 1):
                most[c] = max([most[c - 1], *(most[c - x] + row[x] for x in range(1, c + 1))])
            assert most[capacity] <= one


def fewest(lengths, capacity):
    """The least number of sequences, by trying all ways."""
    best = len(lengths)

    def add(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for j in sorted({r: j for j, r in enumerate(room) if r >= lengths[i]}.values()):
            add(i + 1, [r - lengths[i] if j == k else r for k, r in enumerate(room)])
        add(i + 1, [*room, capacity - lengths[i]])

    add(0, [])
    return best


def test_bounds_stay_below_the_least_packing():
    rng = random.Random(4)
    met = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 8))), reverse=True)
        least = fewest(lengths, capacity)
        bound = packing.lower_bound(np.bincount(np.array(lengths, int), minlength=capacity + 1), capacity)
        sequence, place, room = packing.best_fit(np.array(lengths, np.int64), capacity)
        assert bound <= least <= len(room)
        met += bound == least
        for s in range(len(room)):
            own = sorted((p, x) for q, p, x in zip(sequence, place, lengths, strict=True) if q == s)
            assert [p for p, _ in own] == [sum(x for _, x in own[:i]) for i in range(len(own))]
            assert sum(x for _, x in own) == capacity - room[s]
    assert met > 140


def filled(rows, capacity):
    """Lengths of the sequences; pieces lie in them without gaps."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_exchanges_save_sequences_and_lose_none(spark):
    rng = np.random.default_rng(3)
    lengths = np.append(rng.integers(150, 900, 4000), [2048] * 7)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "key long, length long").cache()
    one = packing.packed(pieces, per_partition=128, rounds=0)
    more = packing.packed(pieces, per_partition=128)
    count = lambda rows: rows.select("sequence_id").distinct().count()
    before, after, bound = count(one), count(more), more.first().bound
    assert bound <= after < before
    rows = more.join(pieces, "key").collect()
    assert sorted(r.key for r in rows) == list(range(len(lengths)))
    filled(rows, 2048)
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, packing.packed(pieces, per_partition=128).collect()))


def test_sequences_hold_the_tokenizers_ids(spark):
    known = Tokenizer.from_file(packing.VOCABULARY)
    texts = ["", None, "It's 12 o'clock — äé  \n\n  x ", "a" * 3000, "word " * 2000 + "\t\t", "a <|endoftext|> b", "tab\tü 中文字 ไทย    x\x1c\x85y", "x" * 40 + " 😀"]
    rows = [(i, t, "p") for i, t in enumerate(texts)] + [(None, "x y", "p"), (2, texts[2], "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    placed = packing.packed_documents(docs, capacity=64).cache()
    rows_out = placed.collect()
    filled(rows_out, 64)
    sequence = {r.sequence_id: (r.length, bytes(r.ids)) for r in packing.sequences(placed).collect()}
    seen, expected = Counter(), Counter()
    by_key = {}
    for r in rows_out:  # pieces of a document are told apart by where their sequences hold them
        length, data = sequence[r.sequence_id]
        assert len(data) == 4 * length and data[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
        by_key.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, bytes(r.ids)))
    for i, t, _ in rows:
        ids = [*known.encode(t or "", add_special_tokens=False).ids, 0]
        first, at, piece = len(ids) % 64 or 64, 0, 0
        while at < len(ids):
            own = ids[at : at + first]
            expected[(i, piece, at, len(own), np.array(own, "<u4").tobytes())] += 1
            at, piece, first = at + len(own), piece + 1, 64
    seen.update((d, *p) for d, own in by_key.items() for p in own)
    assert seen == expected
    empty = packing.packed_documents(docs.where("false"))
    assert empty.count() == 0 and packing.sequences(empty).count() == 0


def test_packing_query_over_a_whole_table(spark):
    known = Tokenizer.from_file(packing.VOCABULARY)
    rows = contract.queries()["op12_packing"](spark, TABLES).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    found = filled(rows, 2048)
    assert len(found) <= rows[0].bound + 1
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        ids = [*known.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
            assert r.length == 2048 or r.piece == 0


def matrices():
    rng = np.random.default_rng(8)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    b = rng.normal(size=(30, 33))
    yield b @ b.T
    yield np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)  # pairs that nearly agree
    yield turn @ np.diag([9.0] * 4 + [9 - 1e-10] * 4 + [1.0] * 32) @ turn.T
    yield np.kron(np.eye(4), np.cov(rng.normal(size=(6, 40))))
    yield np.eye(12)
    yield np.zeros((5, 5))
    yield np.diag(np.arange(20.0))
    yield np.full((9, 9), 3.0)
    yield 1e150 * np.cov(rng.normal(size=(6, 40)))
    yield np.array([[2.0]])
    yield -np.cov(rng.normal(size=(6, 40)))


@pytest.mark.parametrize("matrix", list(matrices()))
def test_eigenpairs_are_those_of_dense_algebra(matrix):
    values, vectors = whitening.eigenpairs(matrix, 8)
    size = np.abs(matrix).max() or 1.0
    k = min(8, len(matrix))
    assert len(values) == k and np.abs(values - np.linalg.eigvalsh(matrix)[::-1][:k]).max() <= 1e-13 * size * len(matrix)
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * size * len(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-13


def test_tridiagonal_form_and_counts():
    a = np.cov(np.random.default_rng(1).normal(size=(12, 50)))
    diagonal, off, _ = whitening.householder(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    known = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(t), known, rtol=1e-12)
    at = np.concatenate([known - 1e-9, known + 1e-9, [-1e9, 1e9]])
    assert whitening.sturm_counts(diagonal, off, at).tolist() == [int((known < x).sum()) for x in at]


EMBEDDED = "vec_id long, embedding array<float>, whitened string, deviation string"


def embedded(spark, rows):
    return spark.createDataFrame([(i, v, "w", "d") for i, v in rows], EMBEDDED)


def test_whitening_agrees_with_dense_algebra(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(400, 10)) @ rng.normal(size=(10, 10))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(None, rows[3][1]), (5, rows[5][1]), (5, [0.25] * 10), (900, [0.5] * 7), (901, [])]
    bad = [(950, None), (951, [None] * 10), (952, [float("nan")] * 10), (953, [float("inf")] * 10), (954, [1e30] * 10)]
    table = embedded(spark, rows + bad).repartition(5)
    model = whitening.fit(table)
    out = whitening.whitened(table, model)
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] + [100000] * (10 - len(v)) for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    assert (model.n, model.sums) == (n, sums.tolist())
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    assert np.allclose(model.values, values, rtol=1e-11) and np.allclose(model.explained, values / np.trace(covariance), rtol=1e-11)
    signs = np.sign((vectors * model.vectors).sum(axis=0))
    expected = centred @ (vectors * signs) / np.sqrt(values)
    exact = Counter((i, int(((n * a - sums) ** 2).sum())) for (i, _), a in zip(rows, x, strict=True))
    got = out.collect()
    assert Counter((r.vec_id, r.deviation) for r in got) == exact
    assert np.allclose(sorted(r.whitened for r in got), sorted(expected.tolist()), atol=1e-9)
    assert whitening.identity_error(out, 8) < 1e-9
    again = whitening.fit(table.repartition(2))
    assert (again.covariance == model.covariance).all() and (again.vectors == model.vectors).all()


@pytest.mark.parametrize("rows,components", [([], 0), ([(1, None)], 0), ([(1, [0.5, 2.0])], 0), ([(1, [1.0, 1.0])] * 5, 0), ([(1, [])], 0), ([(1, [1.0, 0.0]), (2, [0.0, 1.0])], 1)])
def test_whitening_without_spread(spark, rows, components):
    table = embedded(spark, rows)
    model = whitening.fit(table)
    assert len(model.values) == components
    out = whitening.whitened(table, model).collect()
    assert [len(r.whitened) for r in out] == [components] * len(out) and len(out) == (model.n or 0)


def test_sums_stay_exact_beyond_doubles():
    rng = np.random.default_rng(0)
    y = rng.integers(-(2**30), 2**30, (50, 3))
    assert (whitening._products(y) == y.astype(object).T @ y.astype(object)).all()
    z = rng.integers(-(2**25), 2**25, (2000, 3))
    assert (whitening._products(z) == z.astype(object).T @ z.astype(object)).all()
    model = whitening.Whitening(10**9, [5 * 10**9 + 3] * 2, np.ones(2), np.eye(2), 2.0, 1024, 0, np.eye(2))
    assert model.deviations(np.array([[5, 5], [10**4, 5]])) == [18, None]


def test_wide_vectors_stop_the_fit(spark):
    with pytest.raises(ValueError, match="entries"):
        whitening.fit(embedded(spark, [(1, [0.0] * (whitening.MAX_WIDTH + 1))]))
