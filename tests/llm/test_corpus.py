"""Decontamination, mixing, the n-gram join, and the pipeline of them."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import ALNUM_WORD, base_spans, components, hits, lower, targets
from pyspark.sql import functions as F

import corpus_pipeline
from seatflow.llm import components as components_of
from seatflow.llm import decontam, hot, mixing, ngram_join

TABLES = "/root/testdata/sf0.001"


def documents(spark, rows, more="", values=()):
    return spark.createDataFrame([(*r, *values) for r in rows], "doc_id long, text string" + more)


def test_decontamination_agrees_with_all_pairs(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("aéb1ß") for _ in range(rng.randint(1, 3))) for _ in range(5)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 3, 9, 10, 11, 25, 30])] + [(6, text(12)), (None, text(2)), (20, None)]
    docs = [(i, text(rng.choice([0, 1, 5, 30, 200])) + rng.choice(["", ", ", "\n"])) for i in range(30)]
    docs += [(40, f"{text(20)} {items[7][1].upper()} {text(9)}"), (41, None), (42, ""), (3, docs[3][1]), (None, docs[3][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.judged(documents(spark, docs, ", n_hit string, x int", ("q", 1)), bench).collect()
    expect = lambda t: hits(t, [i for i in items if i[0] is not None])
    assert len(got) == len(docs)
    for r in got:
        n, hit, ids = expect(r.text)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
    clean = decontam.decontaminated(documents(spark, docs, ", n_hit string", ("q",)), bench)
    assert clean.columns == ["doc_id", "text", "n_hit"]
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, t in docs if not expect(t)[1])
    none = documents(spark, docs).where("false")
    assert decontam.judged(none, bench).count() == 0
    assert not any(r.contaminated for r in decontam.judged(documents(spark, docs), bench.where("false")).collect())


def _longest(text, items):
    """The longest verbatim match that holds a window, by comparing all places with all places."""
    own, found = ALNUM_WORD.findall(lower(text)), []
    for name, other in items:
        other = ALNUM_WORD.findall(lower(other))
        for q in range(len(other)):
            window = min(10, len(other))
            if len(other) - q < window:
                continue
            for p in range(len(own)):
                n = 0
                while p + n < len(own) and q + n < len(other) and own[p + n] == other[q + n]:
                    n += 1
                if n >= window:
                    found.append((-n, p, str(name), q))
    return min(found, default=(None, None, None, None))


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_longest_match_of_a_document_in_blocks_of_any_size(spark, block):
    rng = random.Random(block)
    text = lambda n: " ".join(rng.choice(["a", "b", "é"]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 10, 12, 25, 40])] + [(4, text(14)), (9, "zz yy"), (10, "q"), (11, "r")]
    docs = [(i, text(rng.choice([0, 3, 15, 80]))) for i in range(12)] + [(20, f"c {items[5][1]} c {items[4][1].upper()}"), (21, None), (22, "Zz yy q r"), (23, "c c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.judged(documents(spark, docs, ", longest string", ("x",)), bench, block_words=block).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, p, name, q = _longest(r.text, items)
        assert (r.longest, r.longest_at, r.longest_item, r.longest_item_word) == (None if n is None else -n, p, name, q)
        _, hit, ids = hits(r.text, items)
        assert (r.n_hit, r.n_items) == (hit, len(ids))
    whole = sorted(map(tuple, decontam.longest_matches(documents(spark, docs), bench).collect()))
    assert whole == sorted(map(tuple, decontam.longest_matches(documents(spark, docs), bench, block_words=block).collect()))


def test_whole_table_against_all_pairs(spark):
    docs, bench = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    for r in decontam.judged(docs, bench).collect():
        n, hit, ids = hits(r.text, items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(ids))


def test_large_shards_sort_alike(monkeypatch):
    """The order is the same when place numbers do not fit beside two words."""
    import pyarrow as pa

    rng = random.Random(0)
    texts = pa.array([" ".join(rng.choice(["a", "b", "cc"]) for _ in range(60)) for _ in range(20)])
    _, _, h, b = next(decontam.hashed(texts))
    small = decontam.SuffixArray(h, b, 40)
    monkeypatch.setattr(decontam, "_BITS", 4)
    large = decontam.SuffixArray(h, b, 40)
    key = lambda s, p: s.short[p : min(s.stop[p], p + 40)].tolist()
    assert [key(small, p) for p in small.places] == [key(large, p) for p in large.places]


def test_longest_matches(spark):
    docs = documents(spark, [(1, "x one two three four y"), (2, "two three four five six"), (3, None)])
    bench = spark.createDataFrame([(7, "one two three four five")], "item_id long, text string")
    got = {r.item_word: (r.length, r.doc_id, r.doc_word) for r in decontam.longest_matches(docs, bench).collect()}
    assert got == {0: (4, 1, 1), 1: (4, 2, 0), 2: (3, 2, 1), 3: (2, 2, 2), 4: (1, 2, 3)}
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r.item_word: (r.length, r.doc_id, r.doc_word) for r in decontam.longest_matches(named, bench).collect()} == {k: (n, f"d{d}", w) for k, (n, d, w) in got.items()}


def test_budget_is_met_by_whole_documents():
    rng = np.random.default_rng(5)
    for _ in range(200):
        lengths = np.unique(rng.integers(1, 60, rng.integers(1, 15)))
        counts = rng.integers(0, 6, len(lengths))
        total = int((lengths * counts).sum())
        budget = int(rng.integers(0, total + 5))
        taken = mixing.fit_budget(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all() and (lengths * taken).sum() <= budget
        if 1 in lengths and counts[0] >= 60:
            assert (lengths * taken).sum() == min(budget, total)
    exact = mixing._knapsack(np.array([3, 5, 7]), np.array([2, 1, 1]), 13)
    assert (np.array([3, 5, 7]) * exact).sum() == 13 and (exact <= [2, 1, 1]).all()


def mixed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, copies string")
    return docs, [tuple(r) for r in mixing.allotted(docs, seed=3).select("doc_id", "source", "size", "source_size", "target", "copies").collect()]


def test_mix_comes_near_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_SLICE", 5)  # a common length is ranked in slices
    rng = random.Random(7)
    rows = [(i, " ".join("w" * rng.choice([3, 3, 3, rng.randint(1, 50)])), rng.choice(["a", "a", "a", "b", "é", None]), "s", "c") for i in range(600)]
    rows += [(700, None, "a", "s", "c"), (701, "", "z", "s", "c"), (702, " \t\n", "b", "s", "c"), (None, "x y", "b", "s", "c"), (5, rows[5][1], rows[5][2], "s", "c")]
    docs, got = mixed(spark, rows)
    assert len(got) == len(rows) and sorted(got, key=str) == sorted(mixed(spark, rows)[1], key=str)
    sizes = Counter()
    for _, source, size, *_ in got:
        sizes[source] += size
    aim = targets({s: sizes[s] for s in {g[1] for g in got}})
    taken = Counter()
    for _, source, size, source_size, target, copies in got:
        assert source_size == sizes[source] and abs(target - aim[source]) < 1e-6 and 0 <= copies <= 3
        taken[source] += size * copies
    assert all(abs(taken[s] - aim[s]) <= 1 for s in aim)
    kept = mixing.mix(docs, seed=3).collect()
    assert Counter((r.doc_id, r.source, r.copies) for r in kept) == Counter((g[0], g[1], g[5]) for g in got if g[5])
    assert mixed(spark, [])[1] == []


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 10}, {"a": 0, "b": 5}, {"a": 1, None: 1, "b": 100, "c": 3, "d": 50}, {"a": 0}])
def test_targets_are_shared_as_by_hand(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(targets(sizes))


@pytest.mark.parametrize("last", [0, 7, 1000])
def test_components_of_paths_stars_and_none(spark, monkeypatch, last):
    monkeypatch.setattr(components_of, "LAST_LINKS", last)
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.v: r.label for r in components_of.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == {*range(41), 100, *range(200, 230), 300, 301}
    assert [len({got[v] for v in group}) for group in (range(41), [100, *range(200, 230)], [300, 301])] == [1, 1, 1]
    assert len(set(got.values())) == 3
    assert components_of.components(spark.createDataFrame([], "a long, b long")).count() == 0


def variants(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(10):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 30, 60, 120]))]
        for _ in range(rng.choice([1, 3, 25])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows), " ".join(own + [rng.choice(words)] * rng.choice([0, 0, 1]))))
    odd = [None, "", "  \n", "A b", "a B", "a b c d", "A\tb  c\nd", "x " * 3000]
    return rows + [(len(rows) + i, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize("tight", [False, True])
def test_join_agrees_with_all_pairs(spark, monkeypatch, tight):
    """Also with limits so low that every way of splitting groups is taken."""
    if tight:
        for name, value in {"MEMBERS_PER_TASK": 6, "VECTORS_PER_TASK": 8, "FEW": 3, "LEAF": 4, "ENTRIES_PER_TASK": 12}.items():
            monkeypatch.setattr(ngram_join, name, value)
        monkeypatch.setattr(components_of, "LAST_LINKS", 2)
    rows = variants(11)
    docs = documents(spark, rows, ", key int, label string, row string", (1, "l", "r"))
    got = sorted(tuple(r) for r in ngram_join.joined(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == components(rows)


def test_one_document_of_each_component_stays(spark):
    rows = variants(3)
    rows += [rows[0], rows[0], (None, "only null id here now"), (None, None)]
    docs = documents(spark, rows, ", source string", ("s",))
    kept = ngram_join.deduplicated(docs).collect()
    numbered = [r for r in rows if r[0] is not None]
    components_left = {c for _, n, c in components(numbered) if n}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None and (r.text or "").split()) == sorted(components_left)
    assert sum(not (r.text or "").split() for r in kept) == sum(not (t or "").split() for _, t in rows)
    assert [r.doc_id for r in kept if r.text == "only null id here now"] == [None]
    assert ngram_join.joined(docs.where("false")).count() == 0 and ngram_join.deduplicated(docs.where("false")).count() == 0


def test_hot_values_are_joined_like_others(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 3 == 0 else 7 if i % 3 == 1 else rng.randrange(4000)) for i in range(12000)]
    table = [(k, f"n{k}") for k in range(0, 4000, 2)] + [(7, "hot")]
    left = spark.createDataFrame(rows, "i long, k long").repartition(5)
    right = spark.createDataFrame(table, "k long, name string")
    names = dict(table)
    got = hot.left_join(left, right, "k")
    assert sorted(tuple(r) for r in got.select("i", "k", "name").collect()) == [(i, k, names.get(k)) for i, k in rows]
    assert hot.left_join(left.where("i < 0"), right, "k").count() == 0
    assert hot.left_join(left.where("i < 30"), right.where("false"), "k").where("name is null").count() == 30
    assert hot.left_join(left.where("k is null"), right, "k").count() == 4000


NAMES = ["_row", "_nth", "_all", "_draw", "_key", "_slice", "_doc", "score", "lang_pred", "label", "key", "size", "row"]


@pytest.mark.parametrize("stage", [0, 1, 4])
def test_stages_keep_columns_of_any_name(spark, stage):
    text = "the men of the house and the dog that sat near the door of it {}"
    rows = [(1, text.format("a") * 3, "en"), (2, text.format("b"), "en"), (2, text.format("b"), "en"), (None, "der Hund und die Katze", "de"), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} of "), F.coalesce("text", F.lit(""))) for name in NAMES})
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs, TABLES)
    assert out.columns == [*docs.columns, "copies"] if name == "mix" else out.columns == docs.columns
    kept = out.collect()
    assert kept and all(r[c] == f"{c} of {r.text}" for r in kept for c in NAMES)
    assert run(spark, docs.where("false"), TABLES).count() == 0


def test_pipeline_stage_by_stage(spark):
    start = spark.read.parquet(f"{TABLES}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34", "en", "s", 5), (-4, "Съешь же ещё этих мягких французских булок да выпей чаю", None, "s", 56), (-3, "mail a@b.cc or +1 (523) 555-1055 to the men of the house", None, None, None)], start.schema)
    docs, rows = start.union(odd), {r.doc_id: r for r in start.union(odd).collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, TABLES)
        if k < 4:
            assert out.schema.names == start.schema.names
        path = f"{spark.conf.get('spark.sql.warehouse.dir').removeprefix('file:')}/{name}-{random.random()}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept = {r.doc_id: r for r in docs.collect()}
        assert len(kept) == docs.count()
        if name == "language_id":
            assert set(rows) - set(kept) == {-1, -2, -4}
        elif name == "ngram_join":
            assert set(kept) == {c for _, _, c in components([(i, r.text) for i, r in rows.items()])}
        elif name == "decontaminate":
            items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(kept) == {i for i, r in rows.items() if not hits(r.text, items)[1]}
        elif name == "pii":
            assert set(kept) == set(rows)
            assert all(not base_spans(r.text) and (r.n_chars is None or r.n_chars == len(r.text) or r.text == rows[i].text) for i, r in kept.items())
            assert all(kept[i].text == r.text for i, r in rows.items() if not any(c in r.text for c in "@0123456789"))
        else:
            assert set(kept) <= set(rows) and all(1 <= r.copies <= 3 for r in kept.values())
        rows = kept
    again = corpus_pipeline.run(spark, TABLES)
    assert again.count() > 0 and "copies" in again.columns
