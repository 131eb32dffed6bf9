"""Exact top-k, URL rules and token totals."""

import math
import random

import pytest

from seatflow.llm import rollups, topk, urls


def expected(rows, k):
    """Every row that takes part is a candidate for every other one."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (query, q) in enumerate(kept):
        if query % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for n, (i, v) in enumerate(kept) if n != own)
            out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, rank int, v string"


@pytest.mark.parametrize("dims,n,block", [(3, 120, 30), (8, 60, 8192), (1, 50, 7)])
def test_topk_is_exact(spark, monkeypatch, dims, n, block):
    monkeypatch.setattr(topk, "CANDIDATES_PER_BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
    rng = random.Random(dims)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.random()]) for _ in range(dims)]) for i in range(n)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (3, rows[3][1]), (5, [0.1] * dims)]  # ties and repeated ids
    rows += [(20, rows[20][1]), (40, [1.0] * dims), (40, [-1.0] * dims)]  # of queries too
    rows += [(220, None), (240, [None] * dims), (260, [float("nan")] * dims), (280, [float("inf")] * dims), (None, [1.0] * dims)]
    rows += [(300, [0.5] * max(0, dims - 1)), (320, [])]  # shorter vectors
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    assert sorted(tuple(r) for r in topk.top_k(table, k=7).collect()) == expected(rows, 7)


def test_topk_stops_early_and_takes_empty_tables(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    vectors = np.rint(rng.normal(0, 3, (5000, 4))).astype(np.int64)
    vectors[:40] = 60  # a few far ahead of the rest
    lists = topk.SortedLists(np.arange(5000), vectors)
    ids, scores, scored = lists.top(np.array([5, 7, 3, 9]), 0, 10)
    assert ids.tolist() == list(range(1, 11)) and scored < 1000
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


RULES = [("org/", False), ("example.org/es/", True), ("example.org/en/1", True), ("com/fr/", False), ("com/de/", True)]
URLS = [
    ("http://A.Example.org/es/1?x=/de/#y", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/ES/", "example.org", "/ES/", "org/", "allow"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("https://notexample.org/en/12", "notexample.org", "/en/12", "org/", "allow"),
    ("x://com/de/", "com", "/de/", "com/de/", "block"),
    ("x://b.com/fr/q", "b.com", "/fr/q", "com/fr/", "allow"),
    ("x://b.net/", "b.net", "/", None, "allow"),
    ("x://b.org", "b.org", "", None, "allow"),
    ("x://b.org#/a", "b.org", "", None, "allow"),
    ("no scheme.org/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://\nline.org/x\ny", "\nline.org", "/x\ny", "org/", "allow"),
    ("x://" + "a." * 300 + "org/" + "p" * 5000, "a." * 300 + "org", "/" + "p" * 5000, "org/", "allow"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(rows)], "page_id long, url string, host string, rule string")


def test_url_rules(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages_of(spark, [u[0] for u in URLS]), RULES).collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}
    assert urls.judged(pages_of(spark, []), RULES).count() == 0
    assert {r.verdict for r in urls.judged(pages_of(spark, ["x://a.org/"]), [], default_blocks=True).collect()} == {"block"}


def test_page_ids_pass_through(spark):
    ids = [9007199254740993, None, 1, 1, None]
    pages = spark.createDataFrame([(i, "x://com/de/a") for i in ids], "page_id long, url string").coalesce(1)
    got = urls.judged(pages, RULES)
    assert dict(got.dtypes)["page_id"] == "bigint" and [r.page_id for r in got.collect()] == ids
    named = spark.createDataFrame([("a", None)], "page_id string, url string")
    assert [tuple(r) for r in urls.judged(named, RULES).collect()] == [("a", "", "", None, "allow")]


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda data: len(data))  # all strings of a length collide
    urls.DigestArray.write([("aa/", True), ("bb/", False), ("aa/", False)], str(tmp_path))
    import numpy as np

    monkeypatch.setattr(urls, "mapped", lambda name, file, kind: np.fromfile(f"{tmp_path}/{file}", kind))
    array = urls.DigestArray("any")
    found = array.find([b"aa/", b"bb/", b"cc/"])
    assert [array.name(i) for i in found[:2]] == ["aa/", "bb/"] and found[2] == -1 and array.blocks[found[0]] == 1


def changes_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, op string, source string, lang string, version string, tokens long")


def test_rollup_follows_changes_once(spark, tmp_path):
    r = rollups.Rollup(spark, str(tmp_path / "r"))
    assert r.totals().count() == 0
    rows = [(1, "insert", "a", "en", "v", 5), (2, "insert", "a", None, "v", 7), (3, "insert", None, "en", "v", 0), (None, "insert", "a", "en", "v", 2)]
    assert r.commit("one", changes_of(spark, rows + rows[:1])) is True  # rows that share an id all count
    state = lambda: sorted((tuple(x) for x in r.totals().collect()), key=str)
    first = sorted([("a", "en", "v", 3, 12), ("a", None, "v", 1, 7), (None, "en", "v", 1, 0)], key=str)
    assert state() == first
    assert r.commit("one", changes_of(spark, rows)) is False and state() == first
    r.commit("two", changes_of(spark, [
        (1, "revise", "b", "en", "v", 6), (2, "delete", "a", None, "v", 0), (9, "delete", "a", "en", "v", 3), (3, "insert", None, "en", "w", 4)]))
    assert state() == sorted([("b", "en", "v", 1, 6), ("a", "en", "v", 1, 2), (None, "en", "v", 1, 0), (None, "en", "w", 1, 4)], key=str)
    r.commit("none", changes_of(spark, []))
    assert len(state()) == 4
    r.commit("nameless", changes_of(spark, [(None, "insert", "a", "en", "v", 3), (None, "insert", "a", "en", "v", 3), (None, "delete", "a", "en", "v", 0)]))
    assert ("a", "en", "v", 3, 8) in state()  # rows without an id add up
    r.commit("both", changes_of(spark, [(1, "delete", "b", "en", "v", 0), (1, "revise", "c", "en", "v", 4), (1, "revise", "c", "en", "v", 5), (1, "insert", "d", "en", "v", 1)]))
    assert {("c", "en", "v", 2, 9), ("d", "en", "v", 1, 1)} <= set(state()) and not any(x[0] == "b" for x in state())
    r.commit("gone", changes_of(spark, [(1, "delete", None, None, "v", 0)]))
    assert not {"c", "d"} & {x[0] for x in state()}


def rolled_up(rows):
    """Totals after the three batches, by hand: texts as they are, one row per text, addresses taken out."""
    import re

    count = rollups.counter(rollups.VOCABULARY).count
    kept, seen = [], set()
    last = lambda x: (x is None, x or "")
    for i, source, lang, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, last(r[1]), last(r[2]))):
        if text is None or text not in seen:
            kept.append((source, lang, text))
            seen.add(text)
    totals = {}
    for source, lang, text in kept:
        n = count(re.sub(rollups.EMAIL, "", text) if text else text)
        docs, tokens = totals.get((source, lang), (0, 0))
        totals[source, lang] = (docs + 1, tokens + n)
    return sorted(((s, g, "byte_bpe_50k.tiktoken", *t) for (s, g), t in totals.items()), key=str)


def test_batches_count_every_row(spark, tmp_path):
    mail = "write to a.b@c.org now"
    rows = [(1, "a", "en", "one text"), (1, "b", "en", "another text"), (None, "a", "en", "third"), (None, "b", None, "fourth"), (None, "a", "en", None),
            (None, "a", "en", None), (2, "a", "en", "one text"), (2, "a", "en", "its own"), (3, "c", "en", mail), (3, "c", "en", mail), (None, "d", "en", mail),
            (4, None, "de", ""), (5, None, "de", ""), (6, "a", "en", mail + " too")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, text string, op string, tokens int")
    r = rollups.Rollup(spark, str(tmp_path / "r"))
    batches = rollups.document_batches(docs)
    r.commit(*batches[0])
    assert sum(x.n_docs for x in r.totals().collect()) == len(rows)
    for name, changes in [*batches[1:], batches[1]]:
        r.commit(name, changes)
    assert sorted((tuple(x) for x in r.totals().collect()), key=str) == rolled_up(rows)
    empty = rollups.Rollup(spark, str(tmp_path / "e"))
    for name, changes in rollups.document_batches(docs.where("false")):
        empty.commit(name, changes)
    assert empty.totals().count() == 0


def test_whole_table_agrees_with_a_count_by_hand(spark):
    import __spark_entry__ as contract

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "text").collect()]
    assert sorted((tuple(x) for x in contract.queries()["op7_token_counts"](spark, folder).collect()), key=str) == rolled_up(rows)


def test_failed_attempt_leaves_no_trace(spark, tmp_path):
    r = rollups.Rollup(spark, str(tmp_path / "r"))
    r.commit("one", changes_of(spark, [(1, "insert", "a", "en", "v", 5)]))
    changes_of(spark, [(2, "insert", "a", "en", "v", 100)]).write.parquet(str(tmp_path / "r/deltas/attempt=left-behind"))
    assert [tuple(x) for x in r.totals().collect()] == [("a", "en", "v", 1, 5)]


def test_token_counts_are_the_tokenizers(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(rollups.VOCABULARY, "rb"))}  # noqa: SIM115
    known = tiktoken.Encoding("own", pat_str=rollups.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "It's 12 o'clock — äé  \n\n  x ", "a" * 3000, "word " * 2000 + "\t\t", "<|endoftext|>"]
    docs = spark.createDataFrame([(i, "s", None, t, 1) for i, t in enumerate(texts)], "doc_id long, source string, lang string, text string, tokens int")
    got = {r.doc_id: r.tokens for r in rollups.counted(docs).collect()}
    assert got == {i: len(known.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert rollups.Counter(rollups.VOCABULARY).count(" " * 2_000_000) > 0  # no stack to overflow
