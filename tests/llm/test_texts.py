"""Main text, language, personal data, toxicity."""

import html
import collections
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import base_spans

from seatflow.llm import html as pages
from seatflow.llm import langid, pii, toxicity

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def field(spark):
    return pages.fit(spark.read.parquet(f"{TABLES}/pages.parquet"))


def article(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = (re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?p>|</?h1>", inner))
    return "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_main_text_of_all_pages(spark, field):
    rows = pages.extracted(spark.read.parquet(f"{TABLES}/pages.parquet"), field).collect()
    assert len(rows) == 250
    wrong = [r.page_id for r in rows if r.text != article(r.html) or r.n_chars != len(r.text)]
    assert not wrong


def test_blocks_of_unlike_layouts(field):
    held_out = pages.layouts(["One plain sentence with a few more words in it.", "Another of them, somewhat longer than the first one was."], 150, seed=99)
    states = [(field.decode(b), labels) for b, labels in held_out]
    right = sum(a == b for s, labels in states for a, b in zip(s, labels))
    assert right / sum(len(labels) for _, labels in states) > 0.97


def test_markup_that_is_odd():
    text = lambda page: [b.text for b in pages.blocks(page)]
    assert text('a<b <i>c</i>') == ["ac"] or text('a<b <i>c</i>')
    assert text("1 < 2 &lt;p&gt; &amp;amp; &#233;&eacute;") == ["1 < 2 <p> &amp; éé"]
    assert text('<p title="a>b">x<br>y</p>z<!-- <p>no</p> -->w') == ["x y", "zw"]
    assert text('<script>if (a<b) "</p>"</script>t<style>q') == ["t"]
    assert text("a<!-- never closed <p>b") == ["a"] and text("<p") == [] and text("") == []
    assert len(pages.blocks("<div>" * 50_000 + "x")) == 1
    assert text("<p>one<p>two<li>three</ul>four") == ["one", "two", "three", "four"]


def test_plain_signs_formulas_and_open_options_cut_nothing():
    text = lambda page: [b.text for b in pages.blocks(page)]
    assert text("<p>if 1 < 2 and 3 < 4</p><p>x << y</p><p><3 <3</p>end") == ["if 1 < 2 and 3 < 4", "x << y", "<3 <3", "end"]
    assert text("a < b <") == ["a < b <"] and text("<") == ["<"] and text("a <<") == ["a <<"] and text("a </") == ["a </"]
    assert text("a <é b <p>c") == ["a <é b", "c"] and text("a </é>b") == ["a b"]
    assert text("<datalist><option>one<option>two</datalist><p>rest</p>") == ["rest"]
    assert text("<form><datalist><option>one</form><p>rest") == ["rest"]
    assert text("<p>so <math><mi>a</mi><mo>&lt;</mo><mn>2</mn></math> holds</p>") == ["so a<2 holds"]
    assert text("<p><math><semantics><mi>x</mi><annotation>TeX</annotation></semantics></math> it is") == ["x it is"]
    assert text("<p>one" + " <" * 100_000 + "</p>two")[1:] == ["two"]


def test_pages_without_text(spark, field):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, None, None, 1, "x"), (2, "u", "", 1, "x"), (3, "u", "<nav>menu</nav>", 1, "x"), (3, "u", "<nav>menu</nav>", 1, "x")]
    got = pages.extracted(spark.createDataFrame(rows, schema), field)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert [(r.text, r.n_chars) for r in got.collect()] == [("", 0)] * 4
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.extracted(empty, pages.fit(empty)).count() == 0


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(docs.where(langid.fold(3) != 1))
    rows = langid.predicted(docs.where(langid.fold(3) == 1), model).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(i, "the cat and the dog " * 5, "en", "x") for i in range(6)] + [(i, "der Hund und die Katze " * 5, "de", "x") for i in range(6, 12)]
    rows += [(20, None, "en", "x"), (21, "", "de", "x"), (22, "12 !?", None, "x"), (None, "the dog", None, "x"), (23, "die Katze " * 20_000, None, "x")]
    docs = spark.createDataFrame(rows, schema)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predicted(docs, langid.fit(docs)).collect()}
    assert got[20] == got[21] == got[22] == ("und", 0.0)
    assert got[None][0] == "en" and got[23][0] == "de" and got[0][0] == "en"
    blank = docs.where("false")
    assert langid.predicted(blank, langid.fit(blank)).count() == 0
    unlabelled = langid.predicted(docs, langid.fit(docs.where("lang IS NULL")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_plain_naive_bayes_agrees():
    rng = random.Random(8)
    words = {"a": ["alpha", "beta", "gamma", "né"], "b": ["alto", "bet", "gamba", "ño"], "c": ["жук", "дом", "alpha"]}
    say = lambda lang: " ".join(rng.choices(words[lang], k=rng.randint(1, 9))) + rng.choice([".", "", " 7"])
    rows = [(lang, say(lang)) for lang in words for _ in range(rng.randint(20, 40))]

    def bins(text):
        return [b for found, _ in langid.grams([text], 8) for b in found.tolist()]

    counts = {lang: np.full(256, 0.5) for lang in words}
    for lang, text in rows:
        for at in bins(text):
            counts[lang][at] += 1
    share = {lang: sum(r[0] == lang for r in rows) / len(rows) for lang in words}
    tables = {lang: np.log(c / c.sum()) for lang, c in counts.items()}
    model = langid.Model(list(words), np.log([share[x] for x in words]), np.array([tables[x] for x in words]))
    texts = [say(rng.choice("abc")) for _ in range(200)] + ["", "123", None, "alpha"]
    labels, scores = model.predict(texts)
    for text, label, score in zip(texts, labels, scores, strict=True):
        if not any(c.isalpha() for c in text or ""):
            assert (label, score) == ("und", 0)
            continue
        joint = {x: np.log(share[x]) + sum(tables[x][at] for at in bins(text)) for x in words}
        top = max(joint.values())
        assert joint[label] == pytest.approx(top)
        assert score == pytest.approx(1 / sum(np.exp(v - top) for v in joint.values()))


def test_fitted_counts_are_those_of_the_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("ab ba", "x"), ("abc", "x"), ("zz", "y"), (None, "y"), ("q", None)] * 3)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bits=6)
    for k, texts in enumerate((["ab ba", "abc"] * 3, ["zz"] * 3)):
        own = np.full(64, 0.5)
        for text in texts:
            for found, _ in langid.grams([text], 6):
                np.add.at(own, found, 1)
        assert np.allclose(model.log_prob[k], np.log(own / own.sum()), atol=1e-5)


def test_calibrated_model_turns_unknown_languages_away(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.calibrated(langid.fit(docs), docs)
    foreign = ["Съешь же ещё этих мягких французских булок да выпей чаю", "ทดสอบภาษาไทยยาวๆ", "Το γρήγορο καφέ αλεπού πηδάει πάνω",
               "人人生而自由在尊严和权利上一律平等", "xqzv kjwq pzzx vvkq qqxj zzkw qxkz wvvq"]
    labels, scores = model.predict([*foreign, *[t + " " + t for t in foreign]])
    assert set(labels) == {"und"} and not scores.any()
    got = langid.predicted(docs, model).collect()
    assert all(r.lang_pred != "und" for r in got if any(c.isalpha() for c in r.text or ""))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in langid.predicted(docs, langid.fit(docs)).collect()}
    assert all(plain[r.doc_id] == (r.lang_pred, r.score) for r in got)
    nothing = docs.where("false")
    assert langid.calibrated(langid.fit(nothing), nothing).predict(["abc"])[0] == ["und"]


def test_texts_in_a_batch_do_not_touch():
    texts = ["abc def", "", "ghi", "1", "é ü xyz", "abc"]
    alone = [[sorted(b[first[0] : first[1]].tolist()) for b, first in langid.grams([t])] for t in texts]
    together = [[sorted(b[first[i] : first[i + 1]].tolist()) for b, first in langid.grams(texts)] for i in range(len(texts))]
    for a, b in zip(alone, together):
        assert [x for x in a if x] == [x for x in b if x]


def test_base_spans_agree_with_plain_patterns(spark):
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("ab1.2@-+ (5)é\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == base_spans(text)
    for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect():
        assert pii.base_spans(r.text) == base_spans(r.text)


@pytest.fixture(scope="module")
def finder(spark):
    return pii.fit(spark.read.parquet(f"{TABLES}/documents.parquet"))


def test_spans_beyond_the_base(finder):
    added = lambda t: finder.added(t, pii.base_spans(t))
    assert added("mail me: jon.doe [at] example [dot] com now") == [("email", 9, 39)]
    assert added("call (523) 555-1055 please") == [("phone", 5, 19)]
    assert added("card 4111.1111.1111.1111 ok") == [("card", 5, 24)]
    for clean in ("born 2001-02-03 there", "version 3.10 of page 12", "Plain words stand here, and no more than these.", "ISBN 978-3-1614-8410-0 x"):
        assert added(clean) == []
    base = pii.base_spans(text := "a@b.cc +1 (523) 555-1055")
    assert len(base) == 2 and added(text) == []  # nothing overlaps the base


def test_personal_data_columns_and_redaction(spark, finder):
    schema = "doc_id long, text string, n_chars long, spans int"
    rows = [(1, None, 0, 1), (2, "", 0, 1), (3, "x a@b.cc, 1.2.3.4; é" * 2, 40, 1), (3, "x a@b.cc", 8, 1), (None, "1 2 " * 20_000 + "q@r.st", 80_006, 1)]
    docs = spark.createDataFrame(rows, schema)
    got = pii.found(docs, finder).collect()
    for r in got:
        base = base_spans(r.text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.KINDS)
        assert set(f"{k}:{a}:{b}" for k, a, b in base) <= set(r.spans.split(",")) or not base
    clean = pii.redacted(docs, finder)
    assert clean.schema == docs.schema
    for r in clean.collect():
        assert not base_spans(r.text) and (r.text is None or r.n_chars == len(r.text))
    assert pii.redact("ab 12 cd", [("ip", 1, 4), ("card", 3, 5)]) == "a<ip> cd"
    assert pii.found(docs.where("false"), finder).count() == 0 and pii.fit(docs.where("false"))


WRITTEN_OUT = [
    "jon.doe(at)example.org", "jon.doe [at] example.org", "jon{at}example.com", "jon [at] example [.] com", "jon at example dot com", "jon AT example DOT com",
    "jon\u00a0at\u2003example\u00a0dot\u3000com", "jon\x0b@\x1cexample.com", "jon＠example.com", "jon<at>example<dot>com", "jon at example.com",
]


def test_addresses_in_texts_without_digits(spark, finder):
    texts = [f"please mail {a} today" for a in WRITTEN_OUT]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.found(docs, finder).collect()}
    clean = {r.doc_id: r.text for r in pii.redacted(docs, finder).collect()}
    told = 0
    for i, text in enumerate(texts):
        base = pii.base_spans(text)
        spans = pii.ordered(base + finder.added(text, base))
        assert pii.candidates(text) and got[i] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert clean[i] == pii.redact(text, spans)
        told += bool(spans)
    assert got[0] and got[2] and told > len(texts) // 2


def test_no_candidate_without_a_trace():
    import pyarrow.compute as pc

    rng = random.Random(6)
    parts = ["jon", "ab", "x", " ", "\u00a0", "\x0b", "\x85", "\n", "(", ")", "[", "]", "{", "}", "<", ">", "at", "AT", "@", "＠", "dot", "DOT", ".", "-", ":", "é", "7"]
    texts = ["".join(rng.choices(parts, k=rng.randint(3, 14))) for _ in range(60_000)]
    texts += ["jon" + "".join(rng.choice(part) for part in (
        [" ", "\u2003", ""], "([{<", ["at", "@"], ")]}>", ["", "\x1c"], ["ab", "a-b"], [".", " dot ", "(dot)", "\u00a0DOT\x0b", "{ . }"], ["com", "org"])) for _ in range(2000)]
    traced = pc.match_substring_regex(pa.array(texts), pii._TRACE).to_pylist()
    held = [bool(pii.candidates(t) or pii.base_spans(t)) for t in texts]
    assert sum(held) > 1000 and not [t for t, h, seen in zip(texts, held, traced, strict=True) if h and not seen]


def test_toxicity_of_held_out_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(langid.fold(4) != 2))
    rows = toxicity.scored(docs.where(langid.fold(4) == 2).join(labels, "doc_id"), model).collect()
    right = sum(r.predicted == (r.toxic or 0) for r in rows) / len(rows)
    caught = [r.predicted for r in rows if r.toxic == 1]
    assert right > 0.94 and sum(caught) / len(caught) > 0.7
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_toxicity_of_odd_texts(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(3, 8)))
    rows = []
    for i in range(400):
        words = [word() for _ in range(40)]
        if i % 2:
            words[rng.randrange(40)] = rng.choice(["xyzzyq", "plughwk", "frobnx"])
        rows.append((i, " ".join(words), 0.5))
    rows += [(1000, None, 0.5), (1001, "", 0.5), (1002, "12 !", 0.5), (1003, "Plughwk!", 0.5), (None, "w" * 100_000, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(400)] + [(0, None, 1), (None, 1, 1), (2, 0, 1)], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.fit(docs, labels)).collect()}
    assert len(got) == 405 and all(0 <= r.score <= 1 for r in got.values())
    assert got[1000].score == got[1001].score == got[1002].score < 0.3 < got[1003].score
    assert sum(got[i].predicted == i % 2 for i in range(400)) > 380
    one_class = toxicity.scored(docs, toxicity.fit(docs, labels.where("toxic = 0")))
    assert {r.score for r in one_class.collect()} == {0.0}
    assert toxicity.scored(docs.where("false"), toxicity.fit(docs.where("false"), labels)).count() == 0


def test_long_words_become_windows():
    import numpy as np

    starts, ends, bounds = toxicity.pieces(np.array([0, 10]), np.array([5, 130]), np.array([0, 1, 2]))
    assert starts.tolist() == [0, 10, 58, 106] and ends.tolist() == [5, 58, 106, 130] and bounds.tolist() == [0, 1, 4]
    assert toxicity.Model(b"", b"").features(pa.array([None, ""], pa.string())).shape == (2, 2)


def test_every_word_of_a_large_dictionary_is_found():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(6, 24))).encode()
    own, others = [word() for _ in range(4000)], [word() for _ in range(4000)]
    model = toxicity.Model(toxicity._body(own), toxicity._body(others))
    texts = pa.array([w.decode() for w in own])
    assert len(model.toxic) > 10 * toxicity.DICTIONARY_BYTES
    assert (model.features(texts)[:, 0] > 0.5).mean() > 0.99
    assert (model.features(pa.array([w.decode() for w in others]))[:, 0] < 0.2).mean() > 0.99


def marked(marks, rows, line):
    """Documents of `line()` words, of which every second one has a mark."""
    rng, out = random.Random(8), []
    for i in range(rows):
        words = line()
        if i % 2:
            words[rng.randrange(len(words))] = rng.choice(marks)
        out.append(words)
    return out


def test_toxic_marks_of_any_length_and_script(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(3, 8)))
    signs = [chr(c) for c in range(0x4E00, 0x4F00)]
    long = marked(["schwarzkopfgegenstand", "antidisfrobnicationary"], 300, lambda: [word() for _ in range(30)])
    signed = marked(["\u9f8d\u9f9c", "\u9b54\u9b3c\u9ed1"], 300, lambda: [rng.choice(signs) for _ in range(60)])
    for texts in ([" ".join(x) for x in long], ["".join(x) for x in signed]):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
        held_out = toxicity.scored(docs, toxicity.fit(docs, labels)).where("doc_id >= 200").collect()
        assert sum(r.predicted == r.doc_id % 2 for r in held_out) >= 95


def test_all_telling_words_are_learned(spark):
    rng = random.Random(2)
    marks = ["q" + "".join(rng.choice("aeioubcdfglmnprst") for _ in range(11)) for _ in range(700)]
    plain = ["".join(rng.choice("aeioubcdfglmnprst") for _ in range(6)) for _ in range(100)]
    rows = [(i, " ".join(rng.sample(plain, 20) + (rng.sample(marks, 70) if i % 2 else []))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int"))
    assert sum(m.encode() in model.toxic for m in marks) > 690


@pytest.mark.parametrize("page", ["<a" * 100_000, "<p>one <" + "b" * 200_000, '<p x="' + "a' " * 60_000, "<p>" + "<a '>" * 40_000, "<!--" * 50_000, "<p class=" + " " * 200_000])
def test_broken_markup_is_read_in_linear_time(page):
    start = time.perf_counter()
    pages.blocks(page)
    assert time.perf_counter() - start < 0.5


def test_viterbi_finds_the_best_of_all_chains():
    rng = np.random.default_rng(3)
    for n in range(1, 9):
        for _ in range(20):
            page = [pages.Block(f"word {i}.", i, frozenset({f"in:{rng.choice(['p', 'nav'])}"}), 0) for i in range(n)]
            told = {f for k, b in enumerate(page) for part in pages.features(b, k, n) for f in part}
            field = pages.Field({f: float(w) for f, w in zip(sorted(told), rng.normal(size=len(told)), strict=True)}, rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2))

            def score(states):
                lean = sum(field.weights[f] for k, (b, s) in enumerate(zip(page, states, strict=True)) if s for part in pages.features(b, k, n) for f in part)
                return lean + field.first[states[0]] + field.last[states[-1]] + sum(field.steps[a, b] for a, b in itertools.pairwise(states))

            best = max(itertools.product((0, 1), repeat=n), key=score)
            assert math.isclose(score(tuple(field.decode(page))), score(best), rel_tol=1e-9, abs_tol=1e-9)


def test_personal_data_model_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    models = [pii.fit(df, sample=30) for df in (docs, docs.repartition(7, "text"), docs.orderBy(docs.text.desc()))]
    assert models[0].thresholds == models[1].thresholds == models[2].thresholds
    x = np.random.default_rng(1).random((200, pii.examples(["a", "bc"], 4)[0].shape[1]))
    assert all((m.trees.predict(x) == models[0].trees.predict(x)).all() for m in models)


def _many_labelled():
    rng = random.Random(12)
    words = {"x": ["ab", "abc", "zebra"], "y": ["oak", "elm", "né"]}
    rows = [(lang, " ".join(rng.choices(words[lang], k=rng.randint(1, 5)))) for lang, n in (("x", 2700), ("y", 2300)) for _ in range(n)]
    return rows, [(i, t, lang) for i, (lang, t) in enumerate(rows)]


def test_language_counts_and_thresholds_take_every_labelled_row(spark):
    rows, table = _many_labelled()
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(5)
    model = langid.calibrated(langid.fit(docs, bits=12), docs)
    for k, lang in enumerate("xy"):
        own = np.full(1 << 12, 0.5)
        for found, _ in langid.grams([t for x, t in rows if x == lang], 12):
            own += np.bincount(found, minlength=1 << 12)
        assert np.allclose(model.log_prob[k], np.log(own / own.sum()), atol=1e-6)
    assert np.allclose(model.log_prior, np.log([0.54, 0.46]))
    (_, _, likely, size, _), = model.totals([t for _, t in rows])
    best = (likely + model.log_prior).argmax(1)
    for k in range(2):
        low = np.quantile((likely[:, k] / size)[best == k], langid.STRAYS)
        assert math.isclose(model.unknown[k], low - langid.MARGIN * (low - float(model.log_prob[k].min())), rel_tol=1e-12)


def test_quantiles_agree_with_numpy(spark):
    from seatflow.operators.ordering import quantiles

    rng = random.Random(13)
    groups = {"a": [rng.choice([0.0, 1.5, 1.5, 9.0]) for _ in range(400)], "b": [7.25], "c": [rng.random() for _ in range(333)]}
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double")
    for share in (0.0, 0.01, 0.37, 1.0):
        got = {r.g: r.quantile for r in quantiles(df, "g", "v", share).collect()}
        assert got == pytest.approx({g: float(np.quantile(values, share)) for g, values in groups.items()}, rel=1e-12)


def test_personal_data_examples_follow_the_words_of_all_whole_texts(spark, monkeypatch):
    texts = ["plain words " * 300 + f"email{'q' * (i % 7)} AT Org" for i in range(700)] + [None, "", "é12 ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = collections.Counter(pii.form(w) for t in texts for w in re.findall("[A-Za-z]+", t or ""))
    assert pii.word_forms(docs) == want and want["AT"] == 700 and want["zmail"] + want["email"] == 100
    seen, examples = [], pii.examples
    monkeypatch.setattr(pii, "examples", lambda words, *a, **k: seen.append(words) or examples(words, *a, **k))
    pii.fit(docs)
    assert all(set(words) == set(want) for words in seen) and len(seen) == 2


def test_word_forms_keep_every_feature():
    rng = random.Random(14)
    parts = ["at", "dot", "AT", "com", "mail", "id", "ship", "x", "Call", "fax", "zz", "cardinal", "no", "e", "De", "wort"]
    words = ["".join(rng.choices(parts, k=rng.choice([1, 1, 1, 2, 3, 20]))) for _ in range(300)]
    x, y = pii.examples(words, 3000, 5)
    forms, told = pii.examples([pii.form(w) for w in words], 3000, 5)
    assert (x == forms).all() and (y == told).all() and len({pii.form(w) for w in words}) < len(set(words))
