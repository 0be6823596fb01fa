"""Language identification, toxicity, language-model scores and page text."""

from __future__ import annotations

import html
import math
import random
import weakref
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventmart.llm import htmltext, langid, lm, subwords, textbytes, toxicity
from eventmart.llm.queries import word_tokenizer
from tests.conftest import SMALL
from tests.llm import tables


def _fold(key, n):
    return zlib.crc32(b"" if key is None else str(key).encode()) % n


def test_codewords_differ_and_no_column_is_constant():
    for n in (2, 3, 4, 9, 30):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code}) == n and (abs(code.sum(axis=0)) < n).all()
        least = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert least >= 3  # one wrong bit never changes the decision


def test_features_stay_inside_their_text():
    alone = [langid.featurize(pa.array([t])) for t in ("abc", "", "Été déjà", "z" * 50)]
    together = langid.featurize(pa.array(["abc", "", "Été déjà", "z" * 50]))
    assert np.allclose(np.vstack(alone), together)
    assert (together[1] == 0).all() and math.isclose(float((together[0] ** 2).sum()), 1, rel_tol=1e-5)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = langid.identify(docs).collect()
    assert len(found) == len(lang)
    assert all(r.held_out == (_fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_awkward_rows(spark):
    rows = tables.doc_rows()
    rows += [(900, "12 34 !? -- ", "en", *[None] * 4), (None, "ba1 ce2 di3", None, *[None] * 4), (901, "日本語", None, *[None] * 4)]
    found = langid.identify(tables.docs(spark, rows)).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    nothing = [r[0] for r in rows if r[1] is None or not any(c.isalpha() for c in r[1])]
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in nothing) and len(nothing) >= 4
    assert by_id[901].lang_pred == "en" and by_id[None].lang_pred == "en"
    unknown = tables.docs(spark, [(1, "some text", *[None] * 5)])
    assert [r.lang_pred for r in langid.identify(unknown).collect()] == ["und"]
    assert langid.identify(tables.docs(spark, [])).count() == 0


@pytest.fixture(scope="module")
def toxic_table():
    """Clean texts, and texts with a few words of two stems whose endings never repeat."""
    rng, rows = random.Random(8), []
    for i in range(1000):
        words = tables.random_text(rng, rng.randrange(10, 90)).split()
        toxic = i % 4 == 0
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["vork", "slugm"]) + "".join(rng.choices("aeioubcd", k=4)))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_of_unseen_forms(spark, toxic_table):
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_table] + [(5, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    rest = [None] * 5
    rows = [(i, t, *rest) for i, t, _ in toxic_table] + [(7000, None, *rest), (7001, "", *rest), (None, "ba1", *rest), (3, toxic_table[3][1], *rest)]
    found = toxicity.score(tables.docs(spark, rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    truth = {i: y for i, _, y in toxic_table}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (_fold(r.doc_id, 5) == 0) for r in found)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)
    kept = toxicity.keep_clean(tables.docs(spark, rows), labels)
    assert kept.columns == tables.docs(spark, rows).columns
    assert kept.count() == sum(r.predicted == 0 for r in found)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(tables.docs(spark), none).collect()} == {0}
    assert toxicity.score(tables.docs(spark, []), none).count() == 0


def test_passage_margins_equal_plain_averages():
    rng = random.Random(1)
    texts = [tables.random_text(rng, n) for n in (1, 3, 8, 9, 12, 31)] + ["", None]
    passages = toxicity.Passages(pa.array(texts))
    value = np.random.default_rng(0).normal(size=1 << toxicity.BUCKETS_LOG2)
    margins = passages.margins(value, 0.25)
    which, bucket, weight = passages.bag(np.arange(len(margins)))
    assert np.allclose(margins, 0.25 + np.bincount(which, value[bucket] * weight, minlength=len(margins)))
    covered = [set() for _ in texts]
    for t, lo, hi in zip(passages.text, passages.lo, passages.hi):
        covered[t].update(range(lo, hi))
    assert [len(c) for c in covered] == [1, 3, 8, 9, 12, 31, 0, 0]


def test_toxicity_trains_with_the_ngrams_of_one_block_at_a_time(monkeypatch):
    live, most, made = weakref.WeakSet(), [], []

    class Counted(toxicity.Passages):
        def __init__(self, column):
            live.add(self)
            most.append(len(live))
            made.append(len(column))
            super().__init__(column)

    rng = random.Random(9)
    texts = pa.array([" ".join(rng.choice(["good", "bad", "fine", "day"]) for _ in range(60)) for _ in range(200)])
    toxic = np.arange(200) % 2
    whole = toxicity.ToxicityModel(texts, toxic, 0.5)
    monkeypatch.setattr(toxicity, "Passages", Counted)
    monkeypatch.setattr(toxicity, "blocks", lambda batches, column: textbytes.blocks(batches, column, 4000))
    toxicity.ToxicityModel(texts, toxic, 0.5)
    # the one before goes when the next is there
    assert len(made) > 10 and max(most) <= 2
    # parts of the bytes have the same n-grams
    hashes = toxicity.Passages(texts).hashes
    monkeypatch.setattr(toxicity, "HASHED", 7)
    assert all((hashes[n] == h).all() for n, h in toxicity.Passages(texts).hashes.items())
    monkeypatch.undo()
    monkeypatch.setattr(toxicity, "HASHED", 7)
    assert (toxicity.ToxicityModel(texts, toxic, 0.5).value == whole.value).all()


def test_windows_score_every_id_once():
    n = np.array([1, 2, 24, 25, 31, 100])
    place, begin, end = lm._windows(n)
    scored = place[:, lm.OVERLAP :]
    inside = scored[(scored >= begin[:, None]) & (scored < end[:, None])]
    assert sorted(inside.tolist()) == list(range(n.sum()))


def test_probabilities_sum_to_one_and_look_back_only():
    counts = np.arange(400, 0, -1.0)
    model = lm.AttentionModel(counts, 399)
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 400, 60).astype(np.uint32)
    total = 0.0
    for last in range(400):
        ids[40] = last
        total += math.exp(model.log_probabilities(ids[:41], np.array([41]))[40])
    assert math.isclose(total, 1, rel_tol=1e-4)
    one = model.log_probabilities(ids, np.array([60]))
    ids[50:] = 7
    assert np.allclose(model.log_probabilities(ids, np.array([60]))[:50], one[:50], atol=1e-5)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(2)
    ids = np.tile(np.array([5, 6, 7, 5, 6, 8], np.uint32), 400)
    counts = np.bincount(ids, minlength=20).astype(float)
    model = lm.AttentionModel(counts, 19)
    before = model.log_probabilities(ids, np.array([len(ids)])).mean()
    model.train(ids, np.array([len(ids)]), steps=150)
    after = model.log_probabilities(ids, np.array([len(ids)])).mean()
    assert after > before + 0.5 and rng is not None


def test_base_scores_equal_brute_force(spark):
    rows = tables.doc_rows() + [(None, "ba1 new", *[None] * 5), (3, tables.doc_rows()[3][1], *[None] * 5)]
    counts, train = Counter(), [r for r in rows if _fold(r[0], 10)]
    for r in train:
        counts.update(tables.words(r[1]))
        counts[None] += 1
    n, kinds = sum(counts.values()), len(counts)
    found = lm.score(tables.docs(spark, rows), word_tokenizer(), 49407).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text, *_ in rows:
        tokens = tables.words(text) + [None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (kinds + 1))) for t in tokens)
        r = by_id[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(tokens), sum(counts[t] > 0 for t in tokens), n, _fold(i, 10) == 0)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert lm.score(tables.docs(spark, []), word_tokenizer(), 49407).count() == 0


def test_scores_use_the_counts_of_all_words(spark, monkeypatch):
    """Which words' counts are sent to all tasks changes no score."""
    rows = tables.doc_rows() + [(3, tables.doc_rows()[3][1], *[None] * 5)]

    def scores():
        found = lm.score(tables.docs(spark, rows), word_tokenizer(), 49407).collect()
        return sorted((r.doc_id, r.n_known, r.base_score, r.score) for r in found)

    whole = scores()
    monkeypatch.setattr(lm, "TOP_WORDS", 20)
    few = scores()
    assert len(few) == len(rows) and [r[:2] for r in few] == [r[:2] for r in whole]
    assert np.allclose([r[2:] for r in few], [r[2:] for r in whole], rtol=1e-6)


def test_the_model_learns_from_all_training_texts(spark, monkeypatch):
    """More texts than a sample would hold, in several rounds and tasks; what only the later ones have is learned."""
    monkeypatch.setattr(lm, "SHARE", 100)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["red", "green"]) + " " + rng.choice(["house", "tree"]) for _ in range(20)) for _ in range(2000)]
    training = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0]), (5, texts[5])], "doc_id long, text string").repartition(5)
    scorer, _ = lm.train(training, word_tokenizer(), 49407)
    assert scorer.learned == 2002 - lm.WEIGHT_DOCS - (5 in _weighing(training))
    ids, n = lm.encode_texts(pa.array(texts[:50]), word_tokenizer(), 49407)
    # each pair of words is one of four: about half a bit a word and more than that if nothing was learned
    assert scorer.model.log_probabilities(ids, n).mean() > -0.9


@pytest.mark.parametrize("top, share", [(1 << 18, 20_000), (2, 20_000), (2, 20)])
def test_the_weight_is_fitted_on_all_training_tokens(spark, monkeypatch, top, share):
    monkeypatch.setattr(lm, "TOP_WORDS", top)
    monkeypatch.setattr(lm, "SHARE", share)
    monkeypatch.setattr(lm, "STEPS", 20)
    seen = []
    monkeypatch.setattr(lm.Scorer, "fit_weight", lambda s, bins, n, fit=lm.Scorer.fit_weight: (seen.append((bins, n)), fit(s, bins, n)))
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["red", "green", "blue", "x1y"]) for _ in range(20)) for _ in range(600)] + ["", "once"]
    training = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    scorer, rare = lm.train(training, word_tokenizer(), 49407)
    (bins, n), = seen
    assert n.sum() == scorer.n_tokens == 600 * 21 + 3 and scorer.learned == 602
    if share == 20:
        # in several rounds each id is learned once, and the model itself is asked
        log_p, count, text, _, hashes = scorer.parts(pa.array(texts))
        known = {r.hash: r.n for r in rare.collect()}
        for i in np.flatnonzero(count < 0):
            count[i] = known[int(hashes[i - text[i]].view(np.int64))]
        part, p, w = (np.maximum(count - 1, 0) + 0.1) / scorer.total, np.exp(log_p), 0.5
        for _ in range(30):
            w = float(np.clip((w * part / (w * part + (1 - w) * p)).mean(), 0.02, 0.98))
        assert math.isclose(scorer.weight, w, abs_tol=1e-3)


def test_texts_are_passed_three_times(spark, monkeypatch):
    """Their words are counted, they are encoded, and the model judges them, for the weight and for the scores at once."""
    monkeypatch.setattr(lm, "SHARE", 20)
    passes, frame = [], type(spark.range(1))
    monkeypatch.setattr(frame, "mapInArrow", lambda df, *a, run=frame.mapInArrow: (passes.append("text" in df.columns), run(df, *a))[1])
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["red", "green", "x1y"]) for _ in range(20)), *[None] * 5) for i in range(300)]
    found = lm.score(tables.docs(spark, rows), word_tokenizer(), 49407)
    assert found.count() == 300 and sum(passes) == 3


def test_words_are_encoded_alike_with_and_without_a_table():
    texts = pa.array(["one two'll three", None, "", "\u00a0 Été 日本 x1y2 \u2003", "one two\u00a0 " * 30, " "])
    words = textbytes.Words(*textbytes.text_bytes(texts))
    want = subwords.encode_words(words, words.hashes(), word_tokenizer(), 49407)
    for most in (0, 3, 1000):
        table = subwords.WordTable(word_tokenizer(), most)
        for _ in range(2):
            got = subwords.encode_words(words, words.hashes(), word_tokenizer(), 49407, table)
            assert all((a == b).all() for a, b in zip(got, want)) and len(table.hashes) <= most
    # the lengths of words, some of which have no id
    length = want[2]
    size, bits = lm._bits(length, words)
    column = pa.Array.from_buffers(pa.binary(), len(size), [None, lm._offsets(size), pa.py_buffer(bits)])
    assert 0 in length and (lm._lengths(column, words) == length).all() and (lm._lengths(column.slice(3), _words(texts[3:])) == length[3:]).all()


def _words(column):
    return textbytes.Words(*textbytes.text_bytes(column))


def _weighing(training):
    order = lm.F.xxhash64(lm.F.lit(17), "doc_id")
    rows = training.select("doc_id").where("doc_id is not null").distinct().orderBy(order, "doc_id").limit(lm.WEIGHT_DOCS)
    return {r.doc_id for r in rows.collect()}


def test_page_text():
    tree = htmltext.train_tree(*htmltext.labelled_table())
    x, y = htmltext.labelled_table()
    assert ((htmltext.classify(tree, x) >= 0.5) == y).all()
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head><body>
    <nav><ul><li><a href="/">Home</a></li></ul></nav><div class='ad box'>Buy now, and buy a lot of it while there is still some</div>
    <article><h1>Über &amp; out</h1><p><b>One\n two&nbsp;three<br><p>4 &lt; 5</p><p> </p><!-- <p>hidden</p> --><p>Last one</article>
    <section id="comments"><p>I have read this with great pleasure and would like to read more of it soon.</p></section>
    <footer>&copy; 2020</footer>"""
    assert htmltext.main_text(page, tree) == "Über & out\n\nOne two three\n\n4 < 5\n\nLast one"
    assert htmltext.main_text(None, tree) == htmltext.main_text("", tree) == htmltext.main_text("<nav>x</nav>", tree) == ""
    deep = "<div>" * 20_000 + "<article><p>found in here</p></article>"
    assert htmltext.main_text(deep, tree) == "found in here"
    assert htmltext.main_text("<a" * 50_000 + '"' * 9, tree) is not None


def test_many_unclosed_cells_end_with_their_table():
    tree = htmltext.train_tree(*htmltext.labelled_table())
    cells = "<td>x " * 200
    article = "<div><p>The rain came late this year, and the fields along the river were dry until the second week of the month.</p></div>"
    page = f"<nav><table><tr>{cells}</tr></table></nav>{article}"
    assert "The rain came late" in htmltext.main_text(page, tree)


def test_page_extraction_keeps_every_row(spark):
    rows = [(1, "u", "<article><p>Some text &eacute;</p></article>", 1), (1, "u", None, 2), (None, None, "", 3), (2, "v", "plain", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = sorted((tuple(r) for r in htmltext.extract(pages).collect()), key=repr)
    assert (1, "u", "Some text " + html.unescape("&eacute;"), 11) in found and (1, "u", "", 0) in found and (None, None, "", 0) in found
    assert len(found) == 4 and htmltext.extract(pages.limit(0)).count() == 0
