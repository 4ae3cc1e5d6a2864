"""Language ID, quality, HTML: held-out accuracy and sums over all cases."""

import itertools
import math
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cases import empty_docs, hard_docs, hard_rows
from lotflow.llm import html_text, language_id, quality_pu
from lotflow.llm.texts import table

DIR = "/root/testdata/sf0.01"


def all_cuts(word):
    for marks in itertools.product((0, 1), repeat=len(word) - 1):
        parts, begin = [], 0
        for at, mark in enumerate(marks, 1):
            if mark:
                parts.append(word[begin:at])
                begin = at
        yield [*parts, word[begin:]]


@pytest.mark.parametrize("word", ["abca", "a", "zz", "bcabca"])
def test_forward_sums_all_segmentations(word):
    pieces = ["a", "ab", "b", "bc", "c", "ca", "▁", "▁a", "▁ab"]
    draw = np.random.default_rng(3).random((len(pieces), 2))
    model = language_id.LanguageModel(["x", "y"], pieces, draw / draw.sum(axis=0), np.log([0.5, 0.5]))
    place = {piece: n for n, piece in enumerate(pieces)}
    marked = "▁" + word
    expected = np.zeros(2)
    for parts in all_cuts(marked):
        # a letter may also be read as unknown, next to being a piece of its own
        options = [([model.probability[place[part]]] if part in place else []) + ([np.full(2, language_id.UNKNOWN_LETTER)] if len(part) == 1 else []) for part in parts]
        for choice in itertools.product(*options):
            expected += np.prod(choice, axis=0)
    matcher = language_id.Matcher(pieces)
    assert np.allclose(np.exp(model.word_scores([word], matcher)[0]), expected)
    assert np.allclose(model._long(word, matcher), np.log(expected))


def test_long_words_do_not_underflow():
    model = language_id.LanguageModel(["x"], ["a", "aa"], np.array([[0.3], [0.1]]), np.zeros(1))
    score = model.word_scores(["a" * 5000], language_id.Matcher(model.pieces))[0, 0]
    assert math.isfinite(score) and score < -100


def test_op3_held_out(spark):
    found = contract.queries()["op3_language_pieces"](spark, DIR).join(table(spark, DIR, "documents").select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out AND lang IS NOT NULL").collect()
    assert sum(row.lang_pred == row.lang for row in rows) >= 0.98 * len(rows) > 0
    assert all(0 <= row.score <= 1 for row in rows)


def test_language_hard_rows(spark):
    model = language_id.train(table(spark, DIR, "documents").limit(200))
    got = {row.doc_id: row for row in language_id.predict(hard_docs(spark), model).collect()}
    assert all((got[n].lang_pred, got[n].score) == ("und", 0.0) for n in (0, 1, 2))
    assert got[5].lang_pred in model.languages and got[6].lang_pred in model.languages and 0 <= got[8].score <= 1
    assert language_id.predict(hard_docs(spark), model).count() == len(hard_rows())
    nothing = language_id.train(empty_docs(spark))
    assert {row.lang_pred for row in language_id.predict(hard_docs(spark), nothing).collect()} == {"und"}
    assert language_id.predict(empty_docs(spark), model).count() == 0


def test_op2_held_out(spark):
    found = contract.queries()["op2_quality_pu"](spark, "/root/testdata/sf0.1").where("held_out").join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    rows = found.collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert np.mean([r.predicted == 1 for r in good]) >= 0.97 and np.mean([r.predicted == 0 for r in bad]) >= 0.9
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_prior_and_hard_rows(spark):
    draw = np.random.default_rng(0)
    good = draw.normal(2, 1, (2000, 3))
    mixed = np.concatenate([draw.normal(2, 1, (1400, 3)), draw.normal(-2, 1, (600, 3))])
    assert abs(quality_pu.estimate_prior(good, draw.permutation(mixed)) - 0.7) < 0.08
    assert quality_pu.train(good[:0], mixed) is None
    scores = quality_pu.quality_scores(hard_docs(spark), None)
    assert scores.count() == len(hard_rows()) and {row.score for row in scores.collect()} == {0.5}
    assert quality_pu.learn(empty_docs(spark), spark.createDataFrame([], "doc_id long, quality int")) is None
    assert all(len(quality_pu.features(row[1])) == quality_pu.N_FEATURES for row in hard_rows())


def test_pages(spark):
    rows = contract.queries()["op8_html_lstm"](spark, DIR).collect()
    pages = {row.page_id: row.html for row in table(spark, DIR, "pages").collect()}
    assert len(rows) == len(pages)
    same = 0
    for row in rows:
        inside = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.S).group(1)
        parts = [" ".join(re.sub(r"<[^>]*>", " ", part).split()) for part in re.split(r"</?(?:p|h1)>", inside)]
        same += row.text == "\n\n".join(__import__("html").unescape(part) for part in parts if part)
        assert row.n_chars == len(row.text)
    assert same >= 0.98 * len(rows)


def test_page_cutting():
    cut = lambda page: [block.text for block in html_text.blocks_of(page)]
    assert cut(None) == cut("") == cut("<p></p>") == cut('<script>var t="</p>x";</script>') == []
    assert cut("<p>a&amp;b\n c<br>d<p>e <b>f</b>g</p>") == ["a&b c d", "e fg"]
    assert cut('<div title="a>b">x</div><!-- y --> z <') == ["x", "z <"]
    assert cut("<li>a<li>b<td>c") == ["a", "b", "c"]
    assert len(cut("<div>" * 3000 + "x" + "<p>y" * 3000)) == 3001


def test_pages_hard_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p>" + "w " * 50_000), (3, "u", "<p>" + "w " * 50_000), (None, "u", "<article><p>A text, it is.</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = html_text.learn(pages)
    got = html_text.main_texts(pages, model).collect()
    assert len(got) == 5 and all(row.n_chars == len(row.text) for row in got) and [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert html_text.main_texts(pages.limit(0), model).collect() == []


def test_lstm_slopes():
    """Slopes of the loss against differences."""
    random = np.random.default_rng(1)
    part = html_text.Lstm(random)
    rows = random.normal(size=(4, 2, html_text.N_INPUT)).astype(np.float32)
    mask = np.array([[True, True], [True, True], [True, True], [True, False]])
    toward = random.normal(size=(4, 2, html_text.HIDDEN)).astype(np.float32) * mask[:, :, None]
    kept = []
    part.run(rows, mask, kept)
    slopes = part.back(rows, kept, toward)
    for weights, slope, place in ((part.inputs, slopes[0], (5, 3)), (part.state, slopes[1], (2, 30)), (part.bias, slopes[2], (45,))):
        held, step = weights[place].copy(), 1e-2
        weights[place] = held + step
        above = float((part.run(rows, mask) * toward).sum())
        weights[place] = held - step
        below = float((part.run(rows, mask) * toward).sum())
        weights[place] = held
        assert abs((above - below) / (2 * step) - slope[place]) < 2e-2 * max(1, abs(slope[place]))


def test_scores_do_not_see_labels(spark):
    assert F is not None
    plain = hard_docs(spark).select("doc_id", "text")
    one = quality_pu.quality_scores(plain, None).columns
    assert one == ["doc_id", "score", "predicted"]


def test_only_letters_make_words():
    signs = [chr(code) for code in range(0x110000) if unicodedata.category(chr(code)) in ("Nd", "Nl", "No")]
    assert language_id.words_in(" ".join(signs)) == [] and language_id.words_in("a½b x_y") == ["a", "b", "x", "y"]


def test_fit_against_all_segmentations():
    """One round of expected counts, also of words past the bound for plain products."""
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "bab"]
    words, counts = ["ab", "abab", "b", "c", "ab" * 3], [3, 1, 2, 1, 1]

    def ways(rest):
        if not rest:
            yield []
        for end in range(1, len(rest) + 1):
            options = ([rest[:end]] if rest[:end] in pieces else []) + ([None] if end == 1 else [])
            yield from ([option, *more] for option in options for more in ways(rest[end:]))

    expected = dict.fromkeys(pieces, language_id.ADDED_COUNT)
    for word, count in zip(words, counts):
        cuts = list(ways("▁" + word))
        weights = [np.prod([1 / len(pieces) if piece else language_id.UNKNOWN_LETTER for piece in cut]) for cut in cuts]
        for cut, weight in zip(cuts, weights):
            for piece in filter(None, cut):
                expected[piece] += count * weight / sum(weights)
    wanted = np.array([expected[piece] for piece in pieces]) / sum(expected.values())
    matcher = language_id.Matcher(pieces)
    assert np.allclose(language_id.fit(words, counts, matcher, len(pieces), 1), wanted)
    short = language_id.fit(["ab" * 20], [1], matcher, len(pieces), 3)
    held, language_id.LONG_WORD = language_id.LONG_WORD, 3
    try:
        assert np.allclose(language_id.fit(words, counts, matcher, len(pieces), 1), wanted)
        assert np.allclose(language_id.fit(["ab" * 20], [1], matcher, len(pieces), 3), short)
    finally:
        language_id.LONG_WORD = held
