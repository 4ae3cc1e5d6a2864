"""Cases in which operators once did less than the whole job."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotflow.llm import html_text, language_id, outliers, pii, quality_pu, template_leaks, url_filter

STORY = "John has 5 apples and buys 7 more at the shop. John then gives 3 apples to a friend."


def leaked(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): (r.coverage, r.same_values) for r in template_leaks.leaks(docs, bench).collect()}


def test_names_that_open_a_sentence(spark):
    inside = "They tell how j" + STORY[1:]
    texts = [STORY, STORY.replace("John", "Mary"), inside, "They tell how Mary" + STORY[4:].replace("John", "Mary"), "The story has no apples at all."]
    got = leaked(spark, texts, [STORY])
    assert got == {(0, 0): (1.0, True), (1, 0): (1.0, False), (2, 0): (1.0, True), (3, 0): (1.0, False)}


LONG_ITEM = "Anna met the old baker near the mill and they spoke of bread for a while. Later that day the baker gave Anna two loaves and a small jar of honey to take home, because the road was long and it had begun to rain again."


def test_one_altered_value_leaves_the_other_windows(spark):
    torn = LONG_ITEM.replace("gave Anna", "gave Eva")
    got = leaked(spark, [torn, torn.replace("Anna", "Ida"), LONG_ITEM], [LONG_ITEM])
    assert set(got) == {(0, 0), (1, 0), (2, 0)}
    assert 0.8 <= got[0, 0][0] < 1 and not got[0, 0][1] and got[2, 0] == (1.0, True)


def test_items_without_ordinary_windows(spark):
    items = ["1 2 3 5 8 13 21", "Anna Berta Clara Dora Emma Frida", "what is love", "7 7"]
    texts = [f"So it goes: {item}, and then the rest of the text goes on." for item in items]
    other = ["1 2 3 5 8 14 21 and what love is", "Anna Berta Clara Dora Emma, Gerda", "7 8", ""]
    got = leaked(spark, texts + [" ".join(items)] + other, [*items, "", None])
    assert got == {(n, n): (1.0, True) for n in range(4)} | {(4, n): (1.0, True) for n in range(4)}


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("Ring +1 five five five 0 1 0 2 0 3 0 now", "PHONE"),
        ("+1 5 5 5 zero 1 zero 2 zero 3 zero", "PHONE"),
        ("+4 4 2 oh 7 9 4 6 oh 9 5 8", "PHONE"),
        ("tel plus 49 30 1234567 x", "PHONE"),
        ("juan [ arroba ] sitio.com", "EMAIL"),
        ("max [ @ ] seite.de", "EMAIL"),
        ("x@host [ punkt ] de", "EMAIL"),
        ("from 192 dot 168 dot 1 dot 10 today", "IP"),
        ("at 192.168 punkt 1.10", "IP"),
        ("a" * 70 + " at example dot com", "EMAIL"),
        ("a dot b dot c dot d dot e dot f dot g at h dot i dot j dot k dot l dot m dot n dot o dot com", "EMAIL"),
        ("+1 (five five five) zero one zero two zero three zero", "PHONE"),
        ("+1 (555) five five five - zero one two three", "PHONE"),
    ],
)
def test_disguises_with_few_signs(text, kind):
    assert f"<{kind}>" in pii.redacted(text)


def test_plain_speech_stays():
    for text in ("meet me at home, dot by dot", "1 dot 2 dot 3", "look at example.com for it", "in point 3 point 4 of the list", "(one) (two) (three) of them"):
        assert pii.redacted(text) == text


@pytest.mark.parametrize("text", ["a dot " * 60_000, "a." * 100_000, "1 dot " * 60_000 + "x", "a at " * 60_000, "one (" * 40_000, "a@" * 100_000, "(1) " * 60_000])
def test_long_chains_stay_linear(text):
    began = time.process_time()
    pii.all_spans(text)
    assert time.process_time() - began < 5


def test_repeated_ids_are_drawn_once(spark, monkeypatch):
    docs = [(n % 10 if n % 10 else None, f"text {n} " * (n % 7 + 1)) for n in range(200)] + [(3, None)] * 5
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(10)] * 3, "doc_id long, quality int")
    got = []
    monkeypatch.setattr(quality_pu, "train", lambda positive, unlabelled: got.append((len(positive), len(unlabelled))))
    quality_pu.learn(docs, labels)
    assert got == [(5, 9)]


def test_filter_grows_with_its_list(spark):
    assert url_filter.filter_blocks(0) == 1 and url_filter.filter_blocks(1_000_000) <= url_filter.BLOCKS_SENT
    listed = url_filter.places(spark, [], [f"site{n}.test/" for n in range(3000)])
    pages = spark.createDataFrame([(n, f"http://www.site{n}.test/x") for n in range(2990, 3010)], "page_id long, url string")
    got = {row.page_id: row.verdict for row in url_filter.judge_urls(pages, listed).collect()}
    assert got == {n: "block" if n < 3000 else "allow" for n in range(2990, 3010)}
    place = listed.select(F.concat("host", "path").alias("key"))
    bits = sum(bin(v & (2**64 - 1)).count("1") for row in url_filter.bloom_blocks(place, 750).collect() for v in row[1:])
    assert 0 < bits < 3000 * 8 <= 750 * 512 // 8 * 0.6


def test_no_step_of_the_estimate_moves_the_rows(spark):
    rows = spark.range(400).selectExpr("cast(id % 2 AS string) g_lang", "'' g_source", *[f"rand({n}) x{n}" for n in range(4)])
    estimates = outliers.robust_estimates(rows)
    plan = outliers._with_distance(rows, estimates)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan.split("BroadcastExchange")[0]


@pytest.mark.parametrize("spread", [0.0, 0.01])
def test_a_third_of_a_group_is_junk(spark, spread):
    draw = np.random.default_rng(5)
    good = draw.normal(0, (0.15, 0.1, 0.4, 0.3), (1200, 4))
    junk = np.array([3.0, 2.0, 4.0, 4.0]) + draw.normal(0, 1, (700, 4)) * spread
    rows = spark.createDataFrame([("en", "s", number < 1200, *map(float, x)) for number, x in enumerate([*good, *junk])], "g_lang string, g_source string, good boolean, x0 double, x1 double, x2 double, x3 double")
    got = outliers._with_distance(rows, outliers.robust_estimates(rows)).collect()
    assert sum(row.distance <= outliers.CUTOFF for row in got if row.good) >= 0.98 * 1200
    assert not any(row.distance <= outliers.CUTOFF for row in got if not row.good)


def test_pages_with_elements_left_open():
    cut = lambda page: [block.text for block in html_text.blocks_of(page)]
    assert cut('<p>a <svg class="i"/> b<p>c <math/> d') == ["a b", "c d"]
    assert cut("<p>a <svg><title>t</title><path d='x'/><text>no</text></svg> b") == ["a b"]
    assert cut("<p>a <svg><path> b<p>c") == ["a", "c"]
    assert cut("<div><datalist><option value=x><option value=y>no</datalist>a</div><p>b") == ["a", "b"]
    assert cut("<div><select><option>no<option>no</select> a</div><p>b <button>no</button> c") == ["a", "b c"]
    assert cut("<p>a <object><p>no</p></object> b</p>") == ["a b"]
    deep = html_text.blocks_of("<article>" + "<b>" * 600 + "a</article><p>b")
    assert [(block.text, block.leaf) for block in deep] == [("a", "article"), ("b", "p")]
    assert not deep[1].path[list(html_text._signature("article", "")[0])].any()


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 20)
    many = [(n, " ".join(f"the house of {a}{b}" for a in "abcd" for b in "efgh"), "en") for n in range(3000)]
    few = [(None, "das ist nicht unser haus", "de"), (None, "und wir sind nicht zu hause", "de")]
    single = [(n, "casa", f"x{n}") for n in range(600)]
    model = language_id.train(spark.createDataFrame(many + few + single, "doc_id long, text string, lang string"))
    assert len(model.languages) == 602
    spread = np.ptp(model.probability, axis=0)
    assert (spread > 0).all()
