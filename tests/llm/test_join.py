"""The chosen-path join against all pairs, and the pipeline as a whole."""

import random

import pytest

import corpus_pipeline
from cases import empty_docs, hard_docs, hard_rows
from lotflow.llm import chosen_path, template_leaks
from lotflow.llm.texts import WordCache, shingles, table, word_hash


def all_pairs(rows, threshold=0.8):
    hashes = WordCache(word_hash)
    sets = [(number, set(shingles(text, hashes, 5).tolist())) for number, text in rows]
    top = {number: number for number, _ in rows}
    links = [0] * len(sets)

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, (one, x) in enumerate(sets):
        for b in range(a):
            two, y = sets[b]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-9:
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(one), find(two)))
                top[q] = p
    return sorted((number, find(number), n) for (number, _), n in zip(sets, links))


def got(docs):
    return sorted(tuple(row) for row in chosen_path.similarity_classes(docs).collect() if row.doc_id is not None)


def near_copies():
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(draw.choice([3, 8, 60, 200]))]
        for _ in range(draw.choice([1, 2, 5, 12])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 3])):
                copy[draw.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    line = " ".join(word() for _ in range(12))
    return texts + [f"{line}\n" + " ".join(word() for _ in range(50)) for _ in range(30)] + ["short", "Short.", "two words"]


@pytest.mark.parametrize("small", [False, True])
def test_against_all_pairs(spark, monkeypatch, small):
    if small:  # every bucket and group is cut into blocks
        monkeypatch.setattr(chosen_path, "BUCKET", 3)
        monkeypatch.setattr(chosen_path, "BLOCK_SETS", 3)
    rows = list(enumerate(near_copies()))
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == all_pairs(rows)


def test_hard_rows(spark):
    rows = [row[:2] for row in hard_rows() if row[0] is not None]
    assert got(hard_docs(spark)) == all_pairs(rows)
    classes = chosen_path.similarity_classes(hard_docs(spark))
    assert classes.count() == len(hard_rows()) and classes.where("doc_id IS NULL").collect()[0].n_links == 0
    assert chosen_path.similarity_classes(empty_docs(spark)).count() == 0
    kept = chosen_path.one_of_each(hard_docs(spark))
    assert kept.columns == hard_docs(spark).columns and kept.count() == len(hard_rows()) - 2


def test_components(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, 50), (50, 75), (200, 200)]
    found = {row.node: row.label for row in chosen_path.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{n: 0 for n in range(41)}, 100: 50, 50: 50, 75: 50}


def test_runs():
    assert chosen_path.runs_needed(0.998, 2) == 10 and chosen_path.runs_needed(0.5, 1) == 1


def test_stages(spark, sf_dir):
    """Each stage on hard rows: whole columns, defined results, no crash on an empty table."""
    for docs in (hard_docs(spark, ["call me@x.org today"]), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            rows = out.count()
            assert rows <= docs.count()
            if name != "encode":
                assert out.columns == docs.columns


def test_pipeline_result(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    docs = [(row.doc_id, row.text) for row in table(spark, sf_dir, "documents").collect()]
    firsts = {number for number, label, _ in all_pairs(docs) if number == label}
    kept = {row.doc_id for row in rows}
    assert len(kept) == len(rows) and kept <= firsts
    leaked = {row.doc_id for row in __import__("lotflow.llm.catalogue", fromlist=["op1_template_leaks"]).op1_template_leaks(spark, sf_dir).collect()}
    assert firsts - leaked == kept


STORY = " ".join(f"word{n}" for n in range(40))


def test_rows_are_kept_and_dropped_by_their_own_text(spark):
    """Null and repeated ids lose no text and hide none."""
    other = " ".join(f"other{n}" for n in range(40))
    rows = [(7, STORY), (7, other), (8, other + " end"), (None, STORY + " end"), (None, "a third text of its own"), (None, None), (9, "")]
    docs = spark.createDataFrame([(*row, "c") for row in rows], "doc_id long, text string, class_id string")
    kept = {(row.doc_id, row.text) for row in chosen_path.one_of_each(docs).collect()}
    assert kept == {(7, STORY), (7, other), (None, "a third text of its own"), (None, None), (9, "")}

    items = spark.createDataFrame([(1, STORY)], "item_id long, text string")
    clean = {(row.doc_id, row.text) for row in template_leaks.without_leaks(docs, items).collect()}
    assert clean == {(7, other), (8, other + " end"), (None, "a third text of its own"), (None, None), (9, "")}


def test_language_stage_judges_each_row(spark, sf_dir):
    good = table(spark, sf_dir, "documents").where("lang IS NOT NULL").limit(60).collect()
    rows = [(row.doc_id, row.text, row.lang) for row in good] + [(None, "½ ² ①", None), (None, good[0].text, None), (good[0].doc_id, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = [(row.doc_id, row.text) for row in corpus_pipeline.keep_known_languages(spark, docs, sf_dir).collect()]
    assert set(kept) == {(row.doc_id, row.text) for row in good} | {(None, good[0].text)} and len(kept) == 61
