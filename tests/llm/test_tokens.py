"""Prefix BPE and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import empty_docs, hard_docs, hard_rows
from lotflow.llm import bpe_codec, token_files
from lotflow.llm.texts import table
from lotflow.llm.word_bpe import prefix_encoder
from lotflow.session import shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_prefix_encoder_equals_library(library):
    draw = random.Random(5)
    texts = ["".join(draw.choice("aeinrstlohdcum'!.,-01 ÀéßΣжñ<|>") for _ in range(40)) for _ in range(2000)]
    texts += ["a<|endoftext|>b", "<|EndOfText|>", "½a²", "it's'T", "a ́", "_a_", "١٢", "hahaha" * 300, "aaaa" * 500, "İx"]
    encoder = prefix_encoder(PATH)
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == expected, text
        assert encoder.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_every_code_point(library):
    """Letters of any release of Unicode are cut and lowered as the library does."""
    encoder = prefix_encoder(PATH)
    texts = [f"x{chr(code)}y {chr(code)}á" for code in range(0xE01F0) if not 0xD800 <= code < 0xE000 and not 0x34000 <= code < 0xE0000]
    for at in range(0, len(texts), 5000):
        coded = library.encode_batch(texts[at : at + 5000], add_special_tokens=False)
        assert [text for text, found in zip(texts[at : at + 5000], coded) if encoder.encode(text) != found.ids] == []


def test_repeated_ids_follow_each_other_by_text(spark):
    rows = [(7, f"text {n}") for n in range(50)] + [(3, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first, again = (sorted(map(tuple, token_files.token_documents(docs.repartition(n)).collect())) for n in (2, 5))
    assert first == again and len(first) == 51 and first[0][:2] == (3, 0)


def test_op7_table(spark, sf_dir, library):
    import __spark_entry__ as contract

    texts = {row.doc_id: row.text for row in table(spark, sf_dir, "documents").collect()}
    for row in contract.queries()["op7_bpe_prefixes"](spark, sf_dir).collect():
        ids = library.encode(texts.pop(row.doc_id) or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not texts


def test_hard_rows(spark, library):
    got = sorted(bpe_codec.bpe_digests(hard_docs(spark)).collect(), key=str)
    assert len(got) == len(hard_rows())
    counts = {row.doc_id: row.n_tokens for row in got}
    for number, text, *_ in hard_rows():
        assert counts[number] == len(library.encode(text or "", add_special_tokens=False).ids)
    assert bpe_codec.bpe_digests(empty_docs(spark)).collect() == []
    ids = {row.doc_id: (row.ids, row.decoded) for row in bpe_codec.bpe_ids(hard_docs(spark)).collect()}
    assert ids[0] == ([], "") and ids[3][0] == library.encode("one", add_special_tokens=False).ids


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], list(range(0, 5000, 3)), [0] * 700 + [10**9], np.cumsum(np.arange(2000) % 17).tolist()])
def test_elias_fano(values):
    coded = token_files.EliasFano.of(np.array(values, dtype=np.int64))
    read = token_files.EliasFano(coded.count, coded.low_bits, coded.low, coded.high, coded.samples.tobytes())
    step = token_files.SELECT_STEP
    assert [value for at in range(0, read.count, step) for value in read.run(at).tolist()] == values
    assert [read[n] for n in range(len(values))] == values
    if len(values) > 1000:
        bits = 8 * (len(coded.low) + len(coded.high))
        assert bits <= len(values) * (2 + np.log2(values[-1] / len(values) + 1) + 1) + 64


def test_op9_table(spark, sf_dir, library, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_DOCS", 7)
    docs = sorted(table(spark, sf_dir, "documents").collect(), key=lambda row: row.doc_id)
    got = {row.doc_id: row for row in token_files.token_documents(table(spark, sf_dir, "documents")).collect()}
    start = 0
    for row in docs:
        ids = np.array([*library.encode(row.text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        mine = got.pop(row.doc_id)
        assert (mine.start, mine.n_tokens, mine.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_token_files_hard_rows(spark):
    target = shared_dir(spark, "hard-tokens")
    token_files.write_tokens(hard_docs(spark), target)
    rows = sorted(token_files.read_documents(spark, target).collect(), key=lambda row: row.start)
    assert len(rows) == len(hard_rows()) and rows[0].doc_id is None and rows[0].start == 0
    assert [row.doc_id for row in rows[1:]] == sorted(row[0] for row in hard_rows() if row[0] is not None)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert token_files.token_documents(empty_docs(spark)).collect() == []
