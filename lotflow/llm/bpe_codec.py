"""BPE encoding and decoding of whole texts, as digests or as ids.

Null and empty texts have no ids and decode to the empty text. Every row gives one row, repeated
rows give equal rows, and columns other than the id and the text are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lotflow.llm.texts import WordCache, batch_of, rows_of
from lotflow.llm.word_bpe import prefix_encoder, text_words
from lotflow.shipping import ship


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def _word_codes(path: str) -> WordCache:
    """Word -> (ids as text, tokens as text); both are joined by single blanks."""
    encoder = prefix_encoder(path)

    def code(word: str) -> tuple[str, str]:
        ids = encoder.encode_word(word)
        return " ".join(map(str, ids)), encoder.decode(ids)

    return WordCache(code)


def bpe_digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, SHA-256 of the ids' text and of the decoded text."""
    path, name = path or default_path(), id_col
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _word_codes(path)
        schema = None
        for batch in batches:
            schema = schema or pa.schema([(name, batch.column(0).type), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
            out = []
            for rows in rows_of([batch], "__id", "__text"):
                for number, text in rows:
                    parts = [codes[word] for word in text_words(text)]
                    ids = " ".join([part[0] for part in parts])
                    decoded = " ".join([part[1] for part in parts])
                    n_tokens = ids.count(" ") + 1 if ids else 0
                    out.append((number, n_tokens, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            yield batch_of(out, schema)

    ship(docs.sparkSession)
    rows = docs.selectExpr(f"`{id_col}` AS __id", f"`{text_col}` AS __text")
    return rows.mapInArrow(run, f"`{name}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_ids(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the ids themselves and the decoded text."""
    path, name = path or default_path(), id_col
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = prefix_encoder(path)
        for batch in batches:
            schema = pa.schema([(name, batch.column(0).type), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
            for rows in rows_of([batch], "__id", "__text"):
                coded = [(number, encoder.encode(text)) for number, text in rows]
                yield batch_of([(number, ids, encoder.decode(ids)) for number, ids in coded], schema)

    ship(docs.sparkSession)
    rows = docs.selectExpr(f"`{id_col}` AS __id", f"`{text_col}` AS __text")
    return rows.mapInArrow(run, f"`{name}` {kind}, ids array<int>, decoded string")
