"""Helpers that the text operators share: batches, word caches, word hashes, the folder for written tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.session import shared_dir

#: Entries of the younger half of a worker's word cache; a worker holds twice as many at most.
CACHE_ENTRIES = 300_000
#: Words longer than this are worked out anew each time, so that a cache is bounded in bytes too.
CACHED_LENGTH = 64

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


class WordCache(dict):
    """Word -> value, computed once; old words that are not met again make room for new ones."""

    def __init__(self, compute: Callable[[str], object], entries: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.entries, self.old = compute, entries, {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
            if len(word) > CACHED_LENGTH:
                return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int) -> Column:
    """Remainder of the CRC-32 of an id's text: the fold of a document (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared folder, so lost executors lose no finished work."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def word_hash(word: str) -> int:
    """Hash of a word in lower case without punctuation at its ends; 0 where nothing is left."""
    low = word.lower()
    bare = low if low.isalnum() else low[:-1] if low[:-1].isalnum() and low[-1] in ".,;:!?" else _EDGES.sub("", low)
    return xxhash.xxh64_intdigest(bare) | 1 if bare else 0


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` words, in text order; of all words if there are fewer, none if there is none."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    factors = mix(np.arange(1, width + 2, dtype=np.uint64)) | np.uint64(1)
    total = words[:count] * factors[0]
    for place in range(1, width):
        total += words[place : place + count] * factors[place]
    return mix(total + factors[width])


def shingles(text: str | None, hashes: WordCache, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word windows."""
    words = [hashes[word] for word in text.split()] if text else []
    values = np.array(words, dtype=np.uint64)
    return np.unique(window_hashes(values[values != 0], width))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[tuple]]:
    """Rows of each Arrow batch as tuples of the named columns."""
    for batch in batches:
        yield list(zip(*(batch.column(name).to_pylist() for name in names)))


def runs_of(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], values: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of a partition sorted by ``keys``, one at a time; a group may span batches."""
    current, held = None, []
    for batch in batches:
        key_rows = zip(*(batch.column(name).to_pylist() for name in keys))
        value_rows = zip(*(batch.column(name).to_pylist() for name in values))
        for key, row in zip(key_rows, value_rows):
            if key != current:
                if held:
                    yield current, held
                current, held = key, []
            held.append(row)
    if held:
        yield current, held


def sized(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``size`` rows at most."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch_of(held, schema)
            held = []
    if held:
        yield batch_of(held, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)
