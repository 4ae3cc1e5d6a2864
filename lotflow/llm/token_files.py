"""Token ids in files: one concatenated array per block, with Elias-Fano coded document boundaries.

Format (a Parquet table, so that Spark's commit protocol covers it): a row is a block of
neighbouring documents in ascending id order, with

* ``part``, ``block``: place of the block; ``first``: ids of the part before it; ``n_docs``, ``n_ids``;
* ``doc_ids``: the documents' ids as little-endian signed 64-bit integers, ``null_ids`` how many lead as null;
* ``ids``: all token ids of the block, ``width`` bytes each, little-endian, unsigned;
* ``low_bits``, ``low``, ``high``, ``samples``: the Elias-Fano sequence of the documents' ends.

Null and empty texts hold the end id alone. Rows with equal ids follow each other by the hash of their text;
a null id sorts first. An empty table gives an empty file and an empty result.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.llm.bpe_codec import default_path
from lotflow.llm.texts import WordCache, batch_of, rows_of, sized
from lotflow.llm.word_bpe import SPECIALS, byte_symbols, text_words
from lotflow.session import shared_dir
from lotflow.shipping import ship

#: A block ends with the document that reaches either bound.
BLOCK_DOCS, BLOCK_IDS = 2048, 1 << 20
#: One-bits of the high half between two samples of the select structure.
SELECT_STEP = 256


class EliasFano:
    """A non-decreasing sequence in about ``2 + log2(last / count)`` bits an entry, with constant-time access."""

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.low_bits = count, low_bits
        self.low, self.high, self.samples = low, high, np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """``values``: non-decreasing, not negative."""
        values = values.astype(np.uint64)
        count = len(values)
        last = int(values[-1]) if count else 0
        low_bits = max(0, (last // max(count, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        bits = np.zeros((last >> low_bits) + count + 1, dtype=np.uint8)
        bits[ones] = 1
        return cls(count, low_bits, low.tobytes(), np.packbits(bits, bitorder="little").tobytes(), ones[::SELECT_STEP].astype("<u4").tobytes())

    def __getitem__(self, index: int) -> int:
        """Entry ``index``, from the run of its sample."""
        if not 0 <= index < self.count:
            raise IndexError(index)
        return int(self.run(index // SELECT_STEP * SELECT_STEP)[index % SELECT_STEP])

    def run(self, begin: int) -> np.ndarray:
        """Entries from ``begin`` (a multiple of the select step) up to the next sample; only the bits between the two are read."""
        count = min(SELECT_STEP, self.count - begin)
        sample = begin // SELECT_STEP
        first = int(self.samples[sample])
        until = int(self.samples[sample + 1]) if sample + 1 < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8)[first // 8 : (until + 7) // 8], bitorder="little")
        ones = np.flatnonzero(bits[first % 8 :])[:count]
        high = (ones + first - np.arange(begin, begin + count)).astype(np.int64)
        if not self.low_bits:
            return high
        start, end = begin * self.low_bits, (begin + count) * self.low_bits
        low = np.unpackbits(np.frombuffer(self.low, np.uint8)[start // 8 : (end + 7) // 8], bitorder="little")
        low = low[start % 8 :][: count * self.low_bits].reshape(count, self.low_bits)
        return high << self.low_bits | low.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))


@lru_cache(maxsize=2)
def _library(path: str) -> tuple[WordCache, str]:
    """Word -> ids as bytes, by the tokenizers library, and the ids' type."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    kind, model, symbols = "<u2" if whole.get_vocab_size() <= 1 << 16 else "<u4", whole.model, byte_symbols()
    code = "H" if kind == "<u2" else "I"

    def encode(word: str) -> bytes:
        if word in SPECIALS:
            ids = [whole.token_to_id(word)]
        else:
            if not (word.isascii() and word.isprintable()):  # what prints in ASCII stands for its own byte
                word = "".join([symbols[byte] for byte in word.encode("utf-8", "surrogatepass")])
            ids = [token.id for token in model.tokenize(word)]
        coded = array(code, ids)
        if sys.byteorder == "big":
            coded.byteswap()
        return coded.tobytes()

    return WordCache(encode), kind


_BLOCK = "part int, block int, first long, n_docs int, n_ids long, null_ids int, doc_ids binary, width int, ids binary, low_bits int, low binary, high binary, samples binary"
_BLOCK_ARROW = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("null_ids", pa.int32())]
    + [("doc_ids", pa.binary()), ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32())]
    + [(name, pa.binary()) for name in ("low", "high", "samples")]
)


def write_tokens(docs: DataFrame, target: str, path: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` to each, and write the blocks in ascending id order to ``target``."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, kind = _library(path)
        end = np.array([end_id], dtype=kind).tobytes()
        width, part = len(end), TaskContext.get().partitionId()

        def blocks() -> Iterator[tuple]:
            block, first, numbers, pieces, sizes = 0, 0, [], [], []

            def closed() -> tuple:
                ends = np.cumsum(np.array(sizes, dtype=np.int64))
                coded = EliasFano.of(ends)
                nulls = sum(number is None for number in numbers)
                known = np.array([number for number in numbers if number is not None], dtype="<i8")
                return (
                    part, block, first, len(numbers), int(ends[-1]), nulls, known.tobytes(), width, b"".join(pieces),
                    coded.low_bits, coded.low, coded.high, coded.samples.tobytes(),
                )

            held = 0
            for number, text in (row for rows in rows_of(batches, "id", "text") for row in rows):
                coded = b"".join([codes[word] for word in text_words(text)]) + end
                numbers.append(number)
                pieces.append(coded)
                sizes.append(len(coded) // width)
                held += sizes[-1]
                if len(numbers) >= BLOCK_DOCS or held >= BLOCK_IDS:
                    yield closed()
                    block, first, numbers, pieces, sizes, held = block + 1, first + held, [], [], [], 0
            if numbers:
                yield closed()

        yield from sized(blocks(), _BLOCK_ARROW, 4)

    ship(docs.sparkSession)
    rows = docs.selectExpr(f"CAST(`{id_col}` AS LONG) AS id", f"`{text_col}` AS text", f"xxhash64(`{text_col}`) AS tie")
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    ordered.select("id", "text").mapInArrow(run, _BLOCK).write.option("compression", "zstd").parquet(target)


def read_documents(spark: SparkSession, target: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (of 32-bit ids), from the boundaries and ids read back."""
    blocks = spark.read.schema(_BLOCK).parquet(target)
    # a row for each written part, as many as the writing shuffle had partitions
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids")).orderBy("part").collect()
    bases, total = {}, 0
    for row in sizes:
        bases[row["part"]], total = total, total + row["ids"]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ends = EliasFano(block["n_docs"], block["low_bits"], block["low"], block["high"], block["samples"])
                ids = np.frombuffer(block["ids"], dtype=f"<u{block['width']}").astype("<u4")
                numbers = [None] * block["null_ids"] + np.frombuffer(block["doc_ids"], "<i8").tolist()
                base, start = bases[block["part"]] + block["first"], 0
                for begin in range(0, ends.count, SELECT_STEP):
                    out = []
                    for number, end in zip(numbers[begin : begin + SELECT_STEP], ends.run(begin).tolist()):
                        out.append((number, base + start, end - start, zlib.crc32(ids[start:end])))
                        start = end
                    yield batch_of(out, schema)

    ship(spark)
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files to a fresh folder of the shared ones and read them back."""
    target = shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, target, path)
    return read_documents(docs.sparkSession, target)
