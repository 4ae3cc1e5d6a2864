"""Finds benchmark items in documents, also with other numbers, names and units.

Every text is read as a template: numbers, names (capitalised words) and units (known words after a
number) become typed placeholders, other words stay in lower case. A capitalised word that opens a
sentence may be a name or not and has both readings: its windows stand there once in each, and a place
is covered by any of them. Windows of
``WIDTH`` template tokens of the benchmark are hash-joined with those of the documents. Within one
alignment of a document with an item the slots must be consistent: where one benchmark value has several
values in the document, the one at most places counts, and windows with another are left out. An item
leaks into a document if the windows that are left hold at least ``COVERAGE`` of the item's windows.

Windows with fewer than ``LITERALS`` ordinary words say nothing and are left out on both sides. An item
without any other window, or shorter than the width, is found as it is written (but for case and marks)
anywhere in a document: its whole run of tokens is one hash, joined at its own length; where it has five
tokens or more the documents hash only at places where its first five stand. A null and an empty text
match nothing. An item's window needs them in every
reading, if the item has such a window at all. An item shorter than the width
is also one template window and matches documents that are as short. Rows that share an id are one text to the
result; repeated rows change nothing. The document side of the join is thinned in the tasks by a
bitmap of fixed size over the benchmark's window hashes; what it lets through by chance, the join removes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.texts import WordCache, mix, rows_of, sized, window_hashes
from lotflow.shipping import ship

WIDTH, LITERALS, COVERAGE = 5, 2, 0.8
#: Bits of the bitmap (2 MiB); its 64-bit words that are not zero travel to the tasks, 262,144 at most.
BITMAP_BITS = 1 << 24

WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
_EDGES = re.compile(r"^[^\w$€£%+-]+|[^\w%]+$")
_NUMBER = re.compile(r"[+-]?[$€£]?[0-9][0-9.,:/]*(?:st|nd|rd|th|e[+-]?[0-9]+)?")
_GLUED = re.compile(r"([+-]?[$€£]?[0-9][0-9.,]*)([A-Za-zµ°%]{1,4})")
# Number words and units.
_NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_UNITS = frozenset(
    "% mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ton tons "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months "
    "year years k c f °c °f degrees degree percent w kw mw v volt volts a amp amps j kj cal kcal hz khz mhz ghz b kb mb gb tb "
    "dollar dollars euro euros cent cents usd eur mph kmh".split()
)
_CODES = {NUMBER: np.uint64(0xA24BAED4963EE407), NAME: np.uint64(0x9FB21C651E98DF25), UNIT: np.uint64(0xD6E8FEB86659FD93)}


# a chunk's code: its hash with the last five bits used for the kind of its token and for these
_ENDS, _NONE, _TWO, _FLAGS = 4, 8, 16, 31
_ALL = (1 << 64) - 1
_ONES = np.array([bin(bits).count("1") for bits in range(1 << WIDTH)])
_STOPS = frozenset(".!?:")


def chunk_code(chunk: str) -> int:
    """Hash of a chunk's token, its kind, and whether a sentence ends, no token stands or two stand there."""
    if chunk.isalpha():
        return _token(chunk, chunk.lower())
    last = chunk[-1]
    ends = _ENDS if last in _STOPS or last in "\"')]" and len(chunk) > 1 and chunk[-2] in _STOPS else 0
    if last in ".,!?:;" and chunk[:-1].isalpha():
        return _token(chunk, chunk[:-1].lower()) | ends
    bare = _EDGES.sub("", chunk)
    if not bare or not any(mark.isalnum() or mark == "%" for mark in bare):
        return _NONE | ends
    glued = _GLUED.fullmatch(bare)
    if glued and glued.group(2).lower() in _UNITS:
        return _TWO | ends
    if _NUMBER.fullmatch(bare):
        return _hash(bare.lower()) | NUMBER | ends
    return _token(bare, bare.lower()) | ends


def _token(written: str, low: str) -> int:
    if low in _NUMBER_WORDS:
        kind = NUMBER
    elif low in _UNITS:
        kind = UNIT
    elif written[0].isupper() and written[1:] == written[1:].lower():
        kind = NAME
    else:
        kind = WORD
    return _hash(low) | kind


def _two_codes(chunk: str, ends: int) -> list[int]:
    glued = _GLUED.fullmatch(_EDGES.sub("", chunk))
    return [_hash(glued.group(1)) | NUMBER, _hash(glued.group(2).lower()) | UNIT | ends]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) & ~_FLAGS


def template(text: str | None, codes: WordCache) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the template's tokens, their kinds, the hashes of what stood there, and which words may be names where a sentence opens."""
    chunks = text.split() if text else []
    coded = np.array([codes[chunk] for chunk in chunks], dtype=np.uint64)
    flags = coded.astype(np.int8) & _FLAGS
    if (flags & _TWO).any():
        each = [_two_codes(chunk, int(flag) & _ENDS) if flag & _TWO else [int(code)] for chunk, code, flag in zip(chunks, coded, flags)]
        coded = np.array([code for codes_of in each for code in codes_of], dtype=np.uint64)
        flags = coded.astype(np.int8) & _FLAGS
    ends, there = (flags & _ENDS) > 0, np.flatnonzero((flags & _NONE) == 0)
    value, kind = coded[there] & ~np.uint64(_FLAGS), flags[there] & 3
    # a sentence opens at the first token, and where one has ended since the token before
    ended = np.concatenate([[0], np.cumsum(ends)])
    opens = np.diff(ended[there], prepend=-1) > 0 if len(there) else np.zeros(0, dtype=bool)
    either = (kind == NAME) & opens  # any word is capitalised where a sentence begins
    kind[either] = WORD
    after_number = np.concatenate([[False], kind[:-1] == NUMBER]) if len(kind) else np.zeros(0, dtype=bool)
    kind[(kind == UNIT) & ~after_number] = WORD
    code = value.copy()
    for slot, sign in _CODES.items():
        code[kind == slot] = sign
    return code, kind, value, either


def template_windows(text: str | None, codes: WordCache) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and places of a text's windows with enough ordinary words, sentence openers among them, and the kinds and values of its tokens."""
    code, kind, value, _ = template(text, codes)
    hashes = window_hashes(code, WIDTH)
    if not len(hashes):
        return hashes, np.zeros(0, dtype=np.int64), kind, value
    width = min(WIDTH, len(code))
    words = np.concatenate([[0], np.cumsum(kind == WORD)])
    places = np.flatnonzero(words[width:] - words[:-width] >= min(LITERALS, width))
    return hashes[places], places, kind, value


_FACTORS = mix(np.arange(1, WIDTH + 2, dtype=np.uint64)) | np.uint64(1)  # as in window_hashes
Test = Callable[[np.ndarray], np.ndarray]


def readings(text: str | None, codes: WordCache, hit: Test | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, places and slots (a bit a token) of a text's windows in every reading of the sentence openers, and the tokens' values.

    Of a document only the windows whose hashes pass the test ``hit`` are given; without a test the text is an item.
    """
    code, kind, value, either = template(text, codes)
    if not len(code):
        return code, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), value
    width = min(WIDTH, len(code))
    count, least = len(code) - width + 1, min(LITERALS, width)
    total = code[:count] * _FACTORS[0]
    for place in range(1, width):
        total += code[place : place + count] * _FACTORS[place]
    word = kind == WORD
    summed = np.concatenate([[0], np.cumsum(word)])
    words = summed[width:] - summed[:-width]
    opening = np.flatnonzero(either)
    found = [(total, np.arange(count), np.zeros(count, dtype=np.int64))]
    if len(opening):
        # a window that holds one opener: the sum with a name's code in its place; ``named`` has a bit a token read so
        places = (opening[:, None] - np.arange(width)).ravel()
        named = np.tile(1 << np.arange(width), len(opening))
        change = ((_CODES[NAME] - code[opening])[:, None] * _FACTORS[:width]).ravel()
        inside = (places >= 0) & (places < count)
        places, named, change = places[inside], named[inside], change[inside]
        found.append((total[places] + change, places, named))
        openers = np.bincount(places, minlength=count)
        if openers.max(initial=0) > 1:
            held: dict[int, list[tuple[int, int]]] = {}
            for place, bit, by in zip(places.tolist(), named.tolist(), change.tolist()):
                if openers[place] > 1:
                    held.setdefault(place, []).append((bit, by))
            more = [(int(total[place]) + sum(by for _, by in chosen) & _ALL, place, sum(bit for bit, _ in chosen)) for place, marks in held.items() for size in range(2, len(marks) + 1) for chosen in combinations(marks, size)]
            sums, at, bits = zip(*more)
            found.append((np.array(sums, dtype=np.uint64), np.array(at), np.array(bits)))
    else:
        openers = np.zeros(count, dtype=np.int64)
    sums, places, named = (np.concatenate(part) for part in zip(*found)) if len(found) > 1 else found[0]
    hashes = mix(sums + _FACTORS[width])
    kept = words[places] - _ONES[named] >= least
    if hit is not None:
        kept &= hit(hashes)
    else:
        firm = words - openers >= least
        kept &= firm[places] if firm.any() else True
    hashes, places, named = hashes[kept], places[kept], named[kept]
    slots = named
    for offset in range(width):
        slots = slots | np.where(word[places + offset], 0, 1 << offset)
    return hashes, places, slots, value


class Runs:
    """Hashes of runs of tokens of any length, from sums over the text up to each place."""

    _STEP = 0x9E3779B97F4A7C15
    _STEPS = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def __init__(self, value: np.ndarray):
        if len(value) >= len(Runs._STEPS[0]):
            steps = np.ones((2, 2 * len(value) + 1), dtype=np.uint64)
            steps[:, 1:] = np.array([[Runs._STEP], [pow(Runs._STEP, -1, 1 << 64)]], dtype=np.uint64)
            Runs._STEPS = tuple(np.cumprod(steps, axis=1, dtype=np.uint64))
        self.size = len(value)
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(value) * Runs._STEPS[0][: len(value)], dtype=np.uint64)])

    def hashes(self, length: int, places: np.ndarray | None = None, sign: int = 1) -> np.ndarray:
        """Of the runs of a length at all places or at those given, which must leave room for it."""
        places = np.arange(self.size - length + 1) if places is None else places
        sums = (self.sums[places + length] - self.sums[places]) * Runs._STEPS[1][places]
        return mix(mix(sums + np.uint64(length)) + np.uint64(sign))

    def starts(self) -> np.ndarray:
        """Of the first tokens of long runs, apart from the hashes of whole runs as short."""
        return self.hashes(WIDTH, sign=2)


def literal_hits(value: np.ndarray, lengths: list[int], hit: Test) -> Iterator[tuple[int, int]]:
    """Hash and first place of each run of one of the lengths that passes the test."""
    runs, starts = Runs(value), None
    for length in lengths:
        if length > len(value):
            continue
        places = np.arange(len(value) - length + 1)
        if length >= WIDTH:
            starts = np.flatnonzero(hit(runs.starts())) if starts is None else starts
            places = starts[starts + length <= len(value)]
        hashes = runs.hashes(length, places)
        passed = hit(hashes)
        each, first = np.unique(hashes[passed], return_index=True)
        yield from zip(each.view(np.int64).tolist(), places[passed][first].tolist())


_WINDOW = "id long, hash long, place int, slots array<long>, filled int, length int, start long"
_WINDOW_ARROW = pa.schema(
    [("id", pa.int64()), ("hash", pa.int64()), ("place", pa.int32()), ("slots", pa.list_(pa.int64()))]
    + [("filled", pa.int32()), ("length", pa.int32()), ("start", pa.int64())]
)


def windows(table: DataFrame, id_col: str, text_col: str, bitmap: dict[int, int] | None = None, lengths: list[int] | None = None) -> DataFrame:
    """Rows of all windows of items, or of those of documents whose hash is in the bitmap.

    ``filled`` has a bit for each token that is a slot. Runs joined as they are written have none; an item's
    has its ``length`` and, if it is a long one, the hash of its first tokens, ``start``.
    """
    sent = table.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCache(chunk_code)
        bits = None
        if sent is not None:
            bits = np.zeros(BITMAP_BITS // 64, dtype=np.uint64)
            bits[list(sent.value)] = np.array([word & (1 << 64) - 1 for word in sent.value.values()], dtype=np.uint64)

        def hit(hashes: np.ndarray) -> np.ndarray:
            bit = hashes & np.uint64(BITMAP_BITS - 1)
            return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)

        def rows() -> Iterator[tuple]:
            for number, text in (row for rows in rows_of(batches, "id", "text") for row in rows):
                hashes, places, masks, value = readings(text, codes, None if bits is None else hit)
                values = value.view(np.int64)
                for hashed, place, mask in zip(hashes.view(np.int64).tolist(), places.tolist(), masks.tolist()):
                    yield number, hashed, place, [int(values[place + k]) for k in range(WIDTH) if mask >> k & 1], mask, None, None
                if bits is not None:
                    for hashed, place in literal_hits(value, lengths, hit) if lengths and len(value) else ():
                        yield number, hashed, place, [], 0, None, None
                elif len(value) and (len(value) < WIDTH or not len(hashes)):
                    runs = Runs(value)
                    start = int(runs.starts().view(np.int64)[0]) if len(value) >= WIDTH else None
                    yield number, int(runs.hashes(len(value)).view(np.int64)[0]), 0, [], 0, len(value), start

        yield from sized(rows(), _WINDOW_ARROW)

    ship(table.sparkSession)
    source = table.selectExpr(f"CAST(`{id_col}` AS LONG) AS id", f"`{text_col}` AS text")
    return source.mapInArrow(run, _WINDOW)


def window_bitmap(items: DataFrame) -> dict[int, int]:
    """Words of the bitmap over the windows' hashes that are not zero; bounded by the bitmap's size."""
    hashes = items.select(F.explode(F.array_compact(F.array("hash", "start"))).alias("hash"))
    bit = hashes.select(F.expr(f"hash & {BITMAP_BITS - 1}").alias("bit"))
    words = bit.groupBy(F.expr("CAST(bit >> 6 AS INT)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("bits"))
    return {row["word"]: row["bits"] for row in words.collect()}


def agreed(held: list[dict]) -> tuple[set[int], bool]:
    """Places of an alignment's windows that agree on what each value of the item became, and whether all values stayed.

    A value that became several is taken for the one at most places, of equal ones for itself, and else for the least.
    """
    became: dict[int, dict[int, set[int]]] = {}
    for window in held:
        spots = [window["place"] + k for k in range(WIDTH) if window["filled"] >> k & 1]
        for at, item, doc in zip(spots, window["item"], window["doc"]):
            became.setdefault(item, {}).setdefault(doc, set()).add(at)
    chosen = {item: max(by, key=lambda doc: (len(by[doc]), doc == item, -doc)) for item, by in became.items()}  # noqa: B023
    places = {window["place"] for window in held if all(chosen[item] == doc for item, doc in zip(window["item"], window["doc"]))}
    return places, all(set(by) == {item} for item, by in became.items())


def covered_places(aligned: DataFrame, id_col: str, item_col: str) -> DataFrame:
    """Rows (id, item id, place, same) of alignments with their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for begin in range(0, batch.num_rows, 128):
                    for number, item, held in next(rows_of([batch.slice(begin, 128)], id_col, item_col, "windows")):
                        places, same = agreed(held)
                        for place in sorted(places):
                            yield number, item, place, same

        yield from sized(rows(), pa.schema([(id_col, pa.int64()), (item_col, pa.int64()), ("place", pa.int32()), ("same", pa.bool_())]))

    ship(aligned.sparkSession)
    return aligned.mapInArrow(run, f"`{id_col}` long, `{item_col}` long, place int, same boolean")


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (id, item id, coverage, same_values): items found in documents; ``same_values`` where no slot was changed."""
    items = windows(benchmark, item_col, item_text)
    lengths = sorted(row["length"] for row in items.select("length").where("length IS NOT NULL").distinct().collect())
    hits = windows(docs, id_col, text_col, window_bitmap(items), lengths).select(F.col("id").alias(id_col), "hash", "place", "slots")
    sizes = items.groupBy(F.col("id").alias(item_col)).agg(F.countDistinct("place").alias("n_windows"))
    of_items = items.select(F.col("id").alias(item_col), "hash", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "filled").distinct()
    met = hits.join(of_items, "hash").withColumn("shift", F.col("place") - F.col("item_place"))
    # an alignment has the readings of one window per place of the item, so what is gathered here is bounded by an item
    window = F.struct(F.col("item_place").alias("place"), "filled", F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    aligned = met.groupBy(id_col, item_col, "shift").agg(F.collect_set(window).alias("windows"))
    covered = covered_places(aligned.select(id_col, item_col, "windows"), id_col, item_col)
    found = covered.groupBy(id_col, item_col).agg(F.countDistinct("place").alias("n"), F.bool_and("same").alias("same_values"))
    share = F.col("n") / F.col("n_windows")
    return found.join(sizes, item_col).where(share >= coverage).select(id_col, item_col, share.alias("coverage"), "same_values")


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents into which no item leaks, with all their columns; each row is judged by its own text, whatever its id."""
    key = F.xxhash64("doc_id", "text")
    found = leaks(docs.withColumn("__row", key), benchmark, coverage, id_col="__row").select(F.col("__row").alias("__leak")).distinct()
    return docs.join(found, key == found["__leak"], "left_anti")
