"""Personal data in texts, also where it is disguised, with places in the source text.

The base detectors find emails, addresses (ip), card numbers and phone numbers as written. Then a
chain of transducers rewrites look-alike letters, spelled digits and disguised at and dot signs; each
output character remembers which source characters it stands for. The same detectors run on the
rewritten text, and what they find there is mapped back and added unless a base span of its kind holds it.

A null text counts as empty and has no spans. Places are code points, ends exclusive. Each row gives
one row; other columns are left aside (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.texts import batch_of, rows_of
from lotflow.shipping import ship

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# no match starts inside a run of digits whose start does not match: the guard keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _is_ip(part: str) -> bool:
    return all(len(bare := number.lstrip("0")) <= 3 and int(bare or 0) <= 255 for number in part.split("."))


def _is_card(part: str) -> bool:
    digits = [int(digit) for digit in part if digit.isdigit()]
    if not 14 <= len(digits) <= 19:
        return False
    doubled = [digit * 2 - 9 * (digit > 4) for digit in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def _is_phone(part: str) -> bool:
    return 10 <= sum(mark.isdigit() for mark in part) <= 15


def detect(text: str) -> list[Span]:
    """Spans (begin, end, kind), each kind leftmost without overlap, by begin and then in the order of ``KINDS``."""
    spans = [(begin, end, "email") for begin, end in _emails(text)]
    spans += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if _is_ip(m.group())]
    spans += [(m.start(), m.end(), "card") for m in _CARD.finditer(text) if m.end() - m.start() >= 14 and _is_card(m.group())]
    spans += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if _is_phone(m.group())] if "+" in text else []
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2]), span[1]))


# Letters of other scripts that look like Latin ones, and what they look like.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a",
    "․": ".", "。": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹫": "@",
}
# Digits in words, by language.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_INVISIBLE = frozenset("­​‌‍⁠﻿")
_AT_WORDS, _DOT_WORDS = "at|arroba|arobase|ät", "dot|punkt|punto|point"
#: So many digits in a row, some of them in words, are read as a number.
SPELLED_RUN = 7

_ODD_LETTER = re.compile("[­·ıɐ-\U0010ffff]")
_DIGIT = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_SPELLED = re.compile(rf"(?<!\w)(?:plus[ -]+)?(?:(?:{_DIGIT}|[0-9])(?:[ ,.()-]++|(?<=[0-9])(?=[0-9]))){{{SPELLED_RUN - 1},}}(?:{_DIGIT}|[0-9])(?!\w)", re.I)
_DIGIT_PART = re.compile(rf"plus|{_DIGIT}|[0-9]", re.I)
_FENCED = re.compile(rf"\s?[\[({{<]\s?(?:({_AT_WORDS}|@)|({_DOT_WORDS}|\.))\s?[\])}}>]\s?", re.I)
_NAME = r"[A-Za-z0-9_%+-]"
_DOT = rf"(?: (?:{_DOT_WORDS}) |\.)"


def _not_after(part: str) -> str:
    """No start behind ``part`` and a dot: what fails at the head of a chain fails at its links, so long chains stay linear."""
    return rf"(?<!{part})(?<!{part}\.)" + "".join(f"(?<!{part} {word} )" for word in _DOT_WORDS.split("|"))


# names and chains of any length; possessive, as a name never ends where its dot or at could begin
_SPOKEN = re.compile(rf"{_not_after(_NAME)}{_NAME}++(?:{_DOT}{_NAME}++)*+(?: (?:{_AT_WORDS}) |@){_NAME}++(?:{_DOT}{_NAME}++)++", re.I)
_SPOKEN_IP = re.compile(rf"(?<!\w){_not_after('[0-9]')}[0-9]++(?:{_DOT}[0-9]++){{3,}}+", re.I)
_SPOKEN_PART = re.compile(rf" (?:({_AT_WORDS})|({_DOT_WORDS})) ", re.I)
_SPOKEN_DOTS = tuple(f" {word} " for word in _DOT_WORDS.split("|"))
# a spelled run holds one of these: words that hold a shorter one ("uno", "un") need no search of their own
_SPELLED_SIGNS = tuple(word for word in ("plus", *_DIGIT_WORDS) if not any(other != word and other in word for other in _DIGIT_WORDS))



class Tape:
    """A text whose characters each stand for a span of the source."""

    def __init__(self, text: str, begins: list[int] | range, ends: list[int] | range):
        self.text, self.begins, self.ends = text, begins, ends

    @classmethod
    def of(cls, text: str) -> Tape:
        return cls(text, range(len(text)), range(1, len(text) + 1))

    def replaced(self, edits: Iterator[tuple[int, int, str]]) -> Tape:
        """With parts of the text (begin, end, new text; in order, without overlap) rewritten."""
        text, begins, ends, done = [], [], [], 0
        for begin, end, new in edits:
            text.append(self.text[done:begin])
            begins.extend(self.begins[done:begin])
            ends.extend(self.ends[done:begin])
            text.append(new)
            begins.extend([self.begins[begin]] * len(new))
            ends.extend([self.ends[end - 1]] * len(new))
            done = end
        if not done and not text:
            return self
        text.append(self.text[done:])
        begins.extend(self.begins[done:])
        ends.extend(self.ends[done:])
        return Tape("".join(text), begins, ends)


@lru_cache(maxsize=4096)
def _plain(letter: str) -> str:
    if letter in _LOOKALIKES:
        return _LOOKALIKES[letter]
    if letter in _INVISIBLE:
        return ""
    digit = unicodedata.digit(letter, None)
    if digit is not None:
        return str(digit)
    wide = unicodedata.normalize("NFKC", letter)
    return wide if len(wide) == 1 and "!" <= wide <= "~" else letter


def _letters(tape: Tape) -> Tape:
    found = ((m.start(), m.end(), _plain(m.group())) for m in _ODD_LETTER.finditer(tape.text))
    return tape.replaced(edit for edit in found if edit[2] != tape.text[edit[0]])


def _digits(tape: Tape) -> Tape:
    def edits() -> Iterator[tuple[int, int, str]]:
        for run in _SPELLED.finditer(tape.text):
            parts = list(_DIGIT_PART.finditer(run.group()))
            if not any(len(part.group()) > 1 for part in parts):
                continue  # digits only: left to the detectors as they stand
            for number, part in enumerate(parts):
                begin = run.start() + part.start()
                following = run.start() + parts[number + 1].start() if number + 1 < len(parts) else run.start() + part.end()
                word = part.group().lower()
                new = "+" if word == "plus" else _DIGIT_WORDS.get(word, word)
                # the digit stands for its word; what parts it from the next one goes
                yield begin, run.start() + part.end(), new
                if following > run.start() + part.end():
                    yield run.start() + part.end(), following, ""

    return tape.replaced(edits())


def _fences(tape: Tape) -> Tape:
    return tape.replaced((m.start(), m.end(), "@" if m.group(1) else ".") for m in _FENCED.finditer(tape.text))


def _spoken_ip(tape: Tape) -> Tape:
    parts = ((m.start(), part) for m in _SPOKEN_IP.finditer(tape.text) for part in _SPOKEN_PART.finditer(m.group()))
    return tape.replaced((begin + part.start(), begin + part.end(), ".") for begin, part in parts)


def _spoken(tape: Tape) -> Tape:
    def edits() -> Iterator[tuple[int, int, str]]:
        for m in _SPOKEN.finditer(tape.text):
            if not any(part.group(2) for part in _SPOKEN_PART.finditer(m.group())):
                continue  # "at" before a host with written dots is plain speech
            for part in _SPOKEN_PART.finditer(m.group()):
                yield m.start() + part.start(), m.start() + part.end(), "@" if part.group(1) else "."

    return tape.replaced(edits())


def undisguised(text: str) -> Tape | None:
    """The rewritten text, or None where nothing in it can be a disguise."""
    low = text.lower()
    odd = not text.isascii() and _ODD_LETTER.search(text) is not None
    tape = Tape.of(text)
    if odd:
        tape = _letters(tape)
        low = tape.text.lower()
    if any(word in low for word in _SPELLED_SIGNS):
        tape = _digits(tape)
    if any(fence in tape.text for fence in "[({<"):
        tape = _fences(tape)
    if any(word in low for word in _SPOKEN_DOTS):
        tape = _spoken(_spoken_ip(tape))
    return None if tape.text == text else tape


def all_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those that the rewritten text adds."""
    if not text:
        return [], []
    base = detect(text)
    tape = undisguised(text)
    if tape is None:
        return base, base
    taken: dict[str, list[Span]] = {}
    for span in base:
        taken.setdefault(span[2], []).append(span)
    added = []
    for begin, end, kind in detect(tape.text):
        span = (tape.begins[begin], tape.ends[end - 1], kind)
        if not any(other[0] <= span[0] and span[1] <= other[1] for other in taken.get(kind, ())):
            added.append(span)
    return base, in_order(base + added)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for begin, end, kind in spans)


def redacted(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; spans that touch each other's inside go as one."""
    _, spans = all_spans(text)
    if not spans:
        return text
    parts, done, reach = [], 0, -1
    for begin, end, kind in spans:
        if begin >= reach:
            parts += [text[done:begin], f"<{kind.upper()}>"]
        reach = max(reach, end)
        done = reach
    return "".join(parts) + text[done:]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts of base spans by kind, SHA-256 of the base spans, all spans."""
    name, kind = id_col, docs.schema[id_col].dataType.simpleString()
    counts = [f"n_{kind}" for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([(name, batch.column(0).type), *[(count, pa.int64()) for count in counts], ("base_sha256", pa.string()), ("spans", pa.string())])
            out = []
            for rows in rows_of([batch], "__id", "__text"):
                for number, text in rows:
                    base, spans = all_spans(text)
                    kinds = [span[2] for span in base]
                    out.append((number, *map(kinds.count, KINDS), hashlib.sha256(spans_text(base).encode()).hexdigest(), spans_text(spans)))
            yield batch_of(out, schema)

    ship(docs.sparkSession)
    rows = docs.selectExpr(f"`{id_col}` AS __id", f"`{text_col}` AS __text")
    return rows.mapInArrow(run, f"`{name}` {kind}, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, with the personal data in the text replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            texts = [redacted(text) for text in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def with_length(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The length column brought up to date, if there is one."""
    return docs.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col in docs.columns else docs
