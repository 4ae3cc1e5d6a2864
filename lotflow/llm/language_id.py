"""Language of a text from unigram probabilities of vocabulary pieces, summed over all segmentations.

The vocabulary is a fixed public one. For each language every piece has a probability, learned by
expectation maximisation on word counts of labelled documents; the probability of a word is the sum
over all ways to cut it into pieces (forward algorithm), and a text is scored by its words' product
and the languages' shares.

Null texts and texts without a letter are ``und`` with score 0; signs that only count (as in ``½`` or ``①``)
are no letters. Rows come out one for one, repeated rows alike; other columns are left aside or, in
``with_language``, kept as they are. Ties go to the language that sorts first. Without any labelled document every text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotflow.llm.texts import mix
from lotflow.shipping import ship

UNDETERMINED = "und"
#: Bound of the training sample: labelled documents of a language whose words are counted.
SAMPLE_DOCS = 1000
ROUNDS, ADDED_COUNT, UNKNOWN_LETTER = 4, 0.05, 1e-7
_WORDS = re.compile(r"[^\W\d_]+")
#: Longer words are scored with logarithms, so that no product underflows.
LONG_WORD = 40
#: Texts scored at a time, bytes of the scores of words that a worker keeps, and words scored at a time.
SLICE, KEPT_BYTES, WORDS_AT_ONCE = 256, 1 << 22, 8192
_MARK = "▁"


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of the public vocabulary that may occur in lower-case words."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = (model.id_to_piece(number) for number in range(model.get_piece_size()) if not (model.is_control(number) or model.is_unknown(number) or model.is_byte(number)))
    return sorted({piece for piece in pieces if piece == piece.lower() and all(mark == _MARK or mark.isalpha() for mark in piece)})


def words_in(text: str) -> list[str]:
    """Runs of letters in lower case."""
    words = _WORDS.findall(text.lower())
    if all(map(str.isalpha, words)):
        return words
    # signs that only count are word signs, but no letters
    return [run for word in words for run in "".join(sign if sign.isalpha() else " " for sign in word).split()]


@dataclass
class Lattice:
    """Pieces found in words: for each begin and end, the words (by place in ``order``, longest first) and the pieces."""

    order: np.ndarray
    sizes: np.ndarray
    found: list[tuple[int, int, np.ndarray, np.ndarray]]


class Matcher:
    """Finds pieces in many words at once: every run of letters is looked up by its hash among the pieces of its length."""

    _STEP = 0x9E3779B97F4A7C15

    def __init__(self, pieces: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()  # for long words
        by_size: dict[int, list[int]] = {}
        for number, piece in enumerate(pieces):
            self.automaton.add_word(piece, (number, len(piece)))
            by_size.setdefault(len(piece), []).append(number)
        self.automaton.make_automaton()
        self.tables = {}
        for size, numbers in by_size.items():
            hashes = self._sums([pieces[n] for n in numbers], size)[:, size]
            order = np.argsort(hashes)
            marks = np.zeros(1 << 16, dtype=bool)
            marks[hashes >> np.uint64(48)] = True
            self.tables[size] = hashes[order], np.array(numbers)[order], marks

    def _sums(self, words: list[str], width: int) -> np.ndarray:
        """Hash of the first letters of each word, up to each place."""
        sizes = np.array([len(word) for word in words])
        codes = mix(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
        grid = np.zeros((len(words), width), dtype=np.uint64)
        grid[np.arange(width)[None, :] < sizes[:, None]] = codes
        sums = np.zeros((len(words), width + 1), dtype=np.uint64)
        for place in range(width):
            sums[:, place + 1] = sums[:, place] * np.uint64(self._STEP) + grid[:, place]
        return sums

    def lattice(self, words: list[str]) -> Lattice:
        marked = [_MARK + word for word in words]
        sizes = np.array([len(word) for word in marked])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        width = int(sizes[0]) if len(sizes) else 0
        sums = np.asfortranarray(self._sums([marked[n] for n in order.tolist()], width))
        found = []
        for end in range(1, width + 1):
            count = int(np.searchsorted(-sizes, -end, side="right"))
            for size in range(min(end, max(self.tables, default=0)), 0, -1):
                if size not in self.tables:
                    continue
                hashes, numbers, marks = self.tables[size]
                here = sums[:count, end] - sums[:count, end - size] * np.uint64(pow(self._STEP, size, 1 << 64))
                maybe = np.flatnonzero(marks[here >> np.uint64(48)])
                if not len(maybe):
                    continue
                at = np.minimum(np.searchsorted(hashes, here[maybe]), len(hashes) - 1)
                hit = hashes[at] == here[maybe]
                if hit.any():
                    found.append((end - size, end, maybe[hit], numbers[at[hit]]))
        return Lattice(order, sizes, found)


def forward(lattice: Lattice, probability: np.ndarray, unknown: float = UNKNOWN_LETTER) -> np.ndarray:
    """Sum over the segmentations of each word up to each place: places x words x languages."""
    width = int(lattice.sizes[0]) if len(lattice.sizes) else 0
    place = np.zeros((width + 1, len(lattice.sizes), probability.shape[1]))
    place[0] = 1.0
    found = iter([*lattice.found, (0, width + 1, None, None)])
    begin, end, rows, pieces = next(found)
    for here in range(1, width + 1):
        np.multiply(place[here - 1], unknown, out=place[here])
        while end == here:
            place[here, rows] += place[begin, rows] * probability[pieces]
            begin, end, rows, pieces = next(found)
    return place


def backward(lattice: Lattice, probability: np.ndarray, unknown: float = UNKNOWN_LETTER) -> np.ndarray:
    """Sum over the segmentations of each word from each place to its end."""
    width = int(lattice.sizes[0]) if len(lattice.sizes) else 0
    place = np.zeros((width + 1, len(lattice.sizes), probability.shape[1]))
    place[lattice.sizes, np.arange(len(lattice.sizes))] = 1.0
    by_begin: dict[int, list] = {}
    for begin, end, rows, pieces in lattice.found:
        by_begin.setdefault(begin, []).append((end, rows, pieces))
    for here in range(width - 1, -1, -1):
        inside = lattice.sizes > here
        place[here, inside] = place[here + 1, inside] * unknown
        for end, rows, pieces in by_begin.get(here, ()):
            place[here, rows] += place[end, rows] * probability[pieces]
    return place


def _long_sums(found: dict[int, list[tuple[int, int]]], size: int, logs: np.ndarray, unknown: float) -> np.ndarray:
    """Logarithms of the sums up to each place of one word; ``found``: (piece, size) by the place where they end."""
    place = np.zeros((size + 1, logs.shape[1]))
    for here in range(1, size + 1):
        total = place[here - 1] + np.log(unknown)
        for number, length in found.get(here, ()):
            total = np.logaddexp(total, place[here - length] + logs[number])
        place[here] = total
    return place


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    probability: np.ndarray
    log_share: np.ndarray
    logs: np.ndarray | None = field(default=None, repr=False)

    def word_scores(self, words: list[str], matcher: Matcher) -> np.ndarray:
        """Log probability of each word under each language."""
        scores = np.zeros((len(words), len(self.languages)))
        short = [n for n, word in enumerate(words) if len(word) <= LONG_WORD]
        at_once = max(64, WORDS_AT_ONCE * 4 // max(len(self.languages), 4))
        for at in range(0, len(short), at_once):
            part = short[at : at + at_once]
            lattice = matcher.lattice([words[n] for n in part])
            ends = forward(lattice, self.probability)[lattice.sizes, np.arange(len(part))]
            scores[np.array(part)[lattice.order]] = np.log(ends)
        for n, word in enumerate(words):
            if len(word) > LONG_WORD:
                scores[n] = self._long(word, matcher)
        return scores

    def _long(self, word: str, matcher: Matcher) -> np.ndarray:
        if self.logs is None:
            self.logs = np.log(self.probability)
        return _long_sums(_ends(_MARK + word, matcher), len(word) + 1, self.logs, UNKNOWN_LETTER)[-1]


def _ends(text: str, matcher: Matcher) -> dict[int, list[tuple[int, int]]]:
    found: dict[int, list[tuple[int, int]]] = {}
    for end, piece in matcher.automaton.iter(text):
        found.setdefault(end + 1, []).append(piece)
    return found


def fit(words: list[str], counts: list[int], matcher: Matcher, n_pieces: int, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language from its words: expected counts over all segmentations, again and again."""
    own = np.full((n_pieces, 1), 1.0 / max(n_pieces, 1))
    weight = np.array(counts, dtype=float)
    short = [n for n, word in enumerate(words) if len(word) <= LONG_WORD]
    parts = [short[at : at + WORDS_AT_ONCE] for at in range(0, len(short), WORDS_AT_ONCE)]
    lattices = [(matcher.lattice([words[n] for n in part]), weight[part]) for part in parts]
    long = [(_ends(_MARK + words[n], matcher), len(words[n]) + 1, weight[n]) for n in range(len(words)) if len(words[n]) > LONG_WORD]
    for _ in range(rounds):
        expected = np.full(n_pieces, ADDED_COUNT)
        for lattice, times in lattices:
            ahead, behind = forward(lattice, own)[:, :, 0], backward(lattice, own)[:, :, 0]
            share = times[lattice.order] / behind[0]
            for begin, end, rows, pieces in lattice.found:
                through = ahead[begin, rows] * own[pieces, 0] * behind[end, rows] * share[rows]
                expected += np.bincount(pieces, through, n_pieces)
        logs = np.log(own)
        for found, size, times in long:
            ahead = _long_sums(found, size, logs, UNKNOWN_LETTER)[:, 0]
            # sums from the other side: the same word, mirrored
            mirrored: dict[int, list[tuple[int, int]]] = {}
            for end, pieces in found.items():
                for number, length in pieces:
                    mirrored.setdefault(size - end + length, []).append((number, length))
            behind = _long_sums(mirrored, size, logs, UNKNOWN_LETTER)[::-1, 0]
            for end, pieces in found.items():
                for number, length in pieces:
                    expected[number] += times * np.exp(ahead[end - length] + logs[number, 0] + behind[end] - ahead[size])
        own = (expected / expected.sum())[:, None]
    return own[:, 0]


#: What a worker keeps between tasks: the matcher of a vocabulary. Word scores end with their task, for a worker serves other stages too.
_MATCHERS: dict[int, Matcher] = {}


def _matcher(pieces: list[str]) -> Matcher:
    key = hash(tuple(pieces))
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(pieces)
    return _MATCHERS[key]


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str | None = None) -> LanguageModel:
    """Learn from labelled rows: shares from all of them, words from a sample of ``SAMPLE_DOCS`` for each language."""
    spark, pieces = labelled.sparkSession, vocabulary(path)
    rows = labelled.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    shares = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    # the smallest keys of each language, the same ones whatever the partitions, are chosen before any text is moved; only those
    # below a bound under which about twice as many lie are put in order
    keys = rows.select("lang", "key").distinct()
    reach = F.lit(-(2.0**63)) + F.least(F.lit(1.0), (2 * SAMPLE_DOCS + 100) / F.col("n")) * 2.0**64
    small = keys.join(F.broadcast(keys.groupBy("lang").agg(F.count("*").alias("n"))), "lang").where(F.col("key") <= reach)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    last = small.withColumn("nth", nth).where(F.col("nth") <= SAMPLE_DOCS).groupBy("lang").agg(F.max("key").alias("last"))
    sample = rows.join(F.broadcast(last), "lang").where("key <= last").dropDuplicates(["lang", "key"])
    words = sample.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counted = words.groupBy("lang", "word").count()
    sent = spark.sparkContext.broadcast(pieces)

    def learned(group: pa.Table) -> pa.Table:
        group = group.sort_by("word")
        own = fit(group["word"].to_pylist(), group["count"].to_pylist(), _matcher(sent.value), len(sent.value))
        return pa.table({"lang": group["lang"][:1], "probability": pa.array([own.tobytes()], pa.binary())})

    ship(spark)
    found = {row["lang"]: np.frombuffer(row["probability"]) for row in counted.groupBy("lang").applyInArrow(learned, "lang string, probability binary").toLocalIterator()}
    languages = sorted(shares)
    probability = np.full((len(pieces), len(languages)), 1.0 / max(len(pieces), 1))
    for column, language in enumerate(languages):
        if language in found:
            probability[:, column] = found[language]
    share = np.array([shares[language] for language in languages], dtype=float)
    return LanguageModel(languages, pieces, probability, np.log(share / share.sum()) if len(share) else share)


class Scorer:
    """Languages of texts, with the scores of words met before: new words of some texts are scored together."""

    def __init__(self, model: LanguageModel):
        self.model, self.matcher = model, _matcher(model.pieces)
        self.most = max(1000, KEPT_BYTES // (8 * max(len(model.languages), 1)))
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))
        self.filled = 0

    def _learn(self, words: list[str]) -> None:
        if self.filled + len(words) > len(self.scores):
            grown = np.zeros((2 * len(self.scores) + len(words), self.scores.shape[1]))
            grown[: self.filled] = self.scores[: self.filled]
            self.scores = grown
        self.scores[self.filled : self.filled + len(words)] = self.model.word_scores(words, self.matcher)
        self.places.update(zip(words, range(self.filled, self.filled + len(words))))
        self.filled += len(words)

    def decide(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [words_in(text) if text else [] for text in texts]
        if not self.model.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        if self.filled > self.most:
            self._forget()
        self._learn(list(set().union(*found) - self.places.keys()))
        out = []
        for words in found:
            if not words:
                out.append((UNDETERMINED, 0.0))
                continue
            total = self.model.log_share.copy()
            for at in range(0, len(words), 1 << 16):
                part = words[at : at + (1 << 16)]
                total += self.scores[np.fromiter(map(self.places.__getitem__, part), np.int64, len(part))].sum(axis=0)
            best = int(np.argmax(total))
            out.append((self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def _predicted(rows: DataFrame, place: int, model: LanguageModel, kept: int, pred: str, score: str) -> DataFrame:
    """The first ``kept`` columns and the language of the text at ``place``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    fields = rows.schema.fields[:kept]
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                langs, scores = zip(*scorer.decide(part.column(place).to_pylist()))
                columns = [part.column(n) for n in range(kept)]
                names = [part.schema.names[n] for n in range(kept)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*names, pred, score])

    ship(rows.sparkSession)
    return rows.mapInArrow(run, f"{schema}, {pred} string, {score} double")


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score (probability of that language given the text)."""
    return _predicted(docs.select(F.col(id_col), F.col(text_col).alias("__text")), 1, model, 1, "lang_pred", "score")


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows with all their columns, and ``__lang_pred`` and ``__lang_score``."""
    return _predicted(docs, docs.columns.index(text_col), model, len(docs.columns), "__lang_pred", "__lang_score")
