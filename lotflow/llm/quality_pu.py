"""Text quality from trusted positives and unlabelled text (positive-unlabelled learning).

The model is a small network over statistics of the whole text. It is trained on documents that are
trusted as good and on others whose quality is unknown, by the non-negative unbiased risk: the risk of
the unlabelled texts as negatives, less what the positives among them contribute, is never let below
zero. The share of positives among the unlabelled (the class prior) is estimated from the data, as the
least ratio of unlabelled to positive mass among the best scores of a first model, each weighed with the
other half of the sample. The loss is logistic, so the score is a probability.

Null and empty texts are scored like any other, as texts without words. Each row gives one row; other
columns are left aside. Without positives or without unlabelled text every score is the prior, 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.texts import batch_of, checkpointed, rows_of
from lotflow.shipping import ship

#: Bounds of the training sample: trusted positives, and unlabelled documents.
SAMPLE_POSITIVE, SAMPLE_UNLABELLED = 6000, 12_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 24, 60, 512, 5e-3, 1e-4, 7
#: Fewest positives above a score for its ratio to count in the estimate of the prior.
PRIOR_LEAST = 200
THRESHOLD = 0.3

_SYMBOLS = str.maketrans("", "", "#*$%&|<>{}[]\\^~_=+@/")
_MARKS = str.maketrans("", "", ".,;:!?\"'()-")
_DIGITS = str.maketrans("", "", "0123456789")
_BREAKS = re.compile(r"[.!?]+\s")


def features(text: str | None) -> list[float]:
    """Statistics of a whole text, none of which grows faster than a logarithm of its length."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * N_FEATURES
    sizes = np.fromiter(map(len, words), dtype=np.int32, count=n)
    letters = max(1, int(sizes.sum()))
    counts = Counter(words)
    top = counts.most_common(1)[0][1]
    triples = list(zip(words, words[1:], words[2:]))
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    upper = sum(map(str.isupper, words))
    lower = sum(map(str.islower, words))
    alphabetic = sum(map(str.isalpha, words))
    tails = Counter([word[-1] for word in words])
    sentence = len(_BREAKS.findall(text)) + 1
    return [
        np.log1p(n),
        np.log1p(chars),
        float(sizes.mean()),
        float(sizes.std()),
        float((sizes <= 3).mean()),
        float((sizes >= 10).mean()),
        np.log1p(int(sizes.max())),
        1 - len(text.translate(_SYMBOLS)) / chars,
        1 - len(text.translate(_MARKS)) / chars,
        1 - len(text.translate(_DIGITS)) / chars,
        upper / n,
        lower / n,
        alphabetic / n,
        len(counts) / n,
        top / n,
        1 - len(set(triples)) / len(triples) if triples else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        np.log1p(n / sentence),
        np.log1p(n / max(1, len(lines))),
        (tails["!"] + tails["?"]) / n,
        (tails["."] + tails[","]) / n,
        counts["|"] / n,
        text.count("...") / n,
        (chars - letters) / chars,
    ]


N_FEATURES = 24


@dataclass
class Network:
    """One hidden layer over standardised features; ``logit`` of being positive."""

    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return _forward(self.weights, self.standard(rows))[0]

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.centre) / self.scale, -8, 8)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(rows), -30, 30)))


def _forward(weights: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, bias, second, shift = weights
    hidden = np.tanh(rows @ first + bias)
    return hidden @ second + shift[0], hidden


def _slope(weights: list[np.ndarray], rows: np.ndarray, hidden: np.ndarray, by_logit: np.ndarray) -> list[np.ndarray]:
    back = by_logit[:, None] * weights[2][None, :] * (1 - hidden**2)
    return [rows.T @ back, back.sum(axis=0), hidden.T @ by_logit, np.array([by_logit.sum()])]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = EPOCHS) -> Network:
    """Least non-negative risk by stochastic gradients (Adam) over paired batches of both samples."""
    random = np.random.default_rng(SEED)
    both = np.concatenate([positive, unlabelled])
    net = Network(both.mean(axis=0), both.std(axis=0) + 1e-6, [], prior)
    width = both.shape[1]
    net.weights = [random.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    good, mixed = net.standard(positive), net.standard(unlabelled)
    mean, square, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    batches = max(1, len(mixed) // BATCH)
    for _ in range(epochs):
        for rows_u in np.array_split(random.permutation(len(mixed)), batches):
            rows_p = random.integers(0, len(good), size=min(len(good), BATCH))
            p, u = good[rows_p], mixed[rows_u]
            logit_p, hidden_p = _forward(net.weights, p)
            logit_u, hidden_u = _forward(net.weights, u)
            sure_p, sure_u = 1 / (1 + np.exp(-logit_p)), 1 / (1 + np.exp(-logit_u))
            # logistic losses: log(1 + exp(-z)) as a positive, log(1 + exp(z)) as a negative
            negative = np.logaddexp(0, logit_u).mean() - prior * np.logaddexp(0, logit_p).mean()
            if negative >= 0:
                by_p = prior * (sure_p - 1 - sure_p) / len(p)
                by_u = sure_u / len(u)
            else:  # overfitted: step back on the part that fell below zero
                by_p, by_u = prior * sure_p / len(p), -sure_u / len(u)
            slopes = [a + b for a, b in zip(_slope(net.weights, p, hidden_p, by_p), _slope(net.weights, u, hidden_u, by_u))]
            step += 1
            for n, slope in enumerate(slopes):
                slope = slope + DECAY * net.weights[n]
                mean[n] = 0.9 * mean[n] + 0.1 * slope
                square[n] = 0.999 * square[n] + 0.001 * slope**2
                net.weights[n] = net.weights[n] - RATE * (mean[n] / (1 - 0.9**step)) / (np.sqrt(square[n] / (1 - 0.999**step)) + 1e-8)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: least ratio of the two masses above a score, on held-back halves.

    Above a score that few negatives reach, the unlabelled mass is the prior times the positive one;
    the bound of chance is added so that a small sample does not lower the estimate.
    """
    model = fit(positive[::2], unlabelled[::2], prior=0.5, epochs=EPOCHS // 3)
    good, mixed = np.sort(model.logit(positive[1::2])), np.sort(model.logit(unlabelled[1::2]))
    least = min(PRIOR_LEAST, max(1, len(good) // 4))
    cuts = good[: len(good) - least + 1]
    mass_p = 1 - np.searchsorted(good, cuts, side="left") / len(good)
    mass_u = 1 - np.searchsorted(mixed, cuts, side="left") / len(mixed)
    slack = np.sqrt(np.log(20) / (2 * len(good))) + np.sqrt(np.log(20) / (2 * len(mixed)))
    best = int(np.argmin((mass_u + slack) / mass_p))
    return float(np.clip(mass_u[best] / mass_p[best], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> Network | None:
    if len(positive) < 4 or len(unlabelled) < 4:
        return None
    return fit(positive, unlabelled, estimate_prior(positive, unlabelled))


def featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and statistics of each row's text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("id", batch.column(0).type), ("stats", pa.list_(pa.float64()))])
            for rows in rows_of([batch], "id", "text"):
                yield batch_of([(number, features(text)) for number, text in rows], schema)

    ship(docs.sparkSession)
    return docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(run, f"id {kind}, stats array<double>")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Network | None:
    """Trusted positives are the rows labelled 1; the unlabelled text is drawn from all rows given, whatever their labels.

    An id that repeats counts once, with the least of its texts; rows without an id are not drawn. So the sample
    is bounded by its two sizes, its ids go to all executors, and only its texts are moved.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    trusted = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).distinct()
    order = F.xxhash64("id")
    # the ids with the smallest hashes are chosen before any text is read
    picked_u = rows.select("id").distinct().orderBy(order, "id").limit(SAMPLE_UNLABELLED)
    picked_p = rows.select("id").join(trusted, "id", "left_semi").distinct().orderBy(order, "id").limit(SAMPLE_POSITIVE)
    wanted = checkpointed(picked_u.select("id", F.lit(0).alias("role")).unionAll(picked_p.select("id", F.lit(1).alias("role"))))
    sample = rows.join(F.broadcast(wanted), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    stats = featured(sample, "id", "text").join(wanted, "id").orderBy("id", "role").select("role", "stats").collect()
    split = {role: np.array([row["stats"] for row in stats if row["role"] == role]).reshape(-1, N_FEATURES) for role in (0, 1)}
    return train(split[1], split[0])


def quality_scores(docs: DataFrame, model: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, predicted (1 from ``THRESHOLD`` on)."""
    name, kind = id_col, docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([(name, batch.column(0).type), ("score", pa.float64()), ("predicted", pa.int32())])
            for rows in rows_of([batch], "__id", "__text"):
                stats = np.array([features(text) for _, text in rows]).reshape(-1, N_FEATURES)
                scores = sent.value.score(stats) if sent.value else np.full(len(rows), 0.5)
                yield batch_of([(number, score, int(score >= THRESHOLD)) for (number, _), score in zip(rows, scores.tolist())], schema)

    ship(docs.sparkSession)
    rows = docs.selectExpr(f"`{id_col}` AS __id", f"`{text_col}` AS __text")
    return rows.mapInArrow(run, f"`{name}` {kind}, score double, predicted int")
