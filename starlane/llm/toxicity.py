"""Toxicity: a linear classifier over character n-grams scaled by log-count ratios.

A feature is the presence of a run of characters in the whole text, in lower
case, told from others by a 64-bit hash.  Its value is the naive Bayes log-count
ratio of that run between toxic and other texts; a logistic model learns the
weights on top.  Only runs that got a weight count, however many others a text has.

A text longer than a passage scores as its worst passage: half-overlapping
passages cover the whole text, so a long clean text does not gather the weak
signs of thousands of sentences, and a short insult in it is seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.texts import as_bytes, crc32_of_key, labelled_sample, map_steps, table


@dataclass(frozen=True)
class Training:
    """Bounds of the sample, the n-grams, and the fit."""

    rows: int = 8000
    most_bytes: int = 16384
    passage: int = 4096
    orders: tuple[int, ...] = (5, 6, 8)
    smoothing: float = 1.0
    least: int = 8
    surprise: float = 4.0
    rounds: int = 150
    rate: float = 0.05
    decay: float = 1e-3


# Cells of the tables that rule out most n-grams before they are looked up by their hash:
# of the counts in training (a byte each), and of the fitted model's few.
COUNT_BITS = 25
MODEL_BITS = 17


def cell_of(features: np.ndarray, bits: int) -> np.ndarray:
    return (features >> np.uint64(64 - bits)).astype(np.int64)


def grams(body: bytes, sizes: Training) -> Iterator[np.ndarray]:
    """64-bit hashes of n-grams, one array for each order; the text has a blank at each end."""
    data = np.frombuffer(b" " + b" ".join(body.lower().split()) + b" ", dtype=np.uint8)
    mixed = data.astype(np.uint64) + np.uint64(1)
    for order in range(2, max(sizes.orders) + 1):
        if len(data) < order:
            return
        mixed = mixed[:-1] * np.uint64(0x9E3779B97F4A7C15) + data[order - 1 :]
        if order in sizes.orders:
            spread = (mixed ^ (mixed >> np.uint64(32))) + np.uint64(order)
            spread *= np.uint64(0xD6E8FEB86659FD93)
            yield (spread ^ (spread >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Model:
    """Weights of n-grams by hash, and a bias."""

    def __init__(self, used: np.ndarray, weight: np.ndarray, bias: float):
        self.used, self.weight, self.bias = used, weight, bias
        self.possible = np.zeros(1 << MODEL_BITS, dtype=bool)
        self.possible[cell_of(used, MODEL_BITS)] = True

    def found(self, body: bytes, sizes: Training) -> tuple[np.ndarray, np.ndarray, int]:
        """Where in the text, and where in ``used``, known n-grams are; the text's length."""
        where, which = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        length = 0
        for features in grams(body, sizes) if len(self.used) else ():
            length = max(length, len(features))
            at = np.flatnonzero(self.possible[cell_of(features, MODEL_BITS)])
            features = features[at]
            place = np.minimum(np.searchsorted(self.used, features), len(self.used) - 1)
            known = self.used[place] == features
            where.append(at[known])
            which.append(place[known])
        return np.concatenate(where), np.concatenate(which), length

    def margin(self, body: bytes, sizes: Training) -> float:
        """The bias and the weights of the n-grams present, in the passage where this is most."""
        where, which, length = self.found(body, sizes)
        if length <= sizes.passage:
            return self.bias + float(self.weight[np.unique(which)].sum())
        half = sizes.passage // 2
        last = -(-length // half) - 2  # the last passage reaches the end
        later = where // half
        passage = np.concatenate([later, later - 1])
        pairs = passage * len(self.used) + np.concatenate([which, which])
        pairs = np.unique(pairs[(passage >= 0) & (passage <= last)])
        sums = np.bincount(pairs // len(self.used), self.weight[pairs % len(self.used)], last + 1)
        return self.bias + float(sums.max())


class Counter:
    """How often each hash was added; hashes wait in a buffer of a few megabytes and are merged."""

    def __init__(self, most: int = 1 << 21):
        self.names, self.counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.waiting, self.held, self.most = [], 0, most

    def add(self, features: np.ndarray) -> None:
        self.waiting.append(features)
        self.held += len(features)
        if self.held >= self.most:
            self.merge()

    def merge(self) -> None:
        if self.waiting:
            found, times = np.unique(np.concatenate(self.waiting), return_counts=True)
            names, place = np.unique(np.concatenate([self.names, found]), return_inverse=True)
            counts = np.zeros(len(names), dtype=np.int64)
            counts[place[: len(self.names)]] = self.counts
            counts[place[len(self.names) :]] += times
            self.names, self.counts, self.waiting, self.held = names, counts, [], 0


def counted(sample: list[tuple[bytes, int]], sizes: Training) -> tuple[np.ndarray, np.ndarray]:
    """N-grams that ``least`` texts have or more, and in how many texts of each label each is.

    A first pass counts by cell, whose count is that of its n-grams or more, so
    the second keeps only n-grams that can be frequent.
    """
    enough = min(sizes.least, 255)
    cells = np.zeros(1 << COUNT_BITS, dtype=np.uint8)
    for body, _ in sample:
        for features in grams(body, sizes):
            cell = np.unique(cell_of(features, COUNT_BITS))
            cells[cell] += cells[cell] < enough
    sides = Counter(), Counter()
    for body, label in sample:
        for features in grams(body, sizes):
            sides[label].add(np.unique(features[cells[cell_of(features, COUNT_BITS)] == enough]))
    for side in sides:
        side.merge()
    every = np.union1d(sides[0].names, sides[1].names)
    counts = np.zeros((2, len(every)))
    for label, side in enumerate(sides):
        counts[label][np.searchsorted(every, side.names)] = side.counts
    frequent = counts.sum(axis=0) >= sizes.least
    return every[frequent], counts[:, frequent]


def train(sample: list[tuple[bytes, int]], sizes: Training = Training()) -> Model | float:
    """The fitted model; the mean label where one label is missing."""
    kinds = {label for _, label in sample}
    if len(kinds) < 2:
        return float(kinds.pop()) if kinds else 0.5
    sample = sorted(set(sample))  # a group of copies counts once
    labels = np.array([label for _, label in sample], dtype=np.float64)
    used, (other, toxic) = counted(sample, sizes)
    ratio = np.log((toxic + sizes.smoothing) / (labels.sum() + 2 * sizes.smoothing))
    ratio -= np.log((other + sizes.smoothing) / ((1 - labels).sum() + 2 * sizes.smoothing))
    # Only runs that stand out from chance get a weight; thousands of others would drown them.
    count, share = toxic + other, labels.mean()
    surprise = (toxic - count * share) / np.sqrt(count * share * (1 - share) + 1e-9)
    stands = (np.abs(surprise) >= sizes.surprise) & (ratio != 0)
    used, ratio = used[stands], ratio[stands]
    model = Model(used, np.zeros(len(used)), 0.0)
    sets = [np.unique(model.found(body, sizes)[1]) for body, _ in sample]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    index = np.concatenate(sets)
    value = ratio[index]
    weight, bias = np.zeros(len(used)), np.log(labels.mean() / (1 - labels.mean()))
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, sizes.rounds + 1):
        margin = np.bincount(owner, weight[index] * value, len(labels)) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / len(labels)
        slope = np.append(np.bincount(index, error[owner] * value, len(used)), error.sum())
        slope[:-1] += sizes.decay * weight
        first += 0.1 * (slope - first)
        second += 0.01 * (slope**2 - second)
        change = sizes.rate * first / (1 - 0.9**step)
        change /= np.sqrt(second / (1 - 0.99**step)) + 1e-8
        weight -= change[:-1]
        bias -= change[-1]
    return Model(used, weight * ratio, float(bias))


def toxicity(
    docs: DataFrame, labels: DataFrame, sizes: Training = Training(), learn: F.Column | None = None
) -> DataFrame:
    """doc_id, score and predicted for each row of ``docs`` (doc_id, text).

    Learns ``labels.toxic`` of the rows where ``learn``, a condition on doc_id,
    holds (all by default).  A null, empty or very short text has no n-grams and
    gets the score of the bias.  Without labels the score is 0.5, with labels of
    one kind that label.  Texts of any length are scored whole, as their worst
    passage; each n-gram counts once there.  Repeated rows are scored each on its own and alike, and count once in
    learning.  A score of 0.5 counts as toxic.  An empty table gives no rows.
    """
    wanted = F.lit(True) if learn is None else learn
    sample = labelled_sample(docs, labels, "toxic", wanted, sizes.rows, sizes.most_bytes)
    rows = sorted((r.doc_id, bytes(r.body), r.label) for r in sample.collect())
    model = train([(body, label) for _, body, label in rows], sizes)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(step: pa.RecordBatch) -> dict[str, object]:
        fitted = shared.value
        bodies = step.column("body").to_pylist()
        if isinstance(fitted, float):
            score = np.full(len(bodies), fitted)
        else:
            margin = np.array([fitted.margin(b, sizes) for b in bodies])
            score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        return {
            "doc_id": step.column("doc_id"), "score": score,
            "predicted": pa.array(score >= 0.5).cast(pa.int32()),
        }

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_steps(as_bytes(docs, "doc_id"), work, f"doc_id {key}, score double, predicted int")


def held_out() -> F.Column:
    return crc32_of_key() % 5 == 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity(docs, labels, learn=~held_out())
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
