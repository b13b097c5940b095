"""Quality classifier: a convolutional network over bytes, in numpy.

A text's bytes are read four to a cell.  Learned filters see two neighbouring
cells: the embedded bytes and how much of the surroundings stands earlier in
the text.  Their outputs are max-pooled over overlapping chunks that cover the
whole text, a small dense layer turns each chunk into a logit, and the mean of
the chunks' logits gives the document's probability.

The network learns in rounds from all chunks of all labelled texts: every task improves
the current weights on the texts of its own part, and their mean starts the next round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.llm.texts import as_bytes, crc32_of_key, give_back, map_steps, steps, table
from starlane.session import materialize, scratch

CELL, BLOCK, CHUNK, STRIDE = 4, 16, 8, 7  # bytes; cells; blocks; blocks
# Cells whose filters are held at once when texts are scored; a multiple of the rows that matrix
# products take together, so that they round as they do over all cells.
SLICE = 576 * BLOCK


@dataclass(frozen=True)
class Training:
    """How the network is trained, and its size.

    A task has about ``part_bytes`` of text; ``shuffled`` chunks at a time are dealt into
    batches.  A task of few chunks reads them again until all rounds have ``steps``
    batches.  A text weighs as ``chunks_a_text`` of its chunks at most; all of them count.
    """

    rounds: int = 3
    part_bytes: int = 16 << 20
    shuffled: int = 16384
    chunks_a_text: int = 6
    steps: int = 400
    rate: float = 4e-3
    embedding: int = 6
    filters: int = 24
    hidden: int = 12
    seed: int = 7


def recurrence(data: np.ndarray) -> np.ndarray:
    """For each cell, the share of nearby words whose next 16 bytes stand earlier in the text."""
    cells = len(data) // CELL
    starts = np.flatnonzero((data[:-1] <= 32) & (data[1:] > 32)) + 1 if len(data) > 1 else []
    starts = np.asarray(starts, dtype=np.int64)
    starts = starts[starts <= len(data) - 16]
    near = np.zeros(cells, dtype=np.float32)
    if len(starts) < 2:
        return near
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    halves = [np.ascontiguousarray(windows[starts + k]).view("<u8")[:, 0] for k in (0, 8)]
    keys = halves[0] * np.uint64(0x9E3779B97F4A7C15) ^ halves[1]
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(starts), dtype=bool)
    again[first] = False
    words = np.bincount(starts // CELL, minlength=cells)
    seen = np.bincount(starts[again] // CELL, minlength=cells)
    sums = [np.concatenate(([0], np.cumsum(x))) for x in (seen, words)]
    low = np.maximum(np.arange(cells) - 2 * BLOCK, 0)
    high = np.minimum(np.arange(cells) + 2 * BLOCK, cells)
    near[:] = (sums[0][high] - sums[0][low]) / np.maximum(sums[1][high] - sums[1][low], 1)
    return near


def cells_of(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A text's bytes, padded so that it ends on a block with an empty cell, and its recurrence."""
    unit = CELL * BLOCK
    padded = np.zeros((len(body) + CELL + unit - 1) // unit * unit, dtype=np.uint8)
    padded[: len(body)] = np.frombuffer(body, dtype=np.uint8)
    near = np.zeros(len(padded) // CELL, dtype=np.float32)
    own = recurrence(padded[: len(body)])
    near[: len(own)] = own
    return padded, near


class Network:
    """Weights as plain arrays: embedding, filters, dense layer."""

    def __init__(self, sizes: Training, average: float = 0.5):
        rng = np.random.default_rng(sizes.seed)
        d, f, h = sizes.embedding, sizes.filters, sizes.hidden
        self.width = CELL * d + 1
        self.weights = {
            "bytes": rng.normal(0, 0.5, (256, d)),
            "filter": rng.normal(0, (2 * self.width) ** -0.5, (2 * self.width, f)),
            "shift": np.zeros(f),
            "dense": rng.normal(0, f**-0.5, (f, h)),
            "dense_shift": np.zeros(h),
            "out": rng.normal(0, h**-0.5, h),
            "bias": np.array([np.log(average / (1 - average))]),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.weights.values()])

    def load(self, vector: np.ndarray) -> Network:
        cuts = np.cumsum([v.size for v in self.weights.values()])[:-1]
        parts = zip(self.weights.items(), np.split(vector.astype(np.float32), cuts))
        self.weights = {k: part.reshape(v.shape) for (k, v), part in parts}
        return self

    def cells(self, data: np.ndarray, near: np.ndarray) -> np.ndarray:
        out = np.empty((len(near), self.width), dtype=np.float32)
        out[:, :-1] = self.weights["bytes"][data].reshape(len(near), -1)
        out[:, -1] = near
        return out

    def filtered(self, cells: np.ndarray) -> np.ndarray:
        """Outputs of the filters at each cell but the last."""
        w = self.weights["filter"]
        out = cells[:-1] @ w[: self.width]
        out += cells[1:] @ w[self.width :]
        out += self.weights["shift"]
        return np.maximum(out, 0, out=out)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(pooled @ w["dense"] + w["dense_shift"]) @ w["out"] + w["bias"]

    def score(self, bodies: list[bytes]) -> np.ndarray:
        parts = [cells_of(x) for x in bodies]
        blocks = np.array([len(near) // BLOCK for _, near in parts])
        ends = np.cumsum(blocks)
        data, near = (np.concatenate(x) for x in zip(*parts))
        last = np.zeros(len(near), dtype=bool)
        last[ends * BLOCK - 1] = True  # would look into the next text
        tops = np.zeros((len(near) // BLOCK + 1, self.weights["filter"].shape[1]), dtype=np.float32)
        for a in range(0, len(near), SLICE):
            b = min(a + SLICE, len(near))
            cells = self.cells(data[a * CELL : (b + 1) * CELL], near[a : b + 1])
            out = np.zeros((b - a, tops.shape[1]), dtype=np.float32)
            out[: len(cells) - 1] = self.filtered(cells)
            out[last[a:b]] = 0
            tops[a // BLOCK : b // BLOCK] = out.reshape(-1, BLOCK, out.shape[1]).max(axis=1)
        counts = (np.maximum(blocks - 1, 1) + STRIDE - 1) // STRIDE
        owner = np.repeat(np.arange(len(blocks)), counts)
        begin = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = begin * STRIDE + (ends - blocks)[owner]
        stop = np.minimum(begin + CHUNK, ends[owner])
        pooled = np.maximum.reduceat(tops, np.stack([begin, stop], axis=1).ravel())[::2]
        mean = np.bincount(owner, self.logits(pooled), len(blocks)) / counts
        return 1 / (1 + np.exp(-mean))

    def gradients(
        self, data: np.ndarray, near: np.ndarray, labels: np.ndarray, weight: np.ndarray | float = 1.0
    ) -> dict:
        """Gradients of the weighted log loss over a batch of chunks of equal length."""
        w, size = self.weights, len(labels)
        count = near.shape[1]
        cells = self.cells(data.ravel(), near.ravel())
        out = np.zeros((len(cells), w["shift"].size), dtype=np.float32)
        out[:-1] = self.filtered(cells)
        out = out.reshape(size, count, -1)[:, :-1]
        at = out.argmax(axis=1)
        pooled = np.take_along_axis(out, at[:, None], axis=1)[:, 0]
        hidden = np.tanh(pooled @ w["dense"] + w["dense_shift"])
        p = 1 / (1 + np.exp(-(hidden @ w["out"] + w["bias"])))
        d_out = ((p - labels) * weight / size).astype(np.float32)
        d_hidden = d_out[:, None] * w["out"] * (1 - hidden**2)
        d_pooled = (d_hidden @ w["dense"].T) * (pooled > 0)
        place = at + np.arange(size)[:, None] * count
        seen = np.concatenate([cells[place], cells[place + 1]], axis=2)
        d_filter = np.einsum("nf,nfk->kf", d_pooled, seen, optimize=True)
        d_seen = d_pooled[:, :, None] * w["filter"].T
        d_bytes = np.zeros_like(w["bytes"])
        letters = data.reshape(-1, CELL)
        for half in (0, 1):
            part = d_seen[:, :, half * self.width : (half + 1) * self.width - 1]
            part = part.reshape(-1, CELL, w["bytes"].shape[1])
            np.add.at(d_bytes, letters[(place + half).ravel()], part)
        return {
            "bytes": d_bytes, "filter": d_filter, "shift": d_pooled.sum(0),
            "dense": pooled.T @ d_hidden, "dense_shift": d_hidden.sum(0),
            "out": hidden.T @ d_out, "bias": np.array([d_out.sum()], dtype=np.float32),
        }


def _chunks(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the recurrence of all chunks of a text, with one cell more for the last filter."""
    data, near = cells_of(body)
    length = BLOCK * CHUNK + 1
    starts = np.arange(0, max(len(near) // BLOCK - 1, 1), STRIDE) * BLOCK
    near = np.append(near, np.zeros(length, dtype=np.float32))
    data = np.append(data, np.zeros(length * CELL, dtype=np.uint8))
    place = starts[:, None] + np.arange(length)
    return data.reshape(-1, CELL)[place].reshape(len(starts), -1), near[place]


class Trainer:
    """Steps of Adam on batches of 128 chunks."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in net.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in net.weights.items()}

    def learn(self, chunks: list[np.ndarray], rng: np.random.Generator) -> None:
        """One pass over ``chunks`` (bytes, recurrence, label, weight) in random order."""
        order = rng.permutation(len(chunks[0]))
        for low in range(0, len(order), 128):
            pick, self.step = order[low : low + 128], self.step + 1
            for k, g in self.net.gradients(*(x[pick] for x in chunks)).items():
                self.first[k] += 0.1 * (g - self.first[k])
                self.second[k] += 0.001 * (g * g - self.second[k])
                size = np.sqrt(self.second[k] / (1 - 0.999**self.step)) + 1e-8
                self.net.weights[k] -= self.rate * self.first[k] / (1 - 0.9**self.step) / size


def _buffers(batches: Iterable[pa.RecordBatch], sizes: Training) -> Iterator[list[np.ndarray]]:
    """All chunks of the texts (body, label), about ``shuffled`` at a time."""
    held, count = [], 0
    for step in steps(batches):
        for body, label in zip(step.column("body").to_pylist(), step.column("label").to_pylist()):
            data, near = _chunks(body)
            n = len(near)
            weight = min(1.0, sizes.chunks_a_text / n)
            held.append((data, near, np.full(n, label, np.float32), np.full(n, weight, np.float32)))
            count += n
            if count >= sizes.shuffled:
                yield [np.concatenate(x) for x in zip(*held)]
                held, count = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def train(labelled: DataFrame, sizes: Training = Training()) -> Network | float:
    """A network fitted to all rows of ``labelled`` (doc_id, body, label); the label where all have
    the same, 0.5 without any.  The texts written for it are deleted at its end."""
    with scratch(labelled.sparkSession):
        return _trained(labelled, sizes)


def _trained(labelled: DataFrame, sizes: Training) -> Network | float:
    # Written once, so that counting and dealing do not each join the texts anew.
    labelled = materialize(labelled.select("doc_id", "body", "label"), "labelled-texts")
    found = labelled.agg(
        F.count("*").alias("n"), F.sum("label").alias("ones"), F.sum(F.octet_length("body")).alias("size")
    ).first()
    if not found.n or found.ones in (0, found.n):
        return float(found.ones / found.n) if found.n else 0.5
    parts = -(-found.size // sizes.part_bytes) or 1
    order = F.xxhash64("doc_id", "body")
    dealt = labelled.select("body", "label", order.alias("order")).repartition(parts, "order")
    dealt = materialize(dealt.sortWithinPartitions("order"), "labelled").select("body", "label").coalesce(parts)
    net = Network(sizes, float(np.clip(found.ones / found.n, 0.01, 0.99)))
    for turn in range(sizes.rounds):
        start, rate = net.vector(), sizes.rate * (1 - turn / sizes.rounds)

        def run(batches: Iterable[pa.RecordBatch], start=start, rate=rate, turn=turn) -> Iterator[pa.RecordBatch]:
            own = Network(sizes).load(start)
            trainer, seen, chunks = Trainer(own, rate), 0, None
            rng = np.random.default_rng([sizes.seed, turn, TaskContext.get().partitionId()])
            for chunks in _buffers(batches, sizes):
                trainer.learn(chunks, rng)
                seen += len(chunks[0])
            while chunks is not None and trainer.step * sizes.rounds < sizes.steps:
                trainer.learn(chunks, rng)
            chunks = None
            give_back()
            if seen:
                vector = own.vector().astype(np.float64) * seen
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array(np.arange(len(vector) + 1), pa.int64()), "value": np.append(vector, seen),
                })

        # As decimals, whose sum is the same in any order; as many rows as the network has weights.
        value = F.sum(F.col("value").cast("decimal(38,12)")).cast("double").alias("value")
        sums = dealt.mapInArrow(run, "cell long, value double").groupBy("cell").agg(value).toArrow()
        vector = np.zeros(len(start) + 1)
        vector[sums.column("cell").to_numpy()] = sums.column("value").to_numpy()
        net.load(vector[:-1] / vector[-1])
    return net


def labelled_texts(docs: DataFrame, labels: DataFrame, wanted: F.Column) -> DataFrame:
    """doc_id, body and label of every row of ``docs`` whose key has a label and is ``wanted``.

    A key labelled twice takes its larger label; null labels and keys are ignored.
    The join is of one kind at all sizes, so what it writes grows with the texts.
    """
    picked = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & wanted)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    return as_bytes(docs, "doc_id").join(picked.hint("merge"), "doc_id")


def quality_classifier(
    docs: DataFrame, labels: DataFrame, sizes: Training = Training(), learn: F.Column | None = None,
    carry: bool = False,
) -> DataFrame:
    """doc_id, score and predicted for each row of ``docs`` (doc_id, text).

    The network learns ``labels.quality`` of the rows where ``learn``, a
    condition on doc_id, holds (all by default).  A null or empty text is one
    blank chunk and gets a score like any other.  Without labels the score is
    0.5, with labels of one kind that label.  With ``carry`` a struct ``row`` has
    the whole row, so that filtering needs no join.
    """
    wanted = F.lit(True) if learn is None else learn
    net = train(labelled_texts(docs, labels, wanted), sizes)

    def work(step: pa.RecordBatch) -> dict[str, object]:
        bodies = step.column("body").to_pylist()
        score = np.full(len(bodies), net) if isinstance(net, float) else net.score(bodies)
        kept = {name: step.column(name) for name in step.schema.names if carry or name != "body"}
        return kept | {"score": score, "predicted": pa.array(score >= 0.5).cast(pa.int32())}

    schema = T.StructType([docs.schema["doc_id"]])
    rows = as_bytes(docs, "doc_id")
    if carry:
        # The text goes along once, as the bytes that are scored.
        others = [f for f in docs.schema if f.name != "text"]
        schema = schema.add("row", T.StructType(others)).add("blank", T.BooleanType())
        schema = schema.add("body", T.BinaryType())
        row = F.struct(*[F.col(f.name) for f in others])
        rows = docs.select("doc_id", row.alias("row"), F.col("text").isNull().alias("blank"), "text")
        rows = as_bytes(rows, "doc_id", "row", "blank")
    schema = schema.add("score", T.DoubleType()).add("predicted", T.IntegerType())
    scored = map_steps(rows, work, schema)
    if not carry:
        return scored
    text = F.when(~F.col("blank"), F.col("body").cast("string"))
    whole = [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return scored.select("doc_id", F.struct(*whole).alias("row"), "score", "predicted")


def held_out() -> F.Column:
    return crc32_of_key() % 3 == 1


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality_classifier(docs, labels, learn=~held_out())
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
