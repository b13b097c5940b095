"""Packing: non-negative least squares over shallow combinations of lengths.

Texts are cut into full sequences, a main piece of whole units and a tail below
one unit.  Tails are packed into units and units into sequences by the same
solver: combinations of up to three sizes that fill the window, repeat counts by
non-negative least squares against the histogram, rounded down, and a greedy
fill for what is left.  The solver sees histograms only; which piece goes where
follows from each piece's rank among those of its size.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlane.llm.subwords import default_vocabulary, subwords
from starlane.llm.texts import as_bytes, give_back, steps, table
from starlane.session import materialize

# Bytes of text whose words are held at once.
CUT_BYTES = 2 << 20

Pattern = tuple[dict[int, int], int]  # pieces of each size in a window, and how many windows


@dataclass(frozen=True)
class Shape:
    """Length of a sequence, its units (both powers of two), the id that ends a text, pieces in a combination."""

    window: int = 4096
    unit: int = 64
    end_id: int = 2
    depth: int = 3


def combinations(window: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to fill ``window`` with up to ``depth`` sizes, largest first."""
    out: list[tuple[int, ...]] = [(window,)]
    for count in range(2, depth + 1):
        for first in itertools.combinations_with_replacement(range(1, window), count - 1):
            last = window - sum(first)
            if last >= first[-1]:
                out.append((last, *reversed(first)))
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x >= 0 that brings ``a @ x`` nearest to ``b``, by active sets."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], dtype=bool)
    scale = max(float(np.abs(b).max(initial=0)), 1.0)
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            trial = np.zeros_like(x)
            trial[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (trial <= 1e-12 * scale)
            if not low.any():
                break
            gap = np.where(low, x - trial, 1.0)
            step = np.min(np.where(low, x / np.where(gap > 0, gap, 1.0), np.inf))
            x = x + step * (trial - x)
            active &= x > 1e-12 * scale
            x[~active] = 0
        x = trial
    return x


def solve(counts: dict[int, int], window: int, depth: int) -> list[Pattern]:
    """Patterns that use every piece of ``counts`` (size to number) exactly once."""
    left = np.zeros(window + 1, dtype=np.int64)
    for size, count in counts.items():
        left[size] = count
    options = [c for c in combinations(window, depth) if all(left[s] for s in c)]
    matrix = np.zeros((window + 1, len(options)))
    for column, option in enumerate(options):
        for size in option:
            matrix[size, column] += 1
    repeats = nonnegative_least_squares(matrix, left.astype(float)) if options else []
    patterns: list[Pattern] = []

    def take(used: dict[int, int], times: int) -> None:
        for size, count in used.items():
            left[size] -= count * times
        patterns.append((used, times))

    for option, times in sorted(zip(options, repeats), key=lambda x: -x[1]):
        used = dict(Counter(option))
        times = min([int(times + 1e-6), *(int(left[s] // n) for s, n in used.items())])
        if times:
            take(used, times)
    while left.any():
        used, room = {}, window
        for size in np.flatnonzero(left)[::-1].tolist():
            if size <= room:
                used[size] = min(room // size, int(left[size]))
                room -= used[size] * size
        take(used, min(int(left[s] // n) for s, n in used.items()))
    return patterns


def places(patterns: list[Pattern], first: int = 0) -> list[tuple[int, ...]]:
    """(size, low, high, base, each, slot): ranks low to high of a size go ``each`` to a window
    from window ``base`` on, into slots from ``slot`` on; larger sizes have earlier slots."""
    used: Counter[int] = Counter()
    out = []
    for pattern, times in patterns:
        slot = 0
        for size in sorted(pattern, reverse=True):
            low = used[size]
            used[size] += pattern[size] * times
            out.append((size, low, used[size], first, pattern[size], slot))
            slot += pattern[size]
        first += times
    return out


def words_of(bodies: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """How many white-space-separated words each text has, the distinct ones, and which of them each word is."""
    split = pc.ascii_split_whitespace(bodies.view(pa.string()))
    word = split.flatten()
    real = np.asarray(pc.binary_length(word)) > 0  # blanks at the ends leave empty ones
    ends = np.cumsum(np.asarray(pc.list_value_length(split), dtype=np.int64))
    before = np.concatenate([[0], np.cumsum(real)])
    coded = word.filter(pa.array(real)).dictionary_encode()
    distinct = coded.dictionary.view(pa.binary())
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), b" ")[0].as_py()
    return np.diff(before[ends], prepend=0), joined.split(), np.asarray(coded.indices, dtype=np.int64)


def cut(docs: DataFrame, shape: Shape, vocabulary: str) -> DataFrame:
    """The pieces of each text, each with the task that made it and its rank there by length."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder = subwords(vocabulary)
        seen = np.zeros(shape.window + 1, dtype=np.int64)
        for step in steps(batches, CUT_BYTES):
            words, distinct, which = words_of(step.column("body"))
            found, counts = coder.ids_of(coder.numbers(distinct)[which])
            # Each text's ids, with the end id after them.
            sizes = np.bincount(np.repeat(np.arange(len(words)), words), counts, len(words)).astype(np.int64)
            stops = np.cumsum(sizes)
            ids = np.insert(found.astype("<u4"), stops, shape.end_id)
            sizes += 1
            begins = np.cumsum(sizes) - sizes
            # Full sequences, then whole units, then what is left.
            full, rest = sizes // shape.window, sizes % shape.window
            units, tail = rest - rest % shape.unit, rest % shape.unit
            number = full + (units > 0) + (tail > 0)
            text = np.repeat(np.arange(len(words)), number)
            turn = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
            start = np.minimum(turn, full[text]) * shape.window
            start = np.where(turn > full[text], full[text] * shape.window + units[text], start)
            length = np.where(turn < full[text], shape.window, np.where(units[text] > 0, units[text], tail[text]))
            length = np.where(turn > full[text], tail[text], length)
            raw, low = ids.tobytes(), (4 * (begins[text] + start)).tolist()
            sums = [zlib.crc32(raw[a : a + n]) for a, n in zip(low, (4 * length).tolist())]
            # Ranks among the task's pieces of the same length, those of earlier steps first.
            order = np.argsort(length, kind="stable")
            sorted_ = length[order]
            rank = np.empty(len(length), dtype=np.int64)
            rank[order] = np.arange(len(length)) - np.searchsorted(sorted_, sorted_)
            rank += seen[length]
            seen += np.bincount(length, minlength=len(seen))
            yield pa.RecordBatch.from_pydict({
                "doc_id": step.column("doc_id").take(pa.array(text)),
                "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array(sums, pa.int64()), "doc_tokens": pa.array(sizes[text]),
                "part": pa.array(np.full(len(text), part, dtype=np.int64)), "rank": pa.array(rank),
            })
        give_back()

    schema = f"doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, part long, rank long"
    return as_bytes(docs, "doc_id").mapInArrow(run, schema)


def pack(docs: DataFrame, shape: Shape = Shape(), vocabulary: str | None = None) -> DataFrame:
    """The packed pieces of all rows of ``docs`` (doc_id, text), one row for each piece.

    A null or empty text is its end id alone; repeated rows are packed each on
    its own.  ``offset`` counts the tokens before a piece in its sequence.
    """
    spark = docs.sparkSession
    pieces = materialize(cut(docs, shape, vocabulary or default_vocabulary()), "pieces")
    made = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    made = made.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = pieces.join(made.drop("n"), ["length", "part"]).withColumn(
        "rank", F.col("rank") + F.col("before")
    )
    # One count for each length that pieces can have: fewer than window / unit + unit rows.
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    tails = solve({k: n for k, n in counts.items() if k < shape.unit}, shape.unit, shape.depth)
    units = Counter({k // shape.unit: n for k, n in counts.items() if k >= shape.unit})
    single = units[1]  # pieces of one unit come first by rank, then the units made of tails
    units[1] += sum(times for _, times in tails)
    windows = solve({k: n for k, n in units.items() if n}, shape.window // shape.unit, shape.depth)

    fields = "size long, low long, high long, base long, each long, slot long"
    into_units = F.broadcast(spark.createDataFrame(places(tails, single), fields))
    into_windows = F.broadcast(spark.createDataFrame(places(windows), fields))
    within = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    turn = F.col("rank") - F.col("low")
    small = (
        ranked.where(F.col("length") < shape.unit)
        .join(into_units, (F.col("length") == F.col("size")) & within)
        .withColumn("inner", F.col("slot") + turn % F.col("each"))
        .withColumn("rank", F.col("base") + F.expr("(rank - low) div each"))
        .withColumn("units", F.lit(1).cast("long"))
        .drop("size", "low", "high", "base", "each", "slot")
    )
    large = (
        ranked.where(F.col("length") >= shape.unit)
        .withColumn("inner", F.lit(0).cast("long"))
        .withColumn("units", F.expr(f"length div {shape.unit}"))
    )
    placed = (
        large.unionByName(small)
        .join(into_windows, (F.col("units") == F.col("size")) & within)
        .withColumn("sequence_id", F.col("base") + F.expr("(rank - low) div each"))
        .withColumn("slot", F.col("slot") + turn % F.col("each"))
    )
    ahead = Window.partitionBy("sequence_id").orderBy("slot", "inner")
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
