"""Whole texts inside Arrow tasks: bounded batches, word hashes, rolling windows.

Texts travel as UTF-8 bytes, so splitting and lower-casing touch ASCII only, as
the word definitions of the operators ask for.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of text that one step of a task holds; a longer text is a step of its own.
STEP_BYTES = 4 << 20

# Everything but digits, lower-case letters and non-ASCII becomes a blank.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(docs: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and ``body``, the text's UTF-8 bytes; a null text is empty."""
    return docs.select(
        *[F.col(k) for k in keys], F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")
    )


def crc32_of_key(column: str = "doc_id") -> F.Column:
    """crc32 of the key as text; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def steps(batches: Iterable[pa.RecordBatch], limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of ``body`` at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(batch.column("body")), dtype=np.int64)
        first, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        yield batch.slice(first)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system, which a worker would else hold until its next task."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def map_steps(
    docs: DataFrame, work: Callable[[pa.RecordBatch], dict[str, object]], schema: str | T.StructType
) -> DataFrame:
    """Apply ``work`` to bounded batches of ``docs``; it returns the columns of ``schema``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            yield pa.RecordBatch.from_pydict(work(step))
        give_back()

    return docs.mapInArrow(run, schema)


def hashes(words: Iterable[bytes]) -> np.ndarray:
    """One 64-bit hash for each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype="<u8")


def rolling(word_hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive words, order included."""
    count = len(word_hashes) - length + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    mixed = np.zeros(count, dtype=np.uint64)
    for k in range(length):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += word_hashes[k : k + count]
        mixed ^= mixed >> np.uint64(29)
    return mixed


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a run of ``length`` from one of ``starts``."""
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, size), -1)
    return np.cumsum(change[:-1]) > 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, wanted: F.Column, rows: int, most_bytes: int
) -> DataFrame:
    """At most ``rows`` labelled texts, picked by a hash of their key: doc_id, body, label.

    ``wanted`` is a condition on doc_id.  Texts of more than ``most_bytes`` are
    left out of the sample, so that its size is bounded.  A key labelled twice
    takes its larger label; null labels and keys are ignored.
    """
    picked = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & wanted)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    bodies = as_bytes(docs, "doc_id").where(F.octet_length("body") <= most_bytes)
    return bodies.join(F.broadcast(picked), "doc_id").limit(2 * rows)
