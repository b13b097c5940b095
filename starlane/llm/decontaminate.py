"""Benchmark decontamination: a positional inverted index, kept as a table of shards.

A shard holds the postings of a few megabytes of texts: its distinct terms (as
64-bit hashes, sorted) and each term's positions.  Phrases are found by taking
the rarest of their terms in the shard, moving its positions back to where the
phrase would start, and keeping those at which every other term stands too.
Test items travel to the shards in blocks of bounded size; texts never move.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.texts import ALNUM, as_bytes, covered, hashes, steps, table
from starlane.session import materialize

SHARD_BYTES = 2 << 20
# Bytes of item texts that one search carries to every shard; more are searched in blocks.
BLOCK_BYTES = 16 << 20


def words_of(body: bytes) -> list[bytes]:
    return body.translate(ALNUM).split()


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text), one row for each shard.

    Positions run through a shard's texts, with one position between two texts
    that holds no term.  ``starts`` has each text's first position, ``n_words``
    its words; ``positions`` are kept as differences.
    """
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, step in enumerate(steps(batches, SHARD_BYTES)):
            texts = [words_of(x) for x in step.column("body").to_pylist()]
            counts = np.array([len(x) for x in texts], dtype=np.int64)
            starts = np.cumsum(counts + 1) - counts - 1
            found = hashes(w for words in texts for w in words)
            place = np.arange(len(found)) + np.repeat(np.arange(len(texts)), counts)
            order = np.argsort(found, kind="stable")
            terms, first = np.unique(found[order], return_index=True)
            moves = np.diff(place[order], prepend=0).astype("<i4")
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([(part << 32) + number], pa.int64()),
                "doc_ids": pa.array([step.column("doc_id").to_pylist()], pa.list_(step.column("doc_id").type)),
                "starts": pa.array([starts.tolist()], pa.list_(pa.int64())),
                "n_words": pa.array([counts.tolist()], pa.list_(pa.int64())),
                "terms": pa.array([terms.astype("<u8").tobytes()], pa.binary()),
                "first": pa.array([np.append(first, len(order)).astype("<i8").tobytes()], pa.binary()),
                "positions": pa.array([moves.tobytes()], pa.binary()),
            })

    schema = (
        f"shard long, doc_ids array<{key}>, starts array<long>, n_words array<long>, "
        "terms binary, first binary, positions binary"
    )
    return materialize(as_bytes(docs, "doc_id").mapInArrow(run, schema), "positional-index")


class Shard:
    """One shard's postings, opened."""

    def __init__(self, terms: bytes, first: bytes, positions: bytes):
        self.terms = np.frombuffer(terms, "<u8")
        self.first = np.frombuffer(first, "<i8")
        self.positions = np.cumsum(np.frombuffer(positions, "<i4"), dtype=np.int64)

    def lists(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each term's postings begin, and how many it has."""
        if not len(self.terms):
            return np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        count = np.where(self.terms[at] == vocabulary, self.first[at + 1] - self.first[at], 0)
        return self.first[at], count

    def phrase(self, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Positions at which the terms with these postings stand one after the other."""
        order = np.argsort(count, kind="stable")
        found = None
        for k in order.tolist():
            held = self.positions[begin[k] : begin[k] + count[k]]
            if found is None:
                found = held - k
            else:
                at = np.minimum(np.searchsorted(held, found + k), len(held) - 1)
                found = found[held[at] == found + k]
            if not len(found):
                break
        return found

    def near(self, begin: np.ndarray, count: np.ndarray, span: int) -> np.ndarray:
        """Starts and ends of runs of at most ``span`` positions that hold all these terms.

        Each run begins at one of the terms and is the shortest from there.
        """
        lists = [self.positions[b : b + c] for b, c in zip(begin, count)]
        rarest = min(lists, key=len)
        starts = []
        for held in lists:
            after = np.searchsorted(rarest, held)
            ahead = rarest[np.minimum(after, len(rarest) - 1)]
            starts.append(held[(ahead >= held) & (ahead - held < span)])
        first = np.unique(np.concatenate(starts))
        last = first.copy()
        for held in lists:
            after = np.searchsorted(held, first)
            ok = after < len(held)
            first, last, after = first[ok], last[ok], after[ok]
            last = np.maximum(last, held[after])
        ok = last - first < span
        return np.stack([first[ok], last[ok] + 1], axis=1)


@dataclass
class Phrases:
    """Distinct runs of words of the items, by their length, over one vocabulary."""

    vocabulary: np.ndarray
    by_length: dict[int, np.ndarray] = field(default_factory=dict)
    items: dict[int, list[list[str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int | None) -> Phrases:
        """All windows of ``window`` words, or with None each item as one phrase.

        An item with fewer words than ``window`` is one phrase; one without words is none.
        """
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, body in items:
            words = words_of(body)
            size = min(window or len(words), len(words))
            for i in range(len(words) - size + 1 if words else 0):
                owners[tuple(words[i : i + size])].add(item)
        terms = sorted({w for phrase in owners for w in phrase})
        coded = hashes(terms)
        order = np.argsort(coded)
        number = {terms[k]: rank for rank, k in enumerate(order.tolist())}
        out = cls(coded[order])
        for size in {len(p) for p in owners}:
            mine = [p for p in owners if len(p) == size]
            out.by_length[size] = np.array([[number[w] for w in p] for p in mine])
            out.items[size] = [sorted(owners[p]) for p in mine]
        return out

    def search(self, shard: Shard, span: int | None = None) -> Iterator[tuple]:
        """(items, start, end) of each match; ``span`` asks for nearness instead of order."""
        begin, count = shard.lists(self.vocabulary)
        for size, phrases in self.by_length.items():
            possible = np.flatnonzero((count[phrases] > 0).all(axis=1))
            for k in possible.tolist():
                terms = phrases[k] if span is None else np.unique(phrases[k])
                if span is None:
                    starts = shard.phrase(begin[terms], count[terms])
                    found = np.stack([starts, starts + size], axis=1)
                else:
                    found = shard.near(begin[terms], count[terms], span)
                if len(found):
                    yield self.items[size][k], found[:, 0], found[:, 1]


def item_blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The items (item_id, text) in blocks of about ``limit`` bytes; null ids are left out."""
    bodies = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item"),
        F.coalesce("text", F.lit("")).cast("binary").alias("body"),
    )
    total = bodies.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    blocks = -(-total // limit)
    for block in range(blocks):
        mine = bodies.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block)
        yield [(r.item, bytes(r.body)) for r in mine.collect()]


def _searched(index: DataFrame, phrases: Phrases | None) -> DataFrame:
    """For every text of the index: its hit words' places, and the items that hit it."""
    key = index.schema["doc_ids"].dataType.elementType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                starts = np.array(one["starts"], dtype=np.int64)
                size = int(starts[-1] + one["n_words"][-1]) + 1
                items: dict[int, set[str]] = defaultdict(set)
                hit = np.zeros(size, dtype=bool)
                if shared.value is not None:
                    shard = Shard(one["terms"], one["first"], one["positions"])
                    begins: dict[int, list[np.ndarray]] = defaultdict(list)
                    for names, begin, end in shared.value.search(shard):
                        begins[int(end[0] - begin[0])].append(begin)
                        for text in np.unique(np.searchsorted(starts, begin, "right") - 1).tolist():
                            items[text].update(names)
                    # All phrases of one length mark their words at once.
                    for length, found in begins.items():
                        hit |= covered(np.concatenate(found), length, size)
                places = np.flatnonzero(hit)
                cuts = np.searchsorted(places, starts)
                hits = [
                    (places[a:b] - s).tolist()
                    for a, b, s in zip(cuts, [*cuts[1:], len(places)], starts)
                ]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([one["shard"]] * len(starts), pa.int64()),
                    "ordinal": pa.array(range(len(starts)), pa.int32()),
                    "doc_id": pa.array(one["doc_ids"], batch.column("doc_ids").type.value_type),
                    "n_words": pa.array(one["n_words"], pa.int64()),
                    "hits": pa.array(hits, pa.list_(pa.int64())),
                    "items": pa.array([sorted(items[k]) for k in range(len(starts))], pa.list_(pa.string())),
                })

    schema = f"shard long, ordinal int, doc_id {key}, n_words long, hits array<long>, items array<string>"
    return index.mapInArrow(run, schema)


def matches(docs: DataFrame, items: DataFrame, window: int = 10, limit: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, ``hits`` (places of words inside any occurrence of an item's
    window of ``window`` words) and ``items`` (their ids as text) for each row of ``docs``.

    Null or empty texts have no words; an item without words, or without an id,
    hits nothing; repeated rows are searched each on its own.
    """
    index = build_index(docs)
    found = [_searched(index, Phrases.of(x, window)) for x in item_blocks(items, limit)]
    if len(found) < 2:
        return found[0] if found else _searched(index, None)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def proximity(docs: DataFrame, items: DataFrame, span: int, limit: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, start and stop (word places, stop exclusive) of every run of at
    most ``span`` words of a text that holds all words of an item, in any order."""
    index = build_index(docs)
    key = docs.schema["doc_id"].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"doc_id {key}, item_id string, start long, stop long")
    for block in item_blocks(items, limit):
        phrases = Phrases.of(block, None)

        def run(batches: Iterable[pa.RecordBatch], phrases: Phrases = phrases) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    one = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                    starts = np.array(one["starts"], dtype=np.int64)
                    ends = starts + np.array(one["n_words"], dtype=np.int64)
                    rows = []
                    shard = Shard(one["terms"], one["first"], one["positions"])
                    for names, begin, end in phrases.search(shard, span):
                        text = np.searchsorted(starts, begin, "right") - 1
                        for t, a, b in zip(text.tolist(), begin.tolist(), end.tolist()):
                            if b <= ends[t]:
                                rows += [(one["doc_ids"][t], n, a - starts[t], b - starts[t]) for n in names]
                    ids, names, first, last = zip(*rows) if rows else ((), (), (), ())
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(ids, batch.column("doc_ids").type.value_type),
                        "item_id": pa.array(names, pa.string()),
                        "start": pa.array(first, pa.int64()), "stop": pa.array(last, pa.int64()),
                    })

        out = out.unionByName(index.mapInArrow(run, out.schema))
    return out


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
