"""Periodic runs of words, through Lyndon words found by Baier's grouping.

The first phase of Baier's suffix sorter groups suffixes by a context that grows
until it is the longest Lyndon word at the suffix: a finished group hands its
suffixes to the nearest lower ones before them, whose contexts take it in.  What
is done to a suffix depends on its neighbours in the text alone, so here one
numpy step hands over all suffixes whose context cannot grow any more, instead of
one group after the other.  Lengths under the order of words and under its
inverse are the two Lyndon arrays; each run of exponent two or more has a Lyndon
root of one of them, which is extended to both sides as far as its period holds.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.texts import as_bytes, map_steps, table

# Rounds of the vector form; what is left then is long chains, taken one by one.
ROUNDS = 24
# Words that contexts with equal first words are compared on before bytes are.
LOOK = 4


@dataclass(frozen=True)
class Runs:
    """Which runs count: words in all, and words for each word of the period."""

    least: int = 6
    exponent: int = 4


def _order(words: np.ndarray, packed: bytes, s: np.ndarray, e: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 for context k against context k + 1, for each k of ``pairs``; a prefix is smaller."""
    out = np.sign(words[s[pairs]].astype(np.int64) - words[s[pairs + 1]])
    open_ = np.flatnonzero(out == 0)
    for t in range(1, LOOK):
        if not len(open_):
            return out
        k = pairs[open_]
        a, b = s[k] + t, s[k + 1] + t
        one, two = a >= e[k], b >= e[k + 1]
        x = np.where(one, -1, words[np.minimum(a, len(words) - 1)].astype(np.int64))
        y = np.where(two, -1, words[np.minimum(b, len(words) - 1)].astype(np.int64))
        out[open_] = np.sign(x - y)
        open_ = open_[(x == y) & ~one]
    for p in open_.tolist():
        k = pairs[p]
        x, y = packed[4 * s[k] : 4 * e[k]], packed[4 * s[k + 1] : 4 * e[k + 1]]
        out[p] = (x > y) - (x < y)
    return out


def lyndon(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place of the texts that ``ends`` closes.

    ``words`` are numbers from 0; ``ends`` are the texts' ends, ascending, none empty.
    """
    n = len(words)
    out = np.ones(n, dtype=np.int64)
    if not n:
        return out
    packed = words.astype(">u4").tobytes()
    s = np.arange(n)
    e = s + 1
    last = np.zeros(n, dtype=bool)  # nothing follows in its text
    last[ends - 1] = True
    done = np.zeros(n, dtype=bool)  # the context cannot grow any more
    for _ in range(ROUNDS):
        pairs = np.flatnonzero(~last[:-1] & ~done[:-1]) if len(s) > 1 else np.empty(0, np.int64)
        rank = np.full(len(s), 2, dtype=np.int64)  # of a context against the next one
        rank[pairs] = _order(words, packed, s, e, pairs)
        head = words[s]
        lower = np.zeros(len(s), dtype=bool)  # the next one stays below, however it grows
        lower[:-1] = head[1:] < head[:-1]
        after = np.append(done[1:], False)
        done |= last | lower | (after & (rank >= 0))
        # Equal neighbours are finished when the last of them is.
        chain = np.flatnonzero((rank == 0) & ~done)
        if len(chain):
            breaks = np.flatnonzero(np.diff(chain) > 1)
            stop = np.append(chain[breaks], chain[-1]) + 1
            done[chain] = done[stop[np.searchsorted(stop, chain, "right")]]
        growing = np.flatnonzero(~done)
        if not len(growing):
            break
        # Finished contexts above the nearest unfinished one before them in their text go into it.
        text = np.cumsum(last) - last
        owner = np.searchsorted(growing, np.arange(len(s)), "right") - 1
        owned = done & (owner >= 0)
        owner = growing[np.maximum(owner, 0)]
        owned &= text[owner] == text
        taken = owned & (head > head[owner])
        # The one right after it may have the same first word and be larger all the same.
        tie = growing[done[growing + 1] & (rank[growing] < 0)] + 1
        taken[tie] = True
        # Only a stretch that begins at the owner can go.
        gaps = np.cumsum(~taken)
        taken &= gaps == gaps[owner]
        at = np.flatnonzero(taken)
        out[s[at]] = e[at] - s[at]
        # An owner ends where the last one taken ends, and is the last if that one was.
        e[owner[at]] = e[at]
        last[owner[at]] = last[at]
        keep = ~taken
        # A text whose contexts are all finished has nothing to do.
        busy = np.zeros(int(text[-1]) + 1, dtype=bool)
        busy[text[growing]] = True
        idle = keep & ~busy[text]
        out[s[idle]] = e[idle] - s[idle]
        keep &= busy[text]
        s, e, last, done = s[keep], e[keep], last[keep], done[keep]
    if len(s):
        _finish(packed, s.tolist(), e.tolist(), last.tolist(), out)
    return out


def _finish(packed: bytes, s: list[int], e: list[int], last: list[bool], out: np.ndarray) -> None:
    """From the last context to the first: each takes in what follows while that is larger."""
    waiting: list[tuple[int, int]] = []
    for k in range(len(s) - 1, -1, -1):
        if last[k]:
            waiting = []
        start, stop = s[k], e[k]
        while waiting:
            a, b = waiting[-1]
            # Contexts that differ early, as most do, are told apart without a copy of both.
            x, y = packed[4 * start : 4 * min(stop, start + 8)], packed[4 * a : 4 * min(b, a + 8)]
            if x == y or x.startswith(y) or y.startswith(x):
                x, y = packed[4 * start : 4 * stop], packed[4 * a : 4 * b]
            if x >= y:
                break
            waiting.pop()
            stop = b
        out[start] = stop - start
        waiting.append((start, stop))


def _reach(words: np.ndarray, a: int, b: int, stop: int) -> int:
    """How many places from ``a`` and ``b`` > ``a`` on are equal, before ``stop``."""
    size, length = 0, 16
    while b + size < stop:
        x, y = words[a + size : a + size + length], words[b + size : min(b + size + length, stop)]
        differ = np.flatnonzero(x[: len(y)] != y)
        if len(differ):
            return size + int(differ[0])
        size += len(y)
        length *= 2
    return size


def _back(words: np.ndarray, a: int, b: int, start: int) -> int:
    """How many places before ``a`` and ``b`` > ``a`` are equal, from ``start`` on."""
    size, length = 0, 16
    while a - size > start:
        take = min(length, a - size - start)
        x, y = words[a - size - take : a - size], words[b - size - take : b - size]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return size + take - 1 - int(differ[-1])
        size += take
        length *= 2
    return size


def runs_of(words: np.ndarray, ends: np.ndarray, kind: Runs = Runs()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in the texts that ``ends`` closes, sorted."""
    ends = np.asarray(ends, dtype=np.int64)
    ends = ends[np.diff(ends, prepend=0) > 0]
    n = len(words)
    found: set[tuple[int, int, int]] = set()
    if not n:
        return []
    begins = np.append(0, ends[:-1])
    top = int(words.max())
    for ordered in (words, top - words):
        period = lyndon(ordered, ends)
        # A run of exponent four or more holds at least three whole copies of its Lyndon root,
        # one after the other; of exponent two, one.
        copies = max(kind.exponent - 2, 0)
        at = np.arange(n)
        for _ in range(copies):
            after = at + period[at]
            ok = after < n
            at, after = at[ok], after[ok]
            at = at[(period[after] == period[at]) & (words[after] == words[at])]
        place = {}
        for i in at.tolist():
            p = int(period[i])
            # Later copies of a root lie in the run that its first copy found.
            if i < place.get(p, -1):
                continue
            text = int(np.searchsorted(ends, i, "right"))
            first, stop = int(begins[text]), int(ends[text])
            if i + p > stop:
                continue
            right = _reach(words, i, i + p, stop)
            left = _back(words, i, i + p, first)
            length = left + p + right
            if length >= 2 * p:
                place[p] = i - left + length - p
            if length >= max(kind.least, kind.exponent * p, 2 * p):
                found.add((i - left, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id: object, count: int) -> tuple[int, int] | None:
    """(a, p) where the words from a on are to repeat with period p, for one key in ten."""
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not count:
        return None
    g = h // 10
    a = g % count
    return a, 1 + (count - a) // (3 + g % 8)


def _numbers(lists: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers, equal words alike."""
    known: dict[bytes, int] = {}
    give = known.setdefault
    return np.array([give(w, len(known)) for words in lists for w in words], dtype=np.int64)


def periodic_runs(docs: DataFrame, kind: Runs = Runs(), plant: bool = False) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period) and ``kept`` (words without repetitions
    of a run's first period, joined by one blank) for each row of ``docs`` (doc_id, text).

    Words are what blanks and ASCII white space part.  A null or empty text has no
    words, no runs and an empty ``kept``; repeated rows are taken each on its own;
    other columns are ignored; an empty table gives none.  A text of any length is
    one step.  ``plant`` first makes the words of one key in ten repeat, as
    ``planted`` says.
    """

    def work(step: pa.RecordBatch) -> dict[str, object]:
        lists = [x.split() for x in step.column("body").to_pylist()]
        if plant:
            for k, doc_id in enumerate(step.column("doc_id").to_pylist()):
                if change := planted(doc_id, len(lists[k])):
                    a, p = change
                    head, unit = lists[k][:a], lists[k][a : a + p]
                    more = len(lists[k]) - a
                    lists[k] = head + (unit * (-(-more // p)))[:more]
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        ends = np.cumsum(counts)
        found = runs_of(_numbers(lists), ends, kind)
        mine: list[list[dict[str, int]]] = [[] for _ in lists]
        texts = np.searchsorted(ends, [r[0] for r in found], "right").tolist()
        kept = list(lists)
        for text, (start, length, period) in zip(texts, found):
            start -= int(ends[text] - counts[text])
            mine[text].append({"start": start, "length": length, "period": period})
        for text in set(texts):
            stay = np.ones(len(lists[text]) + 1, dtype=np.int64)
            change = np.zeros(len(lists[text]) + 1, dtype=np.int64)
            for r in mine[text]:
                change[r["start"] + r["period"]] += 1
                change[r["start"] + r["length"]] -= 1
            stay = np.cumsum(change)[:-1] == 0
            kept[text] = [lists[text][i] for i in np.flatnonzero(stay).tolist()]
        return {
            "doc_id": step.column("doc_id"),
            "n_words": pa.array(counts),
            "runs": pa.array(mine, _RUNS),
            "kept": pa.array([b" ".join(x) for x in kept], pa.binary()),
        }

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept binary"
    return map_steps(as_bytes(docs, "doc_id"), work, schema)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def digests(found: DataFrame) -> DataFrame:
    """What ``periodic_runs`` found, as counts, the run of the largest exponent and digests."""
    nothing = F.lit(None).cast(found.schema["runs"].dataType.elementType)
    # Runs are sorted by start and period, so a tie keeps the first.
    best = F.aggregate(
        "runs",
        nothing,
        lambda b, r: F.when(
            b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r
        ).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(table(spark, sf_dir, "documents"), plant=True))
