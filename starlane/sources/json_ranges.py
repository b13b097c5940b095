"""Records of large JSON files, found by many tasks at once.

An array of records, or an object of records by key, is cut into byte ranges.  A first
pass finds for each range how many quotes it holds and how far brackets rise or fall, for
either answer to "does it begin inside a string?".  Running sums over a file's ranges then
give the true answer and the depth at each start.  In a second pass every task cuts out
the records that open in its range, and reads on to the end of the last one.

Files are UTF-8.  Records are the objects at the depth of records; other values there
(NULL, numbers, texts, arrays) have no columns and give none.  A record that the file's end
cuts off is given as far as it goes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starlane.sources.ranges import RANGE_BYTES, open_file, split_files, task_count

_PIECE = 1 << 20
_BATCH_BYTES = 4 << 20

_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1

_SUMMARY = "path string, length long, start long, quotes long, outside long, inside long, root string"


def _marks(data: np.ndarray, slashes: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Unescaped quotes, brackets, and the backslashes that end ``data``; ``slashes`` stand before it."""
    quotes = np.flatnonzero(data == 34)
    brackets = np.flatnonzero(_STEP[data])
    back = np.flatnonzero(data == 92)
    if not len(back):
        if slashes % 2 and len(quotes) and quotes[0] == 0:
            quotes = quotes[1:]
        return quotes, brackets, 0 if len(data) else slashes
    new_run = np.ones(len(back), bool)
    new_run[1:] = np.diff(back) > 1
    first = np.maximum.accumulate(np.where(new_run, np.arange(len(back)), 0))
    run = np.arange(len(back)) - first + 1
    run[back - (run - 1) == 0] += slashes
    if len(quotes):
        at = np.searchsorted(back, quotes) - 1
        before = np.where((at >= 0) & (back[at] == quotes - 1), run[at], 0)
        before[quotes == 0] = slashes
        quotes = quotes[before % 2 == 0]
    return quotes, brackets, int(run[-1]) if back[-1] == len(data) - 1 else 0


def _slashes_before(source: pa.NativeFile, start: int) -> int:
    """Length of the run of backslashes that ends at ``start``."""
    count, size = 0, 64
    while start - count > 0:
        begin = max(0, start - count - size)
        source.seek(begin)
        text = source.read(start - count - begin)
        found = len(text) - len(text.rstrip(b"\\"))
        count += found
        if found < len(text):
            break
        size = min(2 * size, _PIECE)
    return count


def _pieces(source: pa.NativeFile, path: str, start: int, stop: int, piece: int) -> Iterator[bytes]:
    source.seek(start)
    while start < stop:
        data = source.read(min(piece, stop - start))
        if not data:
            raise OSError(f"{path} became shorter while it was read")
        start += len(data)
        yield data


def _summaries(span: int, piece: int):
    def one(row: dict) -> dict:
        quotes = outside = inside = 0
        root = None
        with open_file(row["path"]) as source:
            slashes = _slashes_before(source, row["start"])
            stop = min(row["start"] + span, row["length"])
            for text in _pieces(source, row["path"], row["start"], stop, piece):
                data = np.frombuffer(text, np.uint8)
                marks, brackets, slashes = _marks(data, slashes)
                # Whether each bracket has an odd number of quotes before it in the range.
                odd = (quotes + np.searchsorted(marks, brackets)) % 2 == 1
                steps = _STEP[data[brackets]].astype(np.int64)
                outside += int(steps[~odd].sum())
                inside += int(steps[odd].sum())
                quotes += len(marks)
                if root is None and len(brackets):
                    root = chr(data[brackets[0]])
        return {**row, "quotes": quotes, "outside": outside, "inside": inside, "root": root}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string())]
            + [(c, pa.int64()) for c in ("length", "start", "quotes", "outside", "inside")]
            + [("root", pa.string())]
        )
        for batch in batches:
            yield pa.RecordBatch.from_pylist([one(r) for r in batch.to_pylist()], schema)

    return run


def _cut(row: dict, span: int, piece: int) -> Iterator[bytes]:
    """The records that open in one range."""
    quoted, depth, base = row["quoted"], row["depth"], row["base"]
    stop = min(row["start"] + span, row["length"])
    open_parts: list[bytes] | None = None
    at = row["start"]
    with open_file(row["path"]) as source:
        slashes = _slashes_before(source, at)
        for text in _pieces(source, row["path"], at, row["length"], piece):
            data = np.frombuffer(text, np.uint8)
            marks, brackets, slashes = _marks(data, slashes)
            brackets = brackets[(quoted + np.searchsorted(marks, brackets)) % 2 == 0]
            quoted = (quoted + len(marks)) % 2
            after = depth + np.cumsum(_STEP[data[brackets]], dtype=np.int64)
            if len(after):
                depth = int(after[-1])
            kinds = data[brackets]
            opens = brackets[(kinds == 123) & (after == base + 1)]
            closes = brackets[(kinds == 125) & (after == base)]
            opens = opens[at + opens < stop]
            begin = 0
            if open_parts is not None:
                if not len(closes):
                    open_parts.append(text)
                    at += len(text)
                    continue
                begin = int(closes[0]) + 1
                yield b"".join([*open_parts, text[:begin]])
                open_parts = None
            # Records do not overlap: each one ends at the first close after it.
            ends = np.searchsorted(closes, opens)
            for first, end in zip(opens.tolist(), ends.tolist()):
                if end == len(closes):
                    open_parts = [text[first:]]
                else:
                    yield text[first : int(closes[end]) + 1]
            at += len(text)
            if open_parts is None and at >= stop:
                return
    if open_parts is not None:
        yield b"".join(open_parts)


def _records(span: int, piece: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(path: str, texts: list[bytes]) -> pa.RecordBatch:
            # Bytes that are no UTF-8 are replaced, as Spark's readers do.
            found = [t.decode("utf-8", "replace") for t in texts]
            return pa.RecordBatch.from_arrays(
                [pa.array([path] * len(found), pa.string()), pa.array(found, pa.string())], ["path", "record"]
            )

        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for text in _cut(row, span, piece):
                    held.append(text)
                    size += len(text)
                    if size >= _BATCH_BYTES:
                        yield packed(row["path"], held)
                        held, size = [], 0
                if held:
                    yield packed(row["path"], held)

    return run


def record_texts(
    found: DataFrame, keyed: bool = False, span: int = RANGE_BYTES, piece: int = _PIECE
) -> DataFrame:
    """path and record: the text of every record of the listed files, whatever their size.

    Without ``keyed`` a file that holds one object holds one record.
    """
    n = task_count(found, span)
    sums = split_files(found, span, n).mapInArrow(_summaries(span, piece), _SUMMARY)
    # One short row for each range of a file.
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    quoted = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2
    risen = sums.withColumns(
        {"quoted": quoted, "root": F.coalesce(F.first("root", ignorenulls=True).over(every), F.lit("["))}
    ).withColumn("rise", F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside")))
    single = F.lit(not keyed) & (F.col("root") == "{")
    placed = risen.select(
        "path",
        "length",
        "start",
        "quoted",
        F.coalesce(F.sum("rise").over(earlier), F.lit(0)).alias("depth"),
        F.when(single, 0).otherwise(1).cast("long").alias("base"),
    )
    return placed.repartition(n, "path", "start").mapInArrow(
        _records(span, piece), "path string, record string"
    )
