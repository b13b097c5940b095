"""Quality rules: a linear-chain conditional random field over a text's lines.

Each line with a word is labelled content or boilerplate by Viterbi decoding;
the share of words on content lines decides whether a document is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starlane.llm.texts import as_bytes, covered, hashes, map_steps, rolling, table

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


@dataclass(frozen=True)
class LineField:
    """Weights of the field: what speaks for boilerplate, and for a change of label.

    A line's score for boilerplate against content is ``bias`` plus weight times
    feature: its share of symbols, of capitals among the letters, of exclamation
    marks to words, of menu bars among the words, of words that repeat the one
    before, of words in repeated windows, and whether an earlier line equals it.  ``stay`` is gained when two neighbours share a label.
    """

    bias: float = -2.0
    symbols: float = 18.0
    capitals: float = 4.0
    shouts: float = 3.0
    bars: float = 12.0
    stutters: float = 6.0
    repeated: float = 2.5
    earlier: float = 1.5
    stay: float = 0.5
    content_share: float = 0.5

    def emission(self, line: bytes, words: list[bytes], again: float, seen: bool) -> float:
        size = len(line)
        letters = size - len(line.translate(None, _LETTERS))
        capitals = size - len(line.translate(None, _UPPER)) if len(words) > 2 else 0
        return (
            self.bias
            + self.symbols * (size - len(line.translate(None, _SYMBOLS))) / size
            + self.capitals * capitals / max(letters, 1)
            + self.shouts * min(line.count(b"!") / len(words), 1.0)
            + self.bars * words.count(b"|") / len(words)
            + self.stutters * sum(map(eq, words, words[1:])) / len(words)
            + self.repeated * again
            + self.earlier * seen
        )


def viterbi(emissions: list[float], stay: float) -> list[bool]:
    """The likeliest labels of a chain, True for boilerplate; content wins ties."""
    content, boiler = 0.0, 0.0
    back: list[tuple[bool, bool]] = []
    for score in emissions:
        to_content = boiler > content + stay
        to_boiler = boiler + stay > content
        back.append((to_content, to_boiler))
        content, boiler = (
            boiler if to_content else content + stay,
            (boiler + stay if to_boiler else content) + score,
        )
    labels, now = [], boiler > content
    for to_content, to_boiler in reversed(back):
        labels.append(now)
        now = to_boiler if now else to_content
    return labels[::-1]


def label_lines(body: bytes, field: LineField) -> dict[str, object]:
    """Counts of one text, and how many of its words stand on content lines."""
    spaces = len(body) - len(body.translate(None, _SPACE))
    points = len(body) - np.count_nonzero((np.frombuffer(body, np.uint8) & 0xC0) == 0x80)
    lines = [(x, x.split()) for x in body.split(b"\n")]
    lines = [(x, own) for x, own in lines if own]
    words = hashes(body.split())
    again = np.zeros(len(words), dtype=bool)
    windows = rolling(words, 8)
    if len(windows) > 1:
        _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[place] > 1)
        if len(starts):
            again = covered(starts, 8, len(words))
    known: set[bytes] = set()
    emissions, at = [], 0
    repeats = np.concatenate(([0], np.cumsum(again)))
    for line, own in lines:
        n = len(own)
        share = float(repeats[at + n] - repeats[at]) / n
        emissions.append(field.emission(line, own, share, line in known))
        known.add(line)
        at += n
    labels = viterbi(emissions, field.stay)
    return {
        "n_words": len(words),
        "word_chars": int(points) - spaces,
        "n_symbols": len(body) - len(body.translate(None, _SYMBOLS)),
        "n_dup_lines": len(lines) - len(known),
        "n_repeat_words": int(repeats[-1]),
        "n_lines": len(lines),
        "n_content_lines": len(lines) - sum(labels),
        "content_words": sum(len(own) for (_, own), boiler in zip(lines, labels) if not boiler),
    }


_COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_content_lines", "content_words",
)


def quality_rules(docs: DataFrame, field: LineField = LineField()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    Counts, ``base_failed`` (under 20 words, or over 30 % of them in repeated
    8-word windows) and ``kept``: not failed, and at least ``content_share`` of
    the words on content lines.  A null or empty text has no words and fails.
    Rows with equal or null doc_id are judged each on its own.
    """

    def work(step: pa.RecordBatch) -> dict[str, object]:
        found = [label_lines(x, field) for x in step.column("body").to_pylist()]
        out: dict[str, object] = {"doc_id": step.column("doc_id")}
        for name in _COUNTS:
            out[name] = pa.array([x[name] for x in found], pa.int64())
        failed = [x["n_words"] < 20 or 100 * x["n_repeat_words"] > 30 * x["n_words"] for x in found]
        out["base_failed"] = failed
        out["kept"] = [
            not bad and x["content_words"] >= field.content_share * x["n_words"]
            for bad, x in zip(failed, found)
        ]
        return out

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {key}", *(f"{c} long" for c in _COUNTS)])
    return map_steps(as_bytes(docs, "doc_id"), work, schema + ", base_failed boolean, kept boolean")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
