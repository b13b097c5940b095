"""Aligning the tokens of two tokenizers, window by window.

Both tokenizers read the whole text.  Where a token that begins with a blank starts
in both, the tokens before it end together: these shared ends split a text into
windows of token ids, most of them a word each.  Inside a window, the byte offsets
where tokens of both end cut it into groups.  What a window's ids align to is kept
by the tuple of its ids, so a window that comes again costs one look-up.

A block of texts is one row: the distinct id pairs that its texts link, and which
text links which.  Counts over the corpus meet the pairs of blocks, not those of
single texts.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.texts import as_bytes, steps, table
from starlane.session import materialize

BLOCK_BYTES = 4 << 20
# Words and windows that a task's process keeps; both stores start anew beyond.
KEPT = 250_000
# Pairs whose counts a task holds before it passes them on.
HELD_PAIRS = 1 << 20
# No id: it keeps the two halves of an id tuple apart.
_BETWEEN = b"\xff\xff"
_TOTALS = ("n_a", "n_b", "n_groups", "n_links")

# A blank between two characters that are not white space: no token of either reaches across.
_APART = re.compile(r"(?<=\S) (?=\S)")
# White space other than blanks and line ends.
_RARE = re.compile(r"[^\S \n]")
# Characters of parts that are tokenized at once.
CHUNK = 1 << 16
# Links of a group that are written out one by one; larger groups count their distinct ids first.
SMALL = 256


def _unicode_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others follow from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


def parts_of(text: str) -> list[str]:
    """The text cut at lone blanks, each of which begins the next part's first token."""
    odd = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
    return _APART.split(text) if odd or _RARE.search(text) else text.split(" ")


class ByteTokens:
    """A byte-level tokenizer of a JSON file; its special tokens' strings are plain text.

    ``ranks``, the same vocabulary as a list of ranks, is quicker; it serves parts of
    Latin letters, on whose classes both libraries agree whatever their versions.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.encode_special_tokens = True
        known = _unicode_bytes()
        self.tokens = [b""] * self.coder.get_vocab_size()
        for token, number in self.coder.get_vocab().items():
            if all(c in known for c in token):
                self.tokens[number] = bytes(known[c] for c in token)
        self.quick = None
        if ranks is not None:
            import tiktoken
            from public_tokenizers import PATTERN

            with open(ranks, "rb") as lines:
                order = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=order, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.quick is not None and max(text, default="") < "\u0250":
            return self.quick.encode_ordinary(f" {text}")
        return self.coder.encode(f" {text}", add_special_tokens=False).ids


class PieceTokens:
    """A sentencepiece model with byte pieces, which puts a blank before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = []
        for k in range(self.coder.get_piece_size()):
            piece = self.coder.id_to_piece(k)
            if self.coder.is_byte(k):
                self.tokens.append(bytes([int(piece[3:5], 16)]))
            elif self.coder.is_control(k) or self.coder.is_unknown(k):
                self.tokens.append(b"\0\0\0\0")  # stands for no text, so the check fails
            else:
                self.tokens.append(piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.coder.encode(text)


class Aligner:
    """Two tokenizers, with the windows of parts and the alignments of id tuples met so far."""

    def __init__(self, path_a: str, path_b: str, ranks: str | None = None):
        self.a, self.b = ByteTokens(path_a, ranks), PieceTokens(path_b)
        self.size_a = np.array([len(x) for x in self.a.tokens], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.b.tokens], dtype=np.int64)
        self.blank_a = np.array([x.startswith(b" ") for x in self.a.tokens])
        self.blank_b = np.array([x.startswith(b" ") for x in self.b.tokens])
        self.name_a = [str(k) for k in range(len(self.a.tokens))]
        self.name_b = [str(k) for k in range(len(self.b.tokens))]
        self._forget()

    def _forget(self) -> None:
        # A part's window, or -1 - k where ``several[k]`` has its windows; None if its tokens are not its text.
        self.parts: dict[str, int | None] = {}
        self.several: list[list[int]] = []
        # Of each tuple of ids: its number; by number, tokens of both and groups, groups as text,
        # linked id pairs (distinct, first id << 16 | second), and how often, None where once each.
        self.known: dict[bytes, int] = {}
        self.sizes: list[tuple[int, int, int]] = []
        self.groups: list[str] = []
        self.pairs: list[bytes] = []
        self.times: list[bytes | None] = []

    def learn(self, parts: list[str]) -> None:
        """Tokenize and align the parts that are new."""
        if len(self.parts) > KEPT:
            self._forget()
        new = list(set(parts).difference(self.parts))
        chunk, held = [], 0
        for part in new:
            # Parts that begin or end with white space are parts of a text's edge.
            if not part or part[0].isspace() or part[-1].isspace():
                self._learn([part])
                continue
            chunk.append(part)
            held += len(part)
            if held > CHUNK:
                self._learn(chunk)
                chunk, held = [], 0
        if chunk:
            self._learn(chunk)

    def _learn(self, parts: list[str]) -> None:
        text = " ".join(parts)
        body = b" " + text.encode()
        listed_a, listed_b = self.a.encode(text), self.b.encode(text)
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        whole = (
            b"".join(map(self.a.tokens.__getitem__, listed_a)) == body
            and b"".join(map(self.b.tokens.__getitem__, listed_b)) == body
        )
        if not whole:
            if len(parts) == 1:
                self.parts[parts[0]] = None
            else:
                for part in parts:
                    self._learn([part])
            return
        a, b = np.array(listed_a, dtype="<u2"), np.array(listed_b, dtype="<u2")
        begin_a = np.cumsum(self.size_a[a]) - self.size_a[a]
        begin_b = np.cumsum(self.size_b[b]) - self.size_b[b]
        # Shared ends before a blank: a token of both begins there with one.
        blank_a, blank_b = np.flatnonzero(self.blank_a[a]), np.flatnonzero(self.blank_b[b])
        _, at_a, at_b = np.intersect1d(
            begin_a[blank_a], begin_b[blank_b], assume_unique=True, return_indices=True
        )
        cut_a, cut_b = blank_a[at_a], blank_b[at_b]
        places = begin_a[cut_a]
        first = np.searchsorted(places, ends - np.diff(ends, prepend=0))
        if not np.array_equal(places[np.minimum(first, len(places) - 1)], ends - np.diff(ends, prepend=0)):
            # A token reaches across two parts; alone, each part is a text of its own.
            raise ValueError("tokens reach across a lone blank")
        numbers = self._windows(a, b, begin_a, begin_b, cut_a, cut_b)
        for part, low, high in zip(parts, first.tolist(), [*first[1:].tolist(), len(numbers)]):
            if high == low + 1:
                self.parts[part] = numbers[low]
            else:
                self.several.append(numbers[low:high])
                self.parts[part] = -len(self.several)

    def _windows(self, a, b, begin_a, begin_b, cut_a, cut_b) -> list[int]:
        """Number of each window; those whose id tuples are new are aligned."""
        raw_a, raw_b = a.tobytes(), b.tobytes()
        low_a, low_b = (2 * cut_a).tolist(), (2 * cut_b).tolist()
        keys = [
            raw_a[i:k] + _BETWEEN + raw_b[j:m]
            for i, k, j, m in zip(low_a, [*low_a[1:], len(raw_a)], low_b, [*low_b[1:], len(raw_b)])
        ]
        known, numbers, fresh = self.known, [], []
        for k, key in enumerate(keys):
            number = known.get(key)
            if number is None:
                number = known[key] = len(known)
                fresh.append(k)
            numbers.append(number)
        # Offsets where tokens of both end are those where tokens of both begin.
        _, in_a, in_b = np.intersect1d(begin_a, begin_b, assume_unique=True, return_indices=True)
        m, n = np.diff(np.append(in_a, len(a))), np.diff(np.append(in_b, len(b)))
        group_of = np.searchsorted(in_a, np.append(cut_a, len(a)))  # first group of each window
        window_of = np.repeat(np.arange(len(keys)), np.diff(group_of))
        names_a = list(map(self.name_a.__getitem__, a.tolist()))
        names_b = list(map(self.name_b.__getitem__, b.tolist()))
        texts = [
            f"{names_a[i]}|{names_b[j]}" if x == y == 1
            else f"{','.join(names_a[i : i + x])}|{','.join(names_b[j : j + y])}"
            for i, j, x, y in zip(in_a.tolist(), in_b.tolist(), m.tolist(), n.tolist())
        ]
        owner, code, times = self._links(a, b, in_a, in_b, m, n, window_of)
        ends = np.searchsorted(owner, np.arange(len(keys) + 1)).tolist()
        low = group_of.tolist()
        count_a, count_b = np.diff(np.append(cut_a, len(a))), np.diff(np.append(cut_b, len(b)))
        sizes = list(zip(count_a.tolist(), count_b.tolist(), np.diff(group_of).tolist()))
        self.sizes += [sizes[k] for k in fresh]
        self.groups += [";".join(texts[low[k] : low[k + 1]]) for k in fresh]
        pairs, often = code.astype("<u4").tobytes(), times.astype("<i8").tobytes()
        self.pairs += [pairs[4 * ends[k] : 4 * ends[k + 1]] for k in fresh]
        more = np.add.reduceat(times > 1, ends[:-1]).tolist()
        self.times += [often[8 * ends[k] : 8 * ends[k + 1]] if more[k] else None for k in fresh]
        return numbers

    @staticmethod
    def _links(a, b, in_a, in_b, m, n, window_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (window, id pair), sorted, and how often each is linked."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        small = np.flatnonzero(m * n <= SMALL)
        size = (m * n)[small]
        turn = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        wide = np.repeat(n[small], size)
        code = a[np.repeat(in_a[small], size) + turn // wide] << 16 | b[np.repeat(in_b[small], size) + turn % wide]
        owners, codes, times = [np.repeat(window_of[small], size)], [code], [np.ones(len(code), dtype=np.int64)]
        for g in np.flatnonzero(m * n > SMALL).tolist():
            x, often_x = np.unique(a[in_a[g] : in_a[g] + m[g]], return_counts=True)
            y, often_y = np.unique(b[in_b[g] : in_b[g] + n[g]], return_counts=True)
            codes.append((x[:, None] << 16 | y[None, :]).ravel())
            times.append((often_x[:, None] * often_y[None, :]).ravel())
            owners.append(np.full(len(codes[-1]), window_of[g]))
        return _distinct(np.concatenate(owners), np.concatenate(codes), np.concatenate(times))

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The windows of all texts, and how many each has; none for an empty one and one that its tokens miss."""
        lists = [parts_of(t) if t else [] for t in texts]
        self.learn([p for x in lists for p in x])
        numbers = [list(map(self.parts.__getitem__, x)) for x in lists]
        for k, mine in enumerate(numbers):
            if None in mine:
                numbers[k] = []
        counts = np.array([len(x) for x in numbers], dtype=np.int64)
        flat = np.array([w for x in numbers for w in x], dtype=np.int64)
        if len(flat) and flat.min() < 0:
            many = [self.several[-1 - w] if w < 0 else (w,) for w in flat.tolist()]
            size = np.array([len(x) for x in many], dtype=np.int64)
            counts = np.bincount(np.repeat(np.arange(len(texts)), counts), size, len(texts)).astype(np.int64)
            flat = np.array([w for x in many for w in x], dtype=np.int64)
        return flat, counts


_open: dict[tuple, Aligner] = {}


def aligner(*paths: str | None) -> Aligner:
    """One pair of tokenizers for each process."""
    if paths not in _open:
        _open[paths] = Aligner(*paths)
    return _open[paths]


def _pack(values: np.ndarray, kind: str) -> bytes:
    return pa.compress(np.ascontiguousarray(values.astype(kind)), codec="zstd", asbytes=True)


def _unpack(body: bytes, kind: str, count: int) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(body, size, codec="zstd", asbytes=True), kind) if count else np.empty(0, kind)


def _distinct(major: np.ndarray, minor: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (major, minor), sorted, with their summed times."""
    if not len(major):
        return major, minor, times
    width = int(minor.max()) + 1
    keys, back = np.unique(major * width + minor, return_inverse=True)
    summed = np.zeros(len(keys), dtype=np.int64)
    np.add.at(summed, back, times)
    return keys // width, keys % width, summed


def _block(coder: Aligner, texts: list[str]) -> dict[str, object]:
    """Results for each text, the distinct id pairs of all of them, and which text links which."""
    n = len(texts)
    flat, counts = coder.read(texts)
    text_of = np.repeat(np.arange(n), counts)
    used, place = np.unique(flat, return_inverse=True)
    out: dict[str, object] = {}
    sizes = np.array([coder.sizes[w] for w in used.tolist()], dtype=np.int64).reshape(-1, 3)
    for name, each in zip(_TOTALS, sizes.T):
        out[name] = np.bincount(text_of, each[place], n).astype(np.int64)
    strings, ends = list(map(coder.groups.__getitem__, used.tolist())), np.cumsum(counts).tolist()
    listed = place.tolist()
    out["groups"] = [
        hashlib.sha256(";".join(map(strings.__getitem__, listed[end - count : end])).encode()).hexdigest()
        if count else ""
        for count, end in zip(counts.tolist(), ends)
    ]
    bodies = [coder.pairs[w] for w in used.tolist()]
    codes = np.frombuffer(b"".join(bodies), "<u4")
    sizes = np.array([len(x) // 4 for x in bodies], dtype=np.int64)
    times = np.ones(len(codes), dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    for k, w in enumerate(used.tolist()):
        if coder.times[w] is not None:
            times[first[k] : first[k] + sizes[k]] = np.frombuffer(coder.times[w], "<i8")
    pairs, pair_of = np.unique(codes, return_inverse=True)
    text, window, often = _distinct(text_of, place.astype(np.int64), np.ones(len(place), dtype=np.int64))
    size = sizes[window] if len(window) else np.empty(0, dtype=np.int64)
    at = np.repeat(first[window] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out["text_of"], out["pair_of"], out["times"] = _distinct(
        np.repeat(text, size), pair_of[at].astype(np.int64), times[at] * np.repeat(often, size)
    )
    links = np.zeros(n, dtype=np.int64)
    np.add.at(links, out["text_of"], out["times"])
    return out | {"pairs": pairs.astype(np.int64), "n_links": links}


def blocks_of(docs: DataFrame, paths: tuple[str | None, ...]) -> DataFrame:
    """One row for each block of texts, as ``_block`` has it."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder = aligner(*paths)
        for number, step in enumerate(steps(batches, BLOCK_BYTES)):
            one = _block(coder, [x.decode("utf-8", "replace") for x in step.column("body").to_pylist()])
            per_text = np.bincount(one["text_of"], minlength=step.num_rows)
            held = np.bincount(one["pair_of"], minlength=len(one["pairs"]))
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 32) + number], pa.int64()),
                "doc_ids": pa.array([step.column("doc_id").to_pylist()], pa.list_(step.column("doc_id").type)),
                **{c: pa.array([one[c].tolist()], pa.list_(pa.int64())) for c in _TOTALS},
                "groups": pa.array([one["groups"]], pa.list_(pa.string())),
                "pairs": pa.array([one["pairs"].tolist()], pa.list_(pa.int64())),
                "docs": pa.array([held.tolist()], pa.list_(pa.int64())),
                "size": pa.array([len(one["pair_of"])], pa.int64()),
                # Links of each text; of each link, how many pairs on from the last one, and how often.
                "per_text": pa.array([_pack(per_text, "<u4")], pa.binary()),
                "places": pa.array([_pack(np.diff(one["pair_of"], prepend=0), "<i4")], pa.binary()),
                "times": pa.array([_pack(one["times"], "<i8")], pa.binary()),
            })

    longs = ", ".join(f"{c} array<long>" for c in _TOTALS)
    schema = (
        f"block long, doc_ids array<{key}>, {longs}, groups array<string>, pairs array<long>, "
        "docs array<long>, size long, per_text binary, places binary, times binary"
    )
    return as_bytes(docs, "doc_id").mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, docs (texts of the corpus that link it) and best (whether no pair of its first id has more)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_pairs, held_docs = np.empty(0, np.int64), np.empty(0, np.int64)

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"pair": pa.array(held_pairs), "docs": pa.array(held_docs)})

        for batch in batches:
            for row in range(batch.num_rows):
                pairs = np.asarray(batch.column("pairs")[row].values, dtype=np.int64)
                docs = np.asarray(batch.column("docs")[row].values, dtype=np.int64)
                held_pairs, back = np.unique(np.append(held_pairs, pairs), return_inverse=True)
                summed = np.zeros(len(held_pairs), dtype=np.int64)
                np.add.at(summed, back, np.append(held_docs, docs))
                held_docs = summed
                if len(held_pairs) > HELD_PAIRS:
                    yield given()
                    held_pairs, held_docs = held_pairs[:0], held_docs[:0]
        if len(held_pairs):
            yield given()

    counted = blocks.select("pairs", "docs").mapInArrow(run, "pair long, docs long")
    counted = counted.groupBy("pair").agg(F.sum("docs").alias("docs"))
    counted = materialize(counted.withColumn("a", F.shiftright("pair", 16)), "pair-counts")
    most = counted.groupBy("a").agg(F.max("docs").alias("most"))
    return counted.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, path_a: str, path_b: str, ranks: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for each row
    of ``docs`` (doc_id, text), between the byte-level tokenizer at ``path_a`` (``ranks`` is
    the same vocabulary for the quicker library) and the sentencepiece model at ``path_b``.

    A null or empty text, and one whose joined tokens are not a blank and the text,
    has no tokens: zeros and an empty digest.  An id pair's count is the number of rows
    that link it, repeated rows included; ``n_best`` takes all pairs that share the
    largest count.  Other columns are ignored; an empty table gives none.
    """
    blocks = materialize(blocks_of(docs, (path_a, path_b, ranks)), "alignment-blocks")
    counts = pair_counts(blocks)
    # One row for each pair of a block; the corpus's counts meet these, not the texts' links.
    wanted = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    found = (
        wanted.join(counts, "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("place", "docs", "best")).alias("counts"))
    )
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {c: batch.column(c)[row] for c in batch.schema.names}
                n, size = len(one["doc_ids"]), one["size"].as_py()
                best, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                if size:
                    fields = one["counts"].values
                    docs_of = np.empty(len(fields), dtype=np.int64)
                    best_of = np.empty(len(fields), dtype=np.int64)
                    place = np.asarray(fields.field("place"))
                    docs_of[place] = np.asarray(fields.field("docs"))
                    best_of[place] = fields.field("best").to_numpy(zero_copy_only=False)
                    per_text = _unpack(one["per_text"].as_py(), "<u4", n)
                    pair = np.cumsum(_unpack(one["places"].as_py(), "<i4", size), dtype=np.int64)
                    times = _unpack(one["times"].as_py(), "<i8", size)
                    text = np.repeat(np.arange(n), per_text)
                    np.add.at(best, text, times * best_of[pair])
                    np.add.at(total, text, times * docs_of[pair])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": one["doc_ids"].values,
                    **{c: one[c].values for c in _TOTALS},
                    "n_best": pa.array(best), "count_sum": pa.array(total),
                    "groups_sha256": one["groups"].values,
                })

    schema = (
        f"doc_id {key}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string"
    )
    return blocks.drop("pairs", "docs").join(found, "block", "left").mapInArrow(run, schema)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignments(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
