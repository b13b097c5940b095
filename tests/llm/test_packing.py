from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starlane.llm import packing
from starlane.llm.packing import Shape, combinations, nonnegative_least_squares, pack, solve
from starlane.llm.subwords import default_vocabulary
from tests.llm.helpers import ODD_TEXTS, documents


def ids_of(text):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(default_vocabulary())
    return [*coder.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts, window):
    whole = {i: ids_of(t) for i, t in enumerate(texts)}
    seen = {i: 0 for i in whole}
    ends = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        ids = whole[r.doc_id]
        assert (r.start, r.doc_tokens) == (seen[r.doc_id], len(ids))
        piece = np.array(ids[r.start : r.start + r.length], dtype="<u4")
        assert len(piece) == r.length > 0 and zlib.crc32(piece.tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
    assert all(seen[i] == len(ids) for i, ids in whole.items())
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(e <= window for e in ends.values())
    return ends


def test_every_id_lies_in_one_place(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["the", "Cat's", "x y", "Straße", "42!", "İz", "<|endoftext|>"],
             k=rng.choice([1, 5, 40, 300, 3000]))) for _ in range(60)]
    texts += [*ODD_TEXTS, *ODD_TEXTS[:4], "á é\nok\tﬁ \x1c z"]
    check(pack(documents(spark, texts)).collect(), texts, 4096)


def test_little_padding_and_small_windows(spark):
    rng = random.Random(6)
    texts = ["the " * rng.randint(1, 400) for _ in range(400)]
    ends = check(pack(documents(spark, texts), Shape(window=256, unit=16)).collect(), texts, 256)
    assert sum(ends.values()) > 0.98 * 256 * len(ends)


def test_empty_table(spark):
    assert pack(documents(spark, [])).count() == 0


def test_solver_uses_each_piece_once():
    rng = random.Random(7)
    for _ in range(20):
        counts = {rng.randint(1, 32): rng.randint(1, 500) for _ in range(rng.randint(0, 20))}
        used = {}
        for pattern, times in solve(counts, 32, 3):
            assert times > 0 and sum(s * n for s, n in pattern.items()) <= 32
            for size, n in pattern.items():
                used[size] = used.get(size, 0) + n * times
        assert used == counts


def test_combinations_fill_the_window():
    found = combinations(12, 3)
    assert len(found) == len(set(found)) == 1 + 6 + 12
    assert all(sum(c) == 12 and list(c) == sorted(c, reverse=True) for c in found)


@pytest.mark.parametrize("seed", range(5))
def test_least_squares_is_optimal(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.random((8, 15)), rng.normal(0.3, 1, 8)
    x = nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope < 1e-6).all() and abs(slope @ x) < 1e-6


def test_words_are_told_apart_once_a_step():
    """Each distinct word of a step is looked up once, and words are those of a plain split."""
    bodies = [b"one two  one", b"", b" \t\n", b"  two\x0b\x0ctwo\r", b"bad \xff\xfe bytes\xc3", "a b  x\x1cy \u0085".encode()]
    words, distinct, which = packing.words_of(pa.array([b"x", *bodies], pa.binary())[1:])
    assert words.tolist() == [len(x.split()) for x in bodies]
    assert [distinct[k] for k in which] == [w for x in bodies for w in x.split()]
    assert len(distinct) == len(set(distinct))
    assert packing.words_of(pa.array([b""], pa.binary()))[1] == []
