from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from starlane.llm import periodic_runs as runs_module
from starlane.llm.periodic_runs import Runs, digests, lyndon, periodic_runs, runs_of
from tests.llm.helpers import ODD_TEXTS, documents, plain_words


def plain_lyndon(words):
    out = []
    for i in range(len(words)):
        j = i + 1
        while j < len(words) and words[i:] < words[j:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(words, least=6, exponent=4):
    """All maximal stretches of each period, whose smallest period it is."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, exponent * q, 2 * q):
                unit = words[i : i + length]
                if not any(unit[r:] == unit[:-r] for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_texts(rng):
    letters = rng.choice([1, 2, 2, 3, 5])
    texts = []
    for _ in range(rng.randint(1, 5)):
        words = []
        while len(words) < rng.randint(1, 40):
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 5))]
            words += unit * rng.choice([1, 1, 2, 3, 4, 6])
        texts.append(words[: rng.randint(1, 60)])
    return texts


@pytest.mark.parametrize("rounds", [0, 1, 3, 24])
def test_lyndon_arrays_and_runs(monkeypatch, rounds):
    monkeypatch.setattr(runs_module, "ROUNDS", rounds)
    rng = random.Random(rounds)
    for _ in range(300):
        texts = random_texts(rng)
        flat, ends = np.array(sum(texts, [])), np.cumsum([len(t) for t in texts])
        assert lyndon(flat, ends).tolist() == sum(map(plain_lyndon, texts), [])
        for kind in (Runs(), Runs(2, 2), Runs(1, 3)):
            want, begin = [], 0
            for t in texts:
                want += [(s + begin, n, p) for s, n, p in plain_runs(t, kind.least, kind.exponent)]
                begin += len(t)
            assert runs_of(flat, ends, kind) == want


@pytest.mark.parametrize("words", [np.zeros(50_000, int), np.arange(50_000), np.arange(50_000)[::-1],
                                   np.tile(np.arange(3), 20_000)])
def test_long_texts(words):
    found = runs_of(words, np.array([len(words)]))
    period = next((p for p in (1, 3) if (words[p:] == words[:-p]).all()), None)
    assert found == ([] if period is None else [(0, len(words), period)])


def plain(doc_id, text):
    words = plain_words(text)
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_query_like_plain_definition(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("ab c d é f g h".split(), k=rng.randint(0, 90))) for _ in range(150)]
    texts += [" ".join(rng.choices("xy", k=rng.randint(0, 50))) for _ in range(150)]
    texts += [t if t is None or len(t) < 9999 else "word " * 400 for t in ODD_TEXTS]
    docs = documents(spark, texts).unionByName(documents(spark, texts[:5]))
    nulls = documents(spark, texts[5:8]).selectExpr("CAST(null AS long) AS doc_id", "* EXCEPT (doc_id)")
    found = digests(periodic_runs(docs.unionByName(nulls), plant=True)).collect()
    want = [plain(i, t) for i, t in [*enumerate(texts), *enumerate(texts[:5]), *((None, t) for t in texts[5:8])]]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert sum(w[1] > 0 for w in want) > 20


def test_clashing_columns_and_empty_table(spark):
    clash = documents(spark, ["a b " * 9]).selectExpr("*", "1 AS runs", "2 AS kept", "3 AS n_words", "4 AS start")
    row = periodic_runs(clash).first()
    assert [tuple(r) for r in row.runs] == [(0, 18, 2)] and bytes(row.kept) == b"a b"
    assert digests(periodic_runs(documents(spark, []))).count() == 0
