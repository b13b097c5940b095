from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from starlane.llm import alignment
from starlane.llm.alignment import Aligner, alignments
from tests.llm.helpers import ODD_TEXTS, documents

PATHS = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")]
MARKS = ["the", "Cat's", "don't", "naïve", "\n", "\n\n", "  ", "\t", "日本語", "🙂👍🏽", "x" * 300, "1234567", "é",
         "<|endoftext|>", "<s>", " ", "　", "\r\n", "Ελλάς", "\x00", "ﬁ", "नमस्ते", "-----", "' '"]


@pytest.fixture(scope="module")
def coder():
    return Aligner(*PATHS)


def tokens(coder, text):
    """Both tokenizers on the whole text: ids and their bytes."""
    a = coder.a.coder.encode(" " + text, add_special_tokens=False).ids
    b = coder.b.coder.encode(text)
    return [(i, coder.a.tokens[i]) for i in a], [(i, coder.b.tokens[i]) for i in b]


def plain(coder, texts):
    rows, counts = [], Counter()
    for text in texts:
        groups, links = [], Counter()
        a, b = tokens(coder, text) if text else ([], [])
        body = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != body or b"".join(x for _, x in b) != body:
            rows.append((0, 0, 0, links, ""))
            continue

        def ends(side):
            out, at = [], 0
            for _, x in side:
                at += len(x)
                out.append(at)
            return out

        ends_a, ends_b = ends(a), ends(b)
        cuts, i, j = sorted(set(ends_a) & set(ends_b)), 0, 0
        for cut in cuts:
            k, m = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            mine, other = [x for x, _ in a[i:k]], [x for x, _ in b[j:m]]
            groups.append(",".join(map(str, mine)) + "|" + ",".join(map(str, other)))
            links.update((x, y) for x in mine for y in other)
            i, j = k, m
        counts.update(links.keys())
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [
        (a, b, g, sum(links.values()), sum(n for p, n in links.items() if counts[p] == most[p[0]]),
         sum(n * counts[p] for p, n in links.items()), digest)
        for a, b, g, links, digest in rows
    ]


def some_texts(rng, count):
    words = [*MARKS, "le", "étretion", "and", "thorreou.", "Queux,", "of", "a", "b"]
    return [rng.choice([" ", "", " ", "\n"]).join(rng.choices(words, k=rng.randint(1, 25))) for _ in range(count)]


@pytest.mark.parametrize("limit", [200, 4 << 20])
def test_like_whole_tokenisation(spark, coder, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", limit)
    texts = some_texts(random.Random(limit), 150)
    texts += [t if t is None or len(t) < 9999 else "word " * 500 for t in ODD_TEXTS]
    texts += ["▁x", "a ▁ b", " ", "  ", "\n", " lead", "trail ", "a  b", *texts[:4], *texts[:2]]
    found = alignments(documents(spark, texts), *PATHS).orderBy("doc_id").collect()
    want = plain(coder, texts)
    assert [tuple(r)[1:] for r in found] == want
    assert sum(w[0] > 0 for w in want) > 100 and sum(w[6] == "" for w in want) >= 4


def test_nothing_hangs_on_stores(coder, monkeypatch):
    """Stores that are cleared all the time, tiny chunks, every group counted by distinct ids."""
    monkeypatch.setattr(alignment, "KEPT", 1)
    monkeypatch.setattr(alignment, "CHUNK", 1)
    monkeypatch.setattr(alignment, "SMALL", 0)
    texts = some_texts(random.Random(2), 60)
    small = Aligner(*PATHS)
    want = plain(coder, texts)
    for text, row in zip(texts, plain(coder, texts)):
        one = alignment._block(small, [text])
        assert (one["n_a"][0], one["n_b"][0], one["n_groups"][0], one["n_links"][0], one["groups"][0]) == (*row[:4], row[6])
    assert want


def test_ranks_and_file_agree(coder):
    rng = random.Random(3)
    letters = "".join(map(chr, range(0x20, 0x250))) + " \n\t'"
    for _ in range(300):
        text = "".join(rng.choices(letters, k=60)) + rng.choice(["'s", "'ll ", "  ", "\n \n"])
        assert coder.a.encode(text) == coder.a.coder.encode(" " + text, add_special_tokens=False).ids


def test_repeated_null_and_clashing(spark, coder):
    docs = documents(spark, ["the cat", "the cat", None]).selectExpr(
        "CAST(null AS long) AS doc_id", "* EXCEPT (doc_id)", "1 AS pairs", "2 AS counts", "3 AS n_a")
    found = alignments(docs, *PATHS).collect()
    assert sorted(tuple(r)[1:] for r in found) == sorted(plain(coder, ["the cat", "the cat", None]))
    assert alignments(documents(spark, []), *PATHS).count() == 0
