from __future__ import annotations

import hashlib

import pytest

from starlane.llm.decontaminate import matches, op3_benchmark_decontamination, proximity
from tests.llm.helpers import ODD_TEXTS, alnum_words, documents

ITEM = "one two three four five six seven eight nine ten eleven twelve"


def plain(text, items):
    words, hit, names = alnum_words(text), set(), set()
    for item, body in items:
        w = alnum_words(body)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    names.add(str(item))
    return sorted(hit), sorted(names)


@pytest.mark.parametrize("limit", [1 << 20, 100])
def test_matches_equal_plain_search(spark, limit):
    texts = [
        *ODD_TEXTS[:-2], ITEM, "x " + ITEM.upper() + "! y", ITEM.replace("six", "sixx"),
        "eight nine ten, eleven one two three Four five six seven eight nine ten eleven",
        "short item here and short  item", "tail one two", "three four five six seven eight nine ten",
        *[ITEM + f" {i}" for i in range(30)], "short item short item", "a b c d e f g h i a",
    ]
    items = [(1, ITEM), (12, ITEM + " one"), (3, "Short item"), (4, ""), (5, None), (None, "x"),
             (1, "a b c d e f g h i a b"), (3, "Short item")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in matches(documents(spark, texts), frame, limit=limit).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        hits, names = plain(text, [x for x in items if x[0] is not None])
        assert (got[i].hits, got[i]["items"]) == (hits, names), text
        assert got[i].n_words == len(alnum_words(text))


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert [r.hits for r in matches(documents(spark, ["a b"]), items).collect()] == [[]]
    assert matches(documents(spark, []), items).count() == 0


def test_proximity(spark):
    texts = ["blue cat sat. red dog", "dog very red", "red x x x x dog", "dog", "red", None]
    items = spark.createDataFrame([(7, "red dog")], "item_id long, text string")
    got = proximity(documents(spark, texts), items, span=3).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.stop) for r in got) == [(0, "7", 3, 5), (1, "7", 0, 3)]


def test_digest_of_items(spark, folder):
    for row in op3_benchmark_decontamination(spark, folder).where("n_items = 0").limit(3).collect():
        assert row.items_sha256 == hashlib.sha256(b"").hexdigest() and not row.contaminated
