from __future__ import annotations

import itertools

from starlane.llm.quality_rules import LineField, quality_rules, viterbi
from tests.llm.helpers import ODD_TEXTS, documents, plain_words


def plain(text):
    words = plain_words(text)
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    hit = set()
    grams = {}
    for i in range(len(words) - 7):
        grams.setdefault(tuple(words[i : i + 8]), []).append(i)
    for starts in grams.values():
        if len(starts) > 1:
            hit.update(i + k for i in starts for k in range(8))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(hit),
        len(words) < 20 or 100 * len(hit) > 30 * len(words),
    )


def test_counts_match_their_definition(spark):
    texts = [*ODD_TEXTS, "# * a|b <c>\n" * 5, *ODD_TEXTS[:3]]
    got = quality_rules(documents(spark, texts)).collect()
    assert len(got) == len(texts)
    for row in got:
        assert (*row[1:6], row.base_failed) == plain(texts[row.doc_id])
        assert not (row.base_failed and row.kept)


def test_empty_table(spark):
    assert quality_rules(documents(spark, [])).count() == 0


def test_viterbi_finds_the_best_chain():
    for scores in itertools.product((-1.5, 0.2, 0.4, 2.0), repeat=5):
        def total(labels):
            same = sum(a == b for a, b in zip(labels, labels[1:]))
            return sum(s for s, on in zip(scores, labels) if on) + 0.5 * same

        best = max(total(x) for x in itertools.product((False, True), repeat=5))
        # The first label has no neighbour before it; entering it from its own side gains alike.
        assert abs(total(viterbi(list(scores), 0.5)) - best) < 1e-9


def test_boilerplate_goes_and_prose_stays(spark):
    prose = " ".join(f"word{i} and" for i in range(60)) + ".\n"
    menu = " | ".join(f"Entry{i}" for i in range(80))
    shout = "\n".join(" ".join(f"WORD{i}{k}!!" for i in range(9)) for k in range(9))
    symbols = " ".join(f"word{i}$$$" for i in range(60))
    docs = documents(spark, [prose, menu, shout, symbols, prose + menu[:40]])
    kept = {r.doc_id: r.kept for r in quality_rules(docs, LineField()).collect()}
    assert kept == {0: True, 1: False, 2: False, 3: False, 4: True}
