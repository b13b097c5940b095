from __future__ import annotations

import random

from starlane.llm.licenses import NOTICES, PHRASES, op5_license_scan, scan
from tests.llm.helpers import ODD_TEXTS, alnum_words, documents


def plain(text):
    words, found = alnum_words(text), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(found)


def test_places_are_those_of_the_phrases(spark):
    rng = random.Random(1)
    parts = ["MIT", "license", "License.", "apache", "general", "public", "Kelvin K", "lİcense",
             "mİt", "é", "mit-license", "General Public License", "x"]
    texts = [*ODD_TEXTS, "MIT License", "license", "mit", "the mit\nlicense mit license", "mİt license",
             "public license general", "apachelicense"]
    texts += [" ".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(150)]
    got = {r.doc_id: r for r in scan(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert (got[i].n_words, [tuple(p) for p in got[i].places]) == plain(text), text


def test_notices_survive_small_changes(spark):
    rng = random.Random(2)
    filler = [f"word{i}" for i in range(300)]
    texts, truth = [], []
    for notice, label in NOTICES.items():
        for change in (False, True):
            words = notice.split()
            if change and len(words) > 9:
                words.insert(len(words) // 2, "added")
            texts.append(" ".join([*rng.sample(filler, 40), *words, *rng.sample(filler, 40)]))
            truth.append(label)
    texts += [" ".join(rng.choices(filler + ["of", "the", "license", "under", "in", "and"], k=400)) for _ in range(40)]
    got = {r.doc_id: r for r in scan(documents(spark, texts)).collect()}
    for i, label in enumerate(truth):
        assert label in {p.label for p in got[i].passages}, texts[i]
        best = max(got[i].passages, key=lambda p: p.share)
        assert best.first == 40 and got[i].score >= 0.75
    assert not any(got[i].passages for i in range(len(truth), len(texts)))


def test_best_verified_notice_wins(spark):
    own = {"CC BY-NC 4.0": "cc-by-nc", "CC BY-SA 4.0": "cc-by-sa", "CC BY 4.0": "cc-by"}
    texts = [f"Some words. Licensed under {name}. More words follow" for name in own] * 2
    texts.append(" ".join(f"Licensed under {name}." for name in own))
    got = {r.doc_id: r for r in scan(documents(spark, texts)).collect()}
    for i, label in enumerate([*own.values()] * 2):
        (passage,) = got[i].passages
        size = 6 + (label != "cc-by")
        assert tuple(passage) == (label, 2, 1 + size, 1.0) and got[i].score == 1
    assert {p.label: p.first for p in got[6].passages} == {"cc-by-nc": 0, "cc-by-sa": 7, "cc-by": 14}


def test_votes_without_the_words_in_order_are_no_passage(spark):
    # All pairs of the notice, on diagonals two apart, but four words of twelve are too many.
    notice = "a b c d e f g h".split()
    swapped = "a b c x c d e f y f g h".split()
    texts = [" ".join(notice), " ".join(swapped)]
    got = {r.doc_id: r for r in scan(documents(spark, texts), {}, {" ".join(notice): "n"}).collect()}
    assert [p.share for p in got[0].passages] == [1.0] and not got[1].passages


def test_empty_table(spark):
    assert scan(documents(spark, [])).count() == 0


def test_query_joins_labels(spark, folder):
    rows = op5_license_scan(spark, folder).collect()
    assert {r.base_labels for r in rows} >= {"", "mit"}
    for r in rows:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert (r.n_base == 0) == (r.first_word is None) and 0 <= r.score <= 1
