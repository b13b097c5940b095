from __future__ import annotations

import random

import numpy as np
import pytest

from starlane.llm.components import components
from starlane.llm.jaccard_join import CountTree, Similarity, jaccard_join, regions
from tests.llm.helpers import ODD_TEXTS, documents, plain_words


def sets_of(texts, length):
    out = []
    for text in texts:
        words = [w.encode().lower() for w in plain_words(text)]
        size = min(length, len(words))
        out.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    return out


def plain(texts, length, percent):
    sets = sets_of(texts, length)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and 100 * both >= percent * len(x | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(len(x), root(i)) for i, x in enumerate(sets)]


def near_copies(seed, base_words, copies, most_edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(base_words)]
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, most_edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("how", [Similarity(), Similarity(words=5, percent=80), Similarity(most=8, leaf=2)])
def test_components_equal_all_pairs(spark, how):
    texts = [*ODD_TEXTS, *ODD_TEXTS, "A b c", "a B c", "a b", "b a"]
    for seed, size in enumerate((5, 9, 14, 30, 60, 120, 400)):
        texts += near_copies(seed, size, 14, max(1, size // 25))
    rng = random.Random(99)
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 80))) for _ in range(60)]
    rng.shuffle(texts)
    want = plain(texts, how.words, how.percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(documents(spark, texts), how).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert len({c for _, c in want}) > 60 and sum(c != i for i, (_, c) in enumerate(want)) > 30


def test_linked_sets_share_a_region():
    rng = np.random.default_rng(1)
    for how in (Similarity(), Similarity(percent=80)):
        classes = how.classes(3000)
        for _ in range(1500):
            size = int(rng.integers(1, 120))
            whole = rng.integers(0, 2**63, size, dtype=np.uint64)
            # Few distinct high bits leave many groups empty.
            if rng.random() < 0.5:
                whole = whole >> np.uint64(rng.integers(0, 12))
            x = np.unique(whole)
            drop = int(rng.integers(0, max(1, size // 5) + 1))
            y = np.unique(np.append(x[drop:], rng.integers(0, 2**63, int(rng.integers(0, 4)), dtype=np.uint64)))
            both, either = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if 100 * both >= how.percent * either and not np.array_equal(x, y):
                assert set(regions(x, classes, how).tolist()) & set(regions(y, classes, how).tolist())


def test_tree_loses_no_pair():
    rng = np.random.default_rng(2)
    counts = rng.poisson(2, (200, 32))
    counts[100:] = counts[:100] + (rng.random((100, 32)) < 0.05)
    query, other, bound = CountTree(counts, 4).search(np.arange(200), 85)
    sizes = counts.sum(axis=1)
    want = set()
    for a in range(200):
        overlap = np.minimum(counts[a], counts).sum(axis=1)
        want |= {(a, b) for b in np.flatnonzero(overlap * 185 >= 85 * (sizes[a] + sizes)).tolist()}
    assert set(zip(query.tolist(), other.tolist())) == want


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (5, 5)], "a long, b long")
    got = {r.node: r.comp for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 90: 90, 100: 90}


def test_empty_table_and_null_ids(spark):
    assert jaccard_join(documents(spark, [])).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (3, "A b c d e"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id) for r in jaccard_join(docs).collect() if r.n_shingles)
    assert got == [(0, 3), (3, 3), (4, 3)]


def test_near_copies_with_null_ids_link_as_in_sql(spark):
    import duckdb

    from starlane.llm.oracle import JACCARD

    w = [f"w{k}" for k in range(200)]
    rows = [(4, " ".join(w[100:])), (None, " ".join(w[100:199])), (10, " ".join(w[:90])), (None, " ".join(w[:100])), (11, " ".join(w[10:100]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with duckdb.connect() as database:
        database.register("documents", docs.toArrow())
        want = database.execute(JACCARD).fetchall()
    got = [tuple(r) for r in jaccard_join(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(r[2] for r in got) == [4, 4, 10, 10, 10]


def test_regions_are_not_written(spark, monkeypatch):
    """The regions of all sets, most of what is known of them, go to the shuffle alone."""
    from starlane.llm import jaccard_join as join

    wide, real = [], join.materialize

    def record(df, label):
        wide.extend(f.name for f in df.schema if f.dataType.typeName() == "array")
        return real(df, label)

    monkeypatch.setattr(join, "materialize", record)
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, None), (4, "alone"), (4, "alone")], "doc_id long, text string")
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in join.jaccard_join(docs).collect()}
    assert found == {(1, 37, 1), (2, 38, 1), (3, 0, 3), (4, 1, 4)}
    assert not wide


def test_pairs_are_written_before_sets_are_shuffled(spark, monkeypatch):
    """The shuffle of points behind the pairs is not held while sets are verified."""
    from starlane.llm import jaccard_join as join

    plans, real = [], join.verified

    def record(pairs, spots, how):
        plans.append(pairs._jdf.queryExecution().optimizedPlan().toString())
        return real(pairs, spots, how)

    monkeypatch.setattr(join, "verified", record)
    texts = near_copies(3, 60, 12, 3) + near_copies(4, 30, 12, 2) + ["", "alone in the world"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.jaccard_join(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 4, 85)
    assert len(plans) == 4 and not [x for x in plans[1:] if "MapInArrow" in x]


def test_linked_sets_share_a_region_that_neither_spares():
    """Even if those that both have are left out first."""
    from starlane.llm.jaccard_join import deals

    rng = np.random.default_rng(3)
    linked, spared = 0, 0
    for how in (Similarity(), Similarity(percent=80), Similarity(percent=60)):
        classes = how.classes(3000)
        for turn in range(1000):
            x = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 200)), dtype=np.uint64) >> np.uint64(turn % 12))
            drop = int(rng.integers(0, max(1, len(x) // 4) + 1))
            y = np.unique(np.append(x[drop:], rng.integers(0, 2**63, int(rng.integers(0, 6)), dtype=np.uint64)))
            both, either = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if 100 * both < how.percent * either or np.array_equal(x, y):
                continue
            own = [list(deals(tokens, classes, how)) for tokens in (x, y)]
            shared = set.intersection(*({r for _, _, found in d for r in found.tolist()} for d in own))
            kept = [set(), set()]
            for regions_of, d in zip(kept, own):
                for _, spare, found in d:
                    # Those in both sets come first, which leaves the fewest.
                    regions_of.update(sorted(found.tolist(), key=lambda r: (r not in shared, r))[spare:])
                    spared += min(spare, len(found))
            linked += 1
            assert kept[0] & kept[1]
    assert linked > 900 and spared > 10_000


def test_a_passage_of_all_texts_makes_no_region(spark):
    """Texts with a passage in common, too short to link them, are not all compared with each other."""
    from starlane.llm.jaccard_join import in_regions, shared_regions

    how = Similarity(words=5, percent=80)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [f"{passage} " + " ".join(f"u{i}x{k}" for k in range(200)) for i in range(60)]
    assert shared_regions(in_regions(documents(spark, texts), how)).count() == 0
    texts += [t + " and an end" for t in texts[::10]] + near_copies(8, 120, 8, 3)
    want = plain(texts, how.words, how.percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(documents(spark, texts), how).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_regions_without_a_pair_are_searched_once(spark, monkeypatch):
    from starlane.llm import jaccard_join as join

    searched, real = [], join.candidates

    def record(shared, *rest):
        pairs = real(shared, *rest)
        searched.append(({r.region for r in shared.collect()}, {r.region for r in pairs.collect()}))
        return pairs

    monkeypatch.setattr(join, "candidates", record)
    # Halves in common, so that regions are shared, and near copies of some.
    half = [[" ".join(f"h{g}x{k}" for k in range(120)) for g in range(3)], [" ".join(f"o{i}x{k}" for k in range(60)) for i in range(12)]]
    texts = [f"{half[0][i % 3]} {half[1][i]}" for i in range(12)] + near_copies(11, 90, 10, 4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in join.jaccard_join(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 4, 85)
    assert searched[0][0] and len(searched) == 3
    for (_, found), (again, _) in zip(searched, searched[1:]):
        assert again == found
