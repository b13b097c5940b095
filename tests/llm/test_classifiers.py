from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starlane.llm import quality_classifier as quality
from starlane.llm import toxicity as toxic
from tests.llm.helpers import ODD_TEXTS, documents

WORDS = [a + b for a in ("ba", "ko", "li", "mu", "ne") for b in ("ra", "st", "vi", "x", "do", "pe")]


def made(kind, count, seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        words = rng.choices(WORDS, k=rng.randint(30, 200))
        if kind == "symbols":
            words = [w + "$#" for w in words]
        if kind == "toxic":
            words[rng.randrange(30)] = "idiotic"
        texts.append(" ".join(words))
    return texts


def labels(spark, name, values):
    return spark.createDataFrame(list(enumerate(values)), f"doc_id long, {name} long")


def test_quality_learns_and_scores_whole_texts(spark):
    texts = made("clean", 150, 1) + made("symbols", 150, 2)
    truth = [1] * 150 + [0] * 150
    known = labels(spark, "quality", truth).where("doc_id % 3 != 1")
    got = quality.quality_classifier(documents(spark, texts), known).collect()
    held = [r for r in got if r.doc_id % 3 == 1]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_quality_learns_from_texts_of_any_length(spark):
    long = [" ".join(made(kind, 90, seed)) for seed in (3, 4, 5, 6) for kind in ("clean", "symbols")]
    assert min(map(len, long)) > 32768
    texts = long + made("clean", 40, 7) + made("symbols", 40, 8)
    got = quality.quality_classifier(documents(spark, texts), labels(spark, "quality", [1, 0] * 4)).collect()
    truth = [1, 0] * 4 + [1] * 40 + [0] * 40
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.9


def test_quality_is_learned_from_every_text_in_any_parts(spark):
    texts = made("clean", 80, 1) + made("symbols", 80, 2)
    known = labels(spark, "quality", [1] * 80 + [0] * 80)
    sizes = quality.Training(part_bytes=20000, shuffled=64, steps=300)
    got = quality.quality_classifier(documents(spark, texts), known, sizes).collect()
    assert np.mean([r.predicted == (r.doc_id < 80) for r in got]) > 0.95
    every = quality.labelled_texts(documents(spark, texts), known, F.lit(True))
    chunks = sum(len(quality._chunks(t.encode())[0]) for t in texts)
    rows = every.select("body", "label").toArrow().to_batches()
    assert sum(len(x[0]) for x in quality._buffers(rows, sizes)) == chunks


def test_gradients_of_the_network():
    sizes = quality.Training(embedding=3, filters=4, hidden=3)
    net = quality.Network(sizes)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, (5, 4 * 9), dtype=np.uint8)
    near = rng.random((5, 9)).astype(np.float32)
    truth = np.array([0.0, 1, 1, 0, 1])

    def loss():
        cells = net.cells(data.ravel(), near.ravel())
        out = np.zeros((len(cells), 4))
        out[:-1] = net.filtered(cells)
        z = net.logits(out.reshape(5, 9, 4)[:, :-1].max(axis=1))
        return float(np.mean(np.log1p(np.exp(z)) - truth * z))

    slopes = net.gradients(data, near, truth)
    for name, value in net.weights.items():
        flat = value.reshape(-1)
        for k in rng.integers(0, flat.size, 4):
            if name == "bytes" and not slopes[name].reshape(-1)[k]:
                continue
            kept = flat[k]
            flat[k] = kept + 1e-3
            up = loss()
            flat[k] = kept - 1e-3
            down = loss()
            flat[k] = kept
            assert slopes[name].reshape(-1)[k] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def test_a_text_scores_alike_in_any_company():
    net = quality.Network(quality.Training())
    bodies = [(t or "").encode() for t in ODD_TEXTS] + [b"x" * n for n in (59, 60, 61, 511, 512, 5000)]
    together = net.score(bodies)
    assert np.allclose(together, [net.score([b])[0] for b in bodies], atol=1e-5)


def test_toxicity_learns_from_rare_words(spark):
    texts = made("clean", 200, 3) + made("toxic", 100, 4)
    truth = [0] * 200 + [1] * 100
    known = labels(spark, "toxic", truth).where("doc_id % 3 != 1")
    got = toxic.toxicity(documents(spark, texts), known).collect()
    held = [r for r in got if r.doc_id % 3 == 1]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def fitted_toxicity():
    texts = made("clean", 200, 5) + made("toxic", 100, 6)
    return toxic.train([(t.encode(), int(i >= 200)) for i, t in enumerate(texts)])


def plain_margin(model, body, sizes):
    """Sets of hashed runs passage by passage, weights summed one by one."""
    weight = dict(zip(model.used.tolist(), model.weight.tolist()))
    orders = [x.tolist() for x in toxic.grams(body, sizes)]
    half = sizes.passage // 2
    length = max(map(len, orders), default=0)
    starts = [0] if length <= sizes.passage else range(0, length - half, half)
    stop = length + 1 if length <= sizes.passage else sizes.passage
    sums = [sum(weight.get(h, 0.0) for h in {h for o in orders for h in o[a : a + stop]}) for a in starts]
    return model.bias + max(sums)


def test_toxicity_equals_plain_sets():
    model, sizes = fitted_toxicity(), toxic.Training(passage=256)
    assert len(model.used)
    bodies = [(t or "").encode() for t in [*ODD_TEXTS, *made("clean", 9, 7), *made("toxic", 9, 8)]]
    for body in bodies:
        assert model.margin(body, sizes) == pytest.approx(plain_margin(model, body, sizes))


def test_counts_of_runs_equal_plain_counts():
    texts = made("clean", 30, 9) + made("toxic", 20, 10)
    sizes = toxic.Training()
    used, counts = toxic.counted([(t.encode(), int(i >= 30)) for i, t in enumerate(texts)], sizes)
    plain = {}
    for i, text in enumerate(texts):
        for h in {h for o in toxic.grams(text.encode(), sizes) for h in o.tolist()}:
            plain.setdefault(h, [0, 0])[i >= 30] += 1
    plain = {h: c for h, c in plain.items() if sum(c) >= sizes.least}
    assert dict(zip(used.tolist(), map(list, counts.T.astype(int).tolist()))) == plain


def test_toxicity_does_not_depend_on_length():
    model, sizes = fitted_toxicity(), toxic.Training()
    long = " ".join(made("clean", 8000, 11)).encode()
    assert len(long) > 4 << 20
    for size in (16 << 10, 1 << 20, 4 << 20):
        clean = long[:size]
        assert model.margin(clean, sizes) < 0
        insulted = clean[: size // 2] + b" idiotic " + clean[size // 2 :]
        assert model.margin(insulted, sizes) > 0
    assert model.margin(long[:3000], sizes) == model.margin(long[:3000].upper(), sizes)


@pytest.mark.parametrize(
    "run", [lambda d, k: quality.quality_classifier(d, k), lambda d, k: toxic.toxicity(d, k)]
)
def test_odd_texts_and_missing_labels(spark, run):
    docs = documents(spark, [*ODD_TEXTS, *ODD_TEXTS])
    schema = "doc_id long, quality long, toxic long"
    none = run(docs, spark.createDataFrame([], schema)).collect()
    assert {r.score for r in none} == {0.5} and len(none) == 2 * len(ODD_TEXTS)
    one = run(docs, spark.createDataFrame([(8, 0, 0), (3, 0, 0), (None, 1, 1), (2, None, None)], schema))
    assert {r.score for r in one.collect()} == {0.0}
    both = spark.createDataFrame([(8, 1, 1), (5, 0, 0), (7, 0, 0), (7, 0, 0)], schema)
    scores = {r.doc_id: r.score for r in run(docs, both).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert scores[0] == scores[1]
    assert run(documents(spark, []), both).count() == 0


def test_labelled_texts_are_joined_once(spark, monkeypatch):
    """What learning writes to disk grows with the texts: one join of one kind, however few the labels."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    found = quality.labelled_texts(docs, labels, F.lit(True))
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    written, real = [], quality.materialize

    def record(df, label):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(quality, "materialize", record)
    quality.train(found, quality.Training(rounds=1, steps=1))
    assert ["SortMergeJoin" in plan for plan in written] == [True, False]


def test_texts_are_scored_in_slices(monkeypatch):
    """Filters of a step's texts are not all held at once; scores are those of each text alone."""
    from starlane.llm.quality_classifier import SLICE, Network, Training, cells_of

    rng = np.random.default_rng(4)
    texts = [rng.integers(32, 127, n, dtype=np.uint8).tobytes() for n in (0, 1, 63, 64, 65, 4000, 400_000, 7, 32_764, 32_768)]
    net, held, real = Network(Training()), [], Network.cells

    def record(self, data, near):
        held.append(len(near))
        return real(self, data, near)

    monkeypatch.setattr(Network, "cells", record)
    together = net.score(texts)
    assert len(held) > 10 and max(held) <= SLICE + 1
    assert np.allclose(together, np.concatenate([net.score([x]) for x in texts]), atol=1e-6)
    filters = []
    for body in texts:
        data, near = cells_of(body)
        out = np.maximum(real(net, data, near)[:-1] @ net.weights["filter"][: net.width]
                         + real(net, data, near)[1:] @ net.weights["filter"][net.width :] + net.weights["shift"], 0)
        tops = np.concatenate([out, out[:1] * 0]).reshape(-1, 16, out.shape[1]).max(axis=1)
        starts = np.arange(0, max(len(tops) - 1, 1), 7)
        pooled = np.stack([tops[a : a + 8].max(axis=0) for a in starts])
        filters.append(1 / (1 + np.exp(-net.logits(pooled).mean())))
    assert np.allclose(together, filters, atol=1e-6)
