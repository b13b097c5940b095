from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from starlane.llm import personal_data
from starlane.llm.personal_data import by_document, redacted
from tests.llm.helpers import ODD_TEXTS, documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, surface):
    digits = re.sub("[^0-9]", "", surface)
    if kind == "ip":
        return all(int(p) <= 255 for p in surface.split("."))
    if kind == "card":
        total = 0
        for i, d in enumerate(map(int, reversed(digits))):
            total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m.group()):
                spans.append((m.start(), rank, kind, m.end()))
    spans.sort()
    return [f"{k}:{a}:{b}" for a, _, k, b in spans]


def noise(rng):
    alphabet = ["1", "4", "0", "25", "255", "4111111111111111", ".", "..", "-", " ", "+", "@", "a", "b.c",
                "é", "(", ")", "_", "%", "x@y.z", "\n", "1.2.3.4", "\U0001f600", "4111 1111 1111 1111"]
    return "".join(rng.choices(alphabet, k=rng.randint(1, 40)))


def test_base_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(3)
    texts = [
        *ODD_TEXTS, "é a.b@c.d mail", "a@b.c_d@e.f a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.001",
        "4111-1111 1111-1111, 4111  1111 11111111", "+1 (437) 555-0689 and +49 (1) 2", "1 " * 20000,
        "a.b." * 5000 + "@x.y" + ".z" * 5000, "9" * 50000, "a" * 50000 + "@", *[noise(rng) for _ in range(600)],
    ]
    got = {r.doc_id: r for r in by_document(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = plain(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), repr(text)
        for kind in PATTERNS:
            assert got[i][f"n_{kind}"] == sum(s.startswith(kind) for s in want)
        assert set(want) <= set(got[i].spans.split(",")) | {""}


def test_redaction_keeps_the_rest(spark):
    texts = ["mail a.b@c.de or +1 437 555 0689!", "nothing here", None, "ip 1.2.3.4", "", "x@y.zz"]
    docs = documents(spark, texts)
    out = {r.doc_id: r for r in redacted(docs).collect()}
    assert redacted(docs).columns == docs.columns
    assert out[0].text == "mail [EMAIL] or [PHONE]!" and out[1].text == "nothing here"
    assert out[2].text is None and out[3].text == "ip [IP]" and out[4].text == ""
    assert out[5].text == "[EMAIL]" and out[5].body == "x"


def test_trees_add_what_looks_like_the_base_kinds(spark):
    rng = random.Random(4)
    texts = []
    for i in range(400):
        good, bad = f"user{i}@mail{i % 7}.example.org", f"{rng.randint(300, 999)}.{i}.7.{i}"
        texts.append(f"word {good} text +1 (437) 555-{1000 + i} and {bad} or x{rng.getrandbits(60)}")
    texts.append("write to jane.doe(at)example.org soon")
    got = {r.doc_id: r.spans for r in by_document(documents(spark, texts)).collect()}
    assert all(got[i].count("email") == 1 for i in range(400))


def test_empty_table(spark):
    assert by_document(documents(spark, [])).count() == 0
    assert redacted(documents(spark, [])).count() == 0


def test_trees_and_threshold_see_every_candidate(spark, monkeypatch):
    seen = []
    plain_fit = personal_data.GBTClassifier.fit

    def fit(self, rows, params=None):
        seen.append(rows.agg(F.sum("n")).first()[0] if "n" in rows.columns else rows.count())
        return plain_fit(self, rows, params)

    monkeypatch.setattr(personal_data.GBTClassifier, "fit", fit)
    texts = [f"from user{i}@mail.example to {i % 400}.{i % 300}.7.{i % 256}" for i in range(3000)]
    found = personal_data.proposals(documents(spark, texts), ["doc_id"])
    assert personal_data.train(found, personal_data.Boosting(trees=1)) is not None
    half = F.pmod(F.xxhash64("surface", "line", "start"), F.lit(2)) == 0
    wanted = found.where(F.col("kind").isin(*personal_data.BASE) & half).count()
    assert wanted > 2500 and seen == [wanted]
