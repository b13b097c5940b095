"""Frames and plain definitions that the tests of the corpus operators share."""

from __future__ import annotations

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def documents(spark, texts, **extra):
    """Documents with ids from 0, and columns whose names clash with inner ones."""
    rows = [(i, t, "en", "src", 0, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, body string, block int",
    )


def plain_words(text):
    return [w.decode() for w in WORD.findall((text or "").encode())]


def alnum_words(text):
    return [w.decode() for w in ALNUM_WORD.findall((text or "").encode().lower())]


ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "ÄÖ é x   \U0001f600 y\x0bz\x1cq",
    "same line\nsame line\n\nsame line",
    "a b c d e f g h i a b c d e f g h i",
    "word " * 30000,
    "plain words that differ from each other and go on long enough to make a text of twenty"
    " or more distinct ones here now",
]
