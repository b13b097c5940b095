"""License scans: votes of word pairs on the diagonals between a text and license templates.

Every pair of neighbouring words of every text is hashed and joined to the places
of the same pair in the templates.  Pairs of one copied passage agree on the
offset between text and template, their diagonal; neighbouring diagonals are
merged, so a few inserted or dropped words do not split a passage.  What enough
of a template votes for is a candidate: it is joined back to its text, verified
word by word, and of passages that overlap the best verified one stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlane.llm.texts import table
from starlane.session import materialize

# Phrases whose every exact place counts, with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Notices, as words, with the labels that a passage of them gives.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software"
    " and associated documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the"
    " gnu general public license as published by the free software foundation": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "all rights reserved no part of this publication may be reproduced": "reserved",
}

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Votes:
    """``share`` of a notice's pairs that a passage needs to be a candidate and of its words to
    be verified, and how far apart merged diagonals lie."""

    share: float = 0.75
    shift: int = 2


def words(text: Column) -> Column:
    """Words of ASCII digits and letters and of anything beyond ASCII, capitals of ASCII lowered.

    Two letters beyond ASCII have small forms in ASCII; they are masked so that
    lowering cannot make a template's word of them.
    """
    masked = F.replace(F.replace(text, F.lit("İ"), F.lit("¤")), F.lit("K"), F.lit("¤"))
    return F.regexp_extract_all(F.lower(masked), F.lit(WORD), F.lit(0))


def _pairs(sequence: Column) -> Column:
    """A hash of each word with the next one."""
    following = F.slice(sequence, F.lit(2), F.greatest(F.size(sequence), F.lit(1)))
    return F.zip_with(sequence, following, lambda a, b: F.xxhash64(a, b))


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """pair, template, label, exact, place, of: the pairs of all templates, and how many each has.

    Template -1 is the mark that each text sends along, so that texts without any hit stay.
    """
    rows = [(k, label, exact, text.split(), text) for k, (text, label, exact) in enumerate(
        [(t, n, True) for t, n in phrases.items()] + [(t, n, False) for t, n in notices.items()]
    )]
    frame = spark.createDataFrame(
        [r[:4] for r in rows], "template int, label string, exact boolean, w array<string>"
    )
    pairs = F.slice(_pairs(F.col("w")), F.lit(1), F.size("w") - 1)
    found = frame.select(
        "template", "label", "exact", (F.size("w") - 1).alias("of"), F.posexplode(pairs).alias("place", "pair")
    )
    mark = spark.createDataFrame([(-1, None, False, 1, 0)], "template int, label string, exact boolean, of int, place int")
    return found.unionByName(mark.withColumn("pair", _mark()))


def _mark() -> Column:
    return F.xxhash64(F.lit("\u0000mark"), F.lit("\u0000"))


# A character for each place of a notice, and the first for words that it has not.
_PLACES = "".join(map(chr, range(0x4E00, 0xA000)))


def _coded(sequence: Column, notice: Column) -> Column:
    """A character for each word, so that distances between texts are distances in words."""
    coded = F.transform(
        sequence, lambda w: F.substring(F.lit(_PLACES), (F.array_position(notice, w) + 1).cast("int"), F.lit(1))
    )
    return F.array_join(coded, "")


def verify(docs: DataFrame, spans: DataFrame, notices: DataFrame, votes: Votes) -> DataFrame:
    """key and passages of the texts with ``spans`` (key, template, low, high, begin, end) that hold.

    A span's ``share`` is one less its edit distance to the notice in words, over the
    notice's words; the better of its words between the outer votes and those where
    its diagonals let the notice begin and end.  Of spans that overlap the best stays.
    """
    text = F.coalesce("text", F.lit(""))
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("template", "low", "high", "begin", "end")).alias("spans"))
    # As many texts as hold a candidate, none of which is large beside the corpus.
    held = docs.select(F.xxhash64(text).alias("key"), text.alias("text")).join(materialize(spans, "license-spans"), "key")
    held = held.select("key", words(F.col("text")).alias("w"), "spans")

    def cut(low: Column, high: Column) -> Column:
        return F.slice("w", low + 1, high - low + 1)

    held = held.select("key", F.explode(F.transform("spans", lambda x: F.struct(
        x["template"].alias("template"), x["low"].alias("low"), x["high"].alias("high"),
        cut(x["low"], x["high"]).alias("inner"),
        cut(F.greatest(F.least(x["low"], x["begin"]), F.lit(0)), F.greatest(x["high"], x["end"])).alias("outer"),
    ))).alias("x")).select("key", "x.*").join(F.broadcast(notices), "template")
    size, own = F.size("notice"), _coded(F.col("notice"), F.col("notice"))
    distance = F.least(*[F.levenshtein(_coded(F.col(k), F.col("notice")), own) for k in ("inner", "outer")])
    held = held.withColumn("share", F.greatest(1 - distance / size, F.lit(0.0))).where(F.col("share") >= votes.share)
    # Best first: the share, then the longer notice.
    ranked = F.struct(
        (-F.col("share")).alias("rank"), (-size).alias("size"), "template", "low", "high", "label", "share"
    )
    found = held.groupBy("key").agg(F.array_sort(F.collect_set(ranked)).alias("found"))
    passage = F.struct(
        F.lit("").alias("label"), F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("last"),
        F.lit(0.0).alias("share"),
    )
    kept = F.aggregate("found", F.array_except(F.array(passage), F.array(passage)), lambda kept, x: F.when(
        F.exists(kept, lambda y: (y["first"] <= x["high"]) & (x["low"] <= y["last"])), kept
    ).otherwise(F.concat(kept, F.array(F.struct(
        x["label"].alias("label"), x["low"].alias("first"), x["high"].alias("last"), x["share"].alias("share"),
    )))))
    return materialize(found.select("key", F.array_sort(kept).alias("passages")), "license-passages")


def scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
    votes: Votes = Votes(),
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): word count, phrase places, labels, passages.

    ``places`` has the exact places (first word, label) of the phrases, ``passages``
    the notices' passages (label, first and last word, share of the notice's words).
    A null, empty or one-word text has neither; repeated rows are scanned each on its own.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.monotonically_increasing_id().alias("line"), "doc_id", F.xxhash64(text).alias("key"), words(text).alias("w"))
    # The mark comes first, at place -1, and carries the word count.
    pairs = F.concat(F.array(_mark()), _pairs(F.col("w")))
    read = read.select("line", "doc_id", "key", F.size("w").alias("n_words"), pairs.alias("pairs"))
    read = read.select("line", "doc_id", "key", "n_words", F.posexplode("pairs").alias("at", "pair"))
    # The templates are a fixed list of a few hundred words.
    hits = read.join(F.broadcast(templates(spark, phrases, notices)), "pair")
    diagonal = F.col("at") - 1 - F.col("place")
    voted = hits.groupBy(
        "line", "doc_id", "key", "n_words", "template", "label", "exact", "of", diagonal.alias("diagonal")
    ).agg(
        F.count("*").alias("votes"), F.min("at").alias("low"), F.max("at").alias("high"),
    )
    # Diagonals of one notice that lie near each other are one passage; phrases do not merge.
    own = Window.partitionBy("line", "doc_id", "key", "n_words", "template").orderBy("diagonal")
    begins = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(own) > votes.shift)
    merged = voted.withColumn("begins", F.coalesce(begins, F.lit(True)).cast("int"))
    merged = merged.withColumn("passage", F.sum("begins").over(own)).groupBy(
        "line", "doc_id", "key", "n_words", "template", "label", "exact", "of", "passage"
    ).agg(
        F.sum("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("diagonal").alias("diagonal"), F.max("diagonal").alias("reach"),
    )
    # A passage must be about as long as its notice; scattered pairs are none.
    compact = F.col("high") - F.col("low") + 1 <= F.col("of") + 2 * votes.shift
    place = F.struct(F.col("diagonal").cast("long").alias("first"), "label")
    span = F.struct(
        "template", (F.col("low") - 1).cast("long").alias("low"), F.col("high").cast("long").alias("high"),
        F.col("diagonal").cast("long").alias("begin"), (F.col("reach") + F.col("of")).cast("long").alias("end"),
    )
    is_place = F.col("exact") & (F.col("votes") == F.col("of"))
    is_span = ~F.col("exact") & (F.col("template") >= 0) & (F.col("votes") / F.col("of") >= votes.share) & compact
    found = materialize(merged.groupBy("line", "doc_id", "key", "n_words").agg(
        F.array_sort(F.collect_list(F.when(is_place, place))).alias("places"),
        F.collect_list(F.when(is_span, span)).alias("spans"),
    ), "license-votes")
    # Literals, so that no Python process starts for them.
    listed = F.array(*[
        F.struct(F.lit(k), F.lit(label), F.split(F.lit(" ".join(text.split())), " "))
        for k, (text, label) in enumerate(notices.items(), len(phrases))
    ]).cast("array<struct<template: int, label: string, notice: array<string>>>")
    listed = spark.range(1).select(F.explode(listed).alias("x")).select("x.*")
    passages = verify(docs, found.select("key", F.explode("spans").alias("x")).select("key", "x.*"), listed, votes)
    found = found.join(passages.withColumnRenamed("key", "of_key"), F.col("key") == F.col("of_key"), "left")
    blank = F.array().cast(passages.schema["passages"].dataType)
    return found.withColumn("passages", F.coalesce("passages", blank)).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "places", "passages",
        F.when(F.size("places") > 0, 1.0).otherwise(
            F.coalesce(F.array_max(F.transform("passages", lambda x: x["share"])), F.lit(0.0))
        ).alias("score"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.array_distinct(F.transform("places", lambda x: x["label"]))
    more = F.array_distinct(F.transform("passages", lambda x: x["label"]))
    starts = F.transform("places", lambda x: x["first"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"), "score",
    )
