"""Mixing sources to target weights, by Efraimidis-Spirakis sampling.

Each source gets a budget of words.  Whole passes over a source come first; what
is left of its budget goes to documents in the order of exponential keys, each
divided by the document's quality weight, until their summed sizes reach it.

Keys are dealt into ranges, so that a source's order needs no sort of the source:
ranges are summed, and only the range in which the budget ends is sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlane.llm.texts import table
from starlane.session import materialize

_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in their order, repeating; percent of all words that the mix has;
    how often a source may be taken; documents in a range of keys; seed of the keys."""

    weights: tuple[int, ...] = (5, 2, 1)
    percent: int = 150
    most: int = 2
    rows: int = 4096
    seed: str = "mix"


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``sizes`` (source, source_size, one row for each source) with ``target``.

    Shares of the budget by weight; a source stops at ``most`` times its size and the
    excess is shared anew by weight until none is above.  In the order of size for
    each weight the full sources come first, so each one's share is known from sums
    over those before it.  A source without words has the target 0.
    """
    # Few rows, one for each source: a window over all of them.
    named = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(named) - 1) % len(mix.weights)
    weights = F.array(*[F.lit(w).cast("long") for w in mix.weights])
    ranked = sizes.withColumn("weight", F.get(weights, turn)).withColumn("most", F.col("source_size") * mix.most)
    order = (F.col("most").cast("double") / F.col("weight"), F.asc_nulls_last("source"))
    before = Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    budget = F.sum("source_size").over(whole) * (mix.percent / 100)
    left = budget - F.coalesce(F.sum("most").over(before), F.lit(0))
    free = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = ranked.withColumn("left", left).withColumn("free", free)
    shared = shared.withColumn("full", F.col("left") * F.col("weight") >= F.col("most") * F.col("free"))
    # The first source that is not full sets the level for all that follow.
    level = F.max(F.when(~F.col("full"), F.struct("free", "left"))).over(whole)
    share = F.col("weight") * F.col("level.left") / F.col("level.free")
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(share)
    return shared.withColumn("level", level).select(
        "source", "source_size", F.least(target, F.col("most").cast("double")).alias("target")
    )


def drawn(text: Column, seed: str) -> Column:
    """An exponential number for a row: -ln(u), with u in (0, 1) from a digest of id and text."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    digits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double")
    return -F.log((digits + 0.5) / float(1 << 52))


def _rows(docs: DataFrame, weights: DataFrame | None, mix: Mix) -> DataFrame:
    """doc_id, source, size, ``late`` (1 for rows without a weight above 0) and ``key`` of each row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "source",
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"),
        drawn(text, mix.seed).alias("drawn"),
    )
    weight = F.lit(1.0)
    if weights is not None:
        # Bytes a row meet the weights; no text is shuffled.
        one = weights.groupBy("doc_id").agg(F.max(F.col("weight").cast("double")).alias("weight"))
        rows = rows.join(one.where("doc_id IS NOT NULL AND weight IS NOT NULL"), "doc_id", "left")
        weight = F.coalesce("weight", F.lit(1.0))
    good = (weight > 0) & ~F.isnan(weight)
    return rows.select(
        "doc_id", "source", "size",
        F.when(good, 0).otherwise(1).alias("late"),
        (F.col("drawn") / F.when(good, weight).otherwise(1.0)).alias("key"),
    )


def _plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """For each source: its target, whole passes, words left for a part, ranges and scale of its keys."""
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.ceil(F.count(F.lit(1)) / float(mix.rows)).alias("ranges"),
        F.coalesce(F.avg(F.when(F.col("late") == 0, F.col("key"))), F.lit(1.0)).alias("scale"),
    )
    aimed = targets(sizes.select("source", "source_size"), mix).alias("t")
    same = F.col("t.source").eqNullSafe(F.col("s.source"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return (
        aimed.join(sizes.drop("source_size").alias("s"), same)
        .select(F.col("t.source").alias("of"), "source_size", "target", "ranges", "scale")
        .withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
        .withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
    )


def mixed(docs: DataFrame, weights: DataFrame | None = None, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken for each row of ``docs`` (doc_id, text, source).

    ``weights`` (doc_id, weight) has quality weights; an id without one, or with null,
    has 1, one given twice its largest, and rows whose weight is not above 0 come last.
    ``taken`` counts the words that the mix takes of a row: all of them for every whole
    pass, and once more, up to the budget's last word, if its key comes early enough.
    A null or empty text has size 0.  A null source is a source of its own, the last.
    Rows with equal id and text have equal keys and go one after the other.  Other
    columns are ignored; an empty table gives none.
    """
    rows = materialize(_rows(docs, weights, mix), "mix-rows")
    plan = materialize(_plan(rows, mix), "mix-plan")
    here = F.col("source").eqNullSafe(F.col("of"))
    # 1 - exp(-x) grows with x and is nearly even in 0 to 1, whatever the scale of the weights.
    even = F.floor((1 - F.exp(-F.col("key") / F.col("scale"))) * F.col("ranges"))
    place = F.col("late") * F.col("ranges") + F.least(even, F.col("ranges") - 1)
    dealt = rows.join(plan, here).withColumn("range", place.cast("long"))

    words = dealt.groupBy("of", "range").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    words = words.withColumn("upto", F.sum("words").over(upto))
    # The range in which the budget ends: those before it go whole, those after it not at all.
    ends = words.where("upto > rest").groupBy("of").agg(
        F.min(F.struct("range", (F.col("upto") - F.col("words")).alias("ahead"))).alias("end")
    )
    ends = materialize(ends, "mix-ends").select(F.col("of").alias("at"), "end.range", "end.ahead")

    plan = plan.join(ends.withColumnRenamed("range", "edge"), F.col("of").eqNullSafe(F.col("at")), "left")
    dealt = rows.join(plan, here).withColumn("range", place.cast("long"))
    more = F.when(F.col("edge").isNull() | (F.col("range") < F.col("edge")), F.col("size")).otherwise(0)
    columns = ["doc_id", "size", "source_size", "target"]
    clear = dealt.where(F.col("edge").isNull() | (F.col("range") != F.col("edge"))).select(
        *columns, (F.col("passes") * F.col("size") + more).alias("taken")
    )
    # Rows alike are one here, however many, and come apart again afterwards.
    alike = dealt.where("range = edge").groupBy("of", "late", "key", "doc_id", "size").agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("source_size", "target", "passes", "rest", "ahead")],
    )
    earlier = Window.partitionBy("of").orderBy("late", "key", "doc_id", "size")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("ahead") + F.coalesce(F.sum(F.col("size") * F.col("copies")).over(earlier), F.lit(0))
    single = alike.withColumn("start", start).select("*", F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy"))
    left = F.col("rest") - F.col("start") - F.col("copy") * F.col("size")
    part = F.least(F.col("size"), F.greatest(left, F.lit(0)))
    sorted_ = single.select(*columns, (F.col("passes") * F.col("size") + part).alias("taken"))
    return clear.unionByName(sorted_)


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id and weight: 2 for a text labelled good, a half for one labelled bad."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(
        "doc_id", F.when(F.col("quality") > 0, 2.0).otherwise(0.5).alias("weight")
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels")))
