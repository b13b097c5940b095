"""PII: candidate spans scored by boosted trees, in DataFrame functions and JVM trees.

Generators with high recall propose overlapping spans.  Gradient-boosted trees
score them by format and context; a threshold, calibrated on candidates that the
trees did not see, selects redactions.  Both come from all candidates of the base kinds.  Spans of the four
base kinds that pass their checks always stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlane.llm.spans import joined, letters, located, matches
from starlane.llm.texts import table
from starlane.session import materialize

BASE = ("email", "ip", "card", "phone")
EXTRA = ("address", "number")
KINDS = BASE + EXTRA

# Scores are told apart in so many steps where the threshold is set.
CELLS = 10_000


@dataclass(frozen=True)
class Boosting:
    """What each kind and outcome weighs at most (as ``rows`` candidates; all of them count), the
    trees, the wanted precision."""

    rows: int = 1000
    bins: int = 256
    trees: int = 10
    depth: int = 3
    precision: float = 0.95
    seed: int = 11


def candidates(text: Column) -> list[Column]:
    """Matches of the base kinds and of the looser generators.

    A run that a base pattern could only enter in its middle is entered at its
    start or not at all, and doubled separators, which no base pattern crosses,
    are masked first; so the matches are those of the plain patterns, in time
    linear in the text and without repeated groups.
    """
    local, domain = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
    one_dot = F.regexp_replace(text, r"(?<=\.)\.", "_")
    one_gap = F.regexp_replace(text, r"(?<=[\x20-])[\x20-]", "_")
    digits = text.rlike(r"[0-9](?:[\x20().-]{0,2}[0-9]){6}")
    return [
        matches(
            "email", one_dot,
            rf"(?:(?<!{local})|\G){local}++@(?={domain}++\.{domain})[A-Za-z0-9.-]*{domain}",
            text.contains("@"),
        ),
        matches(
            "ip", text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
            text.rlike(r"[0-9]\.[0-9]"),
        ),
        matches("card", one_gap, r"[0-9][0-9\x20-]*[0-9]", text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")),
        matches("phone", text, r"\+[0-9][\x20().0-9-]+[0-9]", text.contains("+")),
        matches(
            "address", text, r"(?<![^\s<(\"'])[^\s@<>()\[\]]{1,64}+(?:@|\x20?[\[(]at[\])]\x20?)[^\s@<>()\[\]]{3,255}+",
            text.rlike(r"@|[\[(]at[\])]"),
        ),
        matches("number", text, r"(?<![0-9A-Za-z])\+?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])", digits),
    ]


def _digits() -> Column:
    return F.regexp_replace("surface", "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def valid() -> Column:
    """Whether a candidate of a base kind passes the checks of its kind."""
    size = F.length(_digits())
    parts = F.transform(F.split("surface", r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(
        parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255")))
    )
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", small)
        .when(F.col("kind") == "card", F.when(size.between(12, 19), luhn(_digits())).otherwise(False))
        .when(F.col("kind") == "phone", size.between(9, 15))
        .otherwise(False)
    )


def features() -> dict[str, Column]:
    """Format and context of a candidate; none tells which generator proposed it."""
    s, before, after = F.col("surface"), F.col("before"), F.col("after")
    return {
        "length": F.length(s),
        "digits": F.length(_digits()),
        "letters": letters(s, "[^A-Za-z]"),
        "separators": letters(s, r"[^\x20().-]"),
        "groups": F.size(F.split(s, "[^0-9A-Za-z]+")),
        "longest": F.array_max(F.transform(F.split(s, "[^0-9]+"), F.length)),
        "plus": s.startswith("+").cast("int"),
        "at": F.contains(s, F.lit("@")).cast("int"),
        "dots": letters(s, r"[^.]"),
        "luhn": F.when(F.length(_digits()) >= 2, luhn(_digits())).otherwise(False).cast("int"),
        "joined_before": before.rlike(r"[A-Za-z0-9_.+@=-]$").cast("int"),
        "joined_after": after.rlike(r"^[A-Za-z0-9_@=-]").cast("int"),
        "digits_near": letters(F.concat(before, after), "[^0-9]"),
        "quoted": before.rlike("[\"'=:]\\s*$").cast("int"),
        "named": F.lower(before).rlike("phone|tel|mail|card|contact|call|ip|fax").cast("int"),
    }


def proposals(docs: DataFrame, kept: list[str]) -> DataFrame:
    """All candidates with their checks and features, and a row with a null kind for each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = located(docs, candidates(text), kept)
    rows = rows.withColumns({"valid": valid(), **{f"f_{k}": v.cast("double") for k, v in features().items()}})
    return materialize(rows.drop("before", "after"), "candidates")


def examples(found: DataFrame) -> DataFrame:
    """kind, label, half, features and n: how many matches of the base patterns are alike in these.

    All of them are counted; they are right (label 1) if they pass their checks.  The
    halves are those that fit the trees (0) and that set the threshold (1).
    """
    half = F.pmod(F.xxhash64("surface", "line", "start"), F.lit(2)).alias("half")
    names = [f"f_{k}" for k in features()]
    rows = found.where(F.col("kind").isin(*BASE)).select("kind", F.col("valid").cast("double").alias("label"), half, *names)
    return materialize(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "pii-examples")


def train(found: DataFrame, how: Boosting) -> tuple[GBTClassificationModel, int] | None:
    """Trees and the threshold, in cells of the score, for spans that only the looser generators propose.

    Examples are all matches of the base patterns, alike ones as one weighted row.
    Half of them is kept from the trees to set the threshold: the lowest cell
    from which on the wanted share is right.  None without both outcomes.
    """
    counted = examples(found)
    # One row for each half, kind and outcome.
    totals = counted.groupBy("kind", "label").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("half") == 0, F.col("n"))).alias("fit"))
    if len({r.label for r in totals.collect() if r.fit}) < 2:
        return None
    share = F.least(F.col("total"), F.lit(how.rows)) / F.col("total")
    weighted = counted.join(F.broadcast(totals), ["kind", "label"]).withColumn("weight", F.col("n") * share)
    names = [f"f_{k}" for k in features()]
    weighted = VectorAssembler(inputCols=names, outputCol="features").transform(weighted)
    boosted = GBTClassifier(maxIter=how.trees, maxDepth=how.depth, seed=how.seed, weightCol="weight", maxBins=how.bins)
    model = boosted.fit(weighted.where("half = 0"))
    rest = model.transform(weighted.where("half = 1")).groupBy(score_cell().alias("cell"))
    right = F.sum(F.col("weight") * F.col("label")).alias("right")
    threshold, good, every = 2 * CELLS, 0.0, 0.0
    # At most a row for each cell.
    for row in rest.agg(right, F.sum("weight").alias("every")).orderBy(F.desc("cell")).collect():
        good, every = good + row.right, every + row.every
        if good >= how.precision * every:
            threshold = row.cell
    return model, threshold


def score_cell() -> Column:
    """The cell of a model's score, of ``CELLS`` between 0 and 1."""
    return F.floor(vector_to_array("probability")[1] * CELLS)


def personal_data(found: DataFrame, how: Boosting = Boosting()) -> DataFrame:
    """The selected spans among ``proposals``: line, kind, start, stop, base, score.

    Base spans that pass their checks are all there; a span of a looser generator
    is there if its score reaches the threshold and no span before it, and no
    base span, overlaps it.
    """
    base = found.where(F.col("kind").isin(*BASE) & F.col("valid")).select(
        "line", "kind", "start", "stop", F.lit(True).alias("base"), F.lit(1.0).alias("score")
    )
    trained = train(found, how)
    if trained is None:
        return base
    model, threshold = trained
    names = [f"f_{k}" for k in features()]
    loose = VectorAssembler(inputCols=names, outputCol="features").transform(
        found.where(F.col("kind").isin(*EXTRA))
    )
    score = vector_to_array("probability")[1]
    loose = model.transform(loose).where(score_cell() >= threshold).select(
        "line", "kind", "start", "stop", F.lit(False).alias("base"), score.alias("score")
    )
    every = base.unionByName(loose)
    order = Window.partitionBy("line").orderBy("start", F.col("base").desc(), "stop", "kind")
    back = order.rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("line").orderBy(
        F.col("start").desc(), F.col("base"), F.col("stop").desc(), F.col("kind").desc()
    ).rowsBetween(Window.unboundedPreceding, -1)
    clear = (F.coalesce(F.max("stop").over(back), F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(ahead), F.col("stop"))
        >= F.col("stop")
    )
    return every.withColumn("clear", clear).where("base or clear").drop("clear")


def _rank() -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))


def _span(condition: Column | None = None) -> Column:
    one = F.struct("start", _rank().alias("rank"), "stop", "kind")
    return F.collect_list(one if condition is None else F.when(condition, one))


def by_document(docs: DataFrame, how: Boosting = Boosting()) -> DataFrame:
    """Counts and spans for each row of ``docs`` (doc_id, text).

    A null or empty text has no spans; repeated rows are searched each on its own.
    """
    found = proposals(docs, ["doc_id"])
    lines = found.where(F.col("kind").isNull()).select("line", "row.doc_id")
    spans = personal_data(found, how).groupBy("line").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        joined(_span(F.col("base"))).alias("base_spans"),
        joined(_span()).alias("spans"),
    )
    none = F.lit("")
    return lines.join(spans, "line", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base_spans", none).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", none).alias("spans"),
    )


def redacted(docs: DataFrame, how: Boosting = Boosting()) -> DataFrame:
    """``docs`` with each selected span replaced by its kind in brackets; a null text stays null.

    Overlapping spans are replaced from the earliest on, the later one from where
    the earlier ends; spans inside an earlier one vanish with it.
    """
    found = proposals(docs, docs.columns)
    rows = found.where(F.col("kind").isNull()).select("line", "row")
    spans = personal_data(found, how)
    order = Window.partitionBy("line").orderBy("start", F.col("stop").desc(), _rank())
    seen = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = (
        spans.withColumn("seen", seen)
        .where("stop > seen")
        .groupBy("line")
        .agg(
            F.array_sort(F.collect_list(F.struct("start", "seen", "stop", "kind"))).alias("cuts"),
            F.max("stop").alias("end"),
        )
    )
    kept = F.transform(
        "cuts",
        lambda x: F.concat(
            F.substring(F.col("row.text"), (x["seen"] + 1).cast("int"),
                        F.greatest(x["start"] - x["seen"], F.lit(0)).cast("int")),
            F.lit("["), F.upper(x["kind"]), F.lit("]"),
        ),
    )
    rest = F.substring(F.col("row.text"), (F.col("end") + 1).cast("int"), F.length("row.text"))
    text = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(
        F.concat(F.array_join(kept, ""), rest)
    )
    return rows.join(spans, "line", "left").select(F.col("row").withField("text", text).alias("row")).select("row.*")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_document(table(spark, sf_dir, "documents"))
