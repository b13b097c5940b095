"""Secret scans: a random forest that removes false positives, in DataFrame functions and JVM trees.

Long opaque strings, values assigned to a secret's name however short, and
private-key headers are candidates.  The forest sees their length, character
transitions, dictionary coverage, path and neighbouring words, and keeps those
that look like the labelled findings.  The dictionary is all words that stand
alone in several texts, counted by a shuffle and joined to the candidates' words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.spans import joined, letters, located, matches
from starlane.llm.texts import table
from starlane.session import materialize

# Characters of opaque strings; "=" ends one, at most, so a name before it stays outside.
_OPAQUE = "[A-Za-z0-9_+/.-]"
_LONG = rf"(?<!{_OPAQUE})(?=[A-Za-z_+/.-]*+[0-9]){_OPAQUE}{{15,}}[A-Za-z0-9_+/-]"
# Characters of assigned values, and what stands before such a value.
_VALUE = "[^\\s\"'`<>,;(){}\\[\\]]"
_NAME = "(?:passw(?:or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|credentials?)"
_ASSIGNED = rf"{_NAME}[a-z0-9_-]{{0,16}}[\"']?\s{{0,2}}[:=]\s{{0,2}}[\"'`]?"


@dataclass(frozen=True)
class Forest:
    """The sample (``rows`` findings of each outcome), how many texts hold a word of the dictionary at
    least, the trees, the threshold."""

    rows: int = 2000
    least: int = 3
    trees: int = 20
    depth: int = 6
    threshold: float = 0.5
    seed: int = 13


def candidates(text: Column) -> list[Column]:
    """Runs of 16 and more opaque characters with a digit, dots at their end left out; values of six
    characters and more after a secret's name, without such a run in them; headers of private keys.

    No two candidates of a text overlap.
    """
    return [
        matches("opaque", text, rf"{_LONG}={{0,2}}+", text.rlike(rf"{_OPAQUE}{{16}}")),
        matches(
            "assigned", text, rf"(?i)(?<=[:=\s\"'`])(?<={_ASSIGNED})(?!{_VALUE}*?{_LONG})(?![:=]){_VALUE}{{6,}}+",
            text.rlike(rf"(?i){_NAME}"),
        ),
        matches(
            "private-key", text, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
            text.contains("PRIVATE KEY-----"),
        ),
    ]


def dictionary(texts: DataFrame, least: int) -> DataFrame:
    """word: lower-case words of four letters and more that stand alone in ``least`` texts or more.

    Letters beside digits or marks of opaque strings are no words, so pieces of a secret never are.
    """
    alone = "(?<![a-z0-9_+/=-])[a-z]{4,}+(?![a-z0-9_+/=-])"
    found = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(alone), F.lit(0))
    counts = texts.select(F.explode(F.array_distinct(found)).alias("word")).groupBy("word").count()
    return counts.where(F.col("count") >= least).select("word")


def covered(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with ``covered``: how many letters of a candidate are words of the dictionary."""
    key = ["line", "kind", "start"]
    runs = F.filter(F.split(F.lower("surface"), "[^a-z]+"), lambda w: F.length(w) >= 4)
    words = found.where(F.col("kind").isNotNull()).select(*key, F.explode(runs).alias("word"))
    # Only distinct words meet the dictionary; what they hit is joined back to the candidates.
    hits = words.select("word").distinct().join(known, "word", "left_semi")
    sums = words.join(hits, "word").groupBy(key).agg(F.sum(F.length("word")).alias("covered"))
    return found.join(sums, key, "left").withColumn("covered", F.coalesce("covered", F.lit(0)))


def features() -> dict[str, Column]:
    """What the forest sees of a candidate; ``tag`` is the path of its text."""
    s, size = F.col("surface"), F.length("surface")
    before, after = F.lower("before"), F.lower("after")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    return {
        "length": size,
        "changes": F.length(kinds) / size,
        "digits": letters(s, "[^0-9]") / size,
        "capitals": letters(s, "[^A-Z]") / size,
        "marks": letters(s, "[A-Za-z0-9]") / size,
        "hex": s.rlike("^[0-9a-fA-F]+$").cast("int"),
        "distinct": F.size(F.array_distinct(F.split(s, ""))) / size,
        "vowels": letters(s, "[^aeiouAEIOU]") / size,
        "dictionary": F.col("covered") / size,
        "path": F.lower(F.coalesce("tag", F.lit(""))).rlike("test|example|sample|doc|fixture").cast("int"),
        "address": F.concat(F.lit(" "), before, s, after).rlike(r"https?://\S*$|@").cast("int"),
        "placeholder": F.concat(before, s).rlike("example|dummy|xxxx|changeme|your[_-]").cast("int"),
        "key_word": before.rlike("token|secret|passw|pwd|api.?key|access.?key|auth|credential").cast("int"),
        "assigned": before.rlike("[=:]\\s*[\"']?$").cast("int"),
        "quoted": (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("int"),
    }


def proposals(docs: DataFrame, texts: DataFrame, how: Forest = Forest()) -> DataFrame:
    """All candidates with their features, and a row with a null kind for each text."""
    found = candidates(F.coalesce("text", F.lit("")))
    rows = materialize(located(docs, found, ["doc_id"], F.col("source").cast("string")), "secret-places")
    rows = covered(rows, dictionary(texts, how.least))
    rows = rows.withColumns({f"f_{k}": v.cast("double") for k, v in features().items()})
    return materialize(rows.drop("covered"), "secret-candidates")


def _names(found: DataFrame) -> list[str]:
    return [c for c in found.columns if c.startswith("f_")]


def weak_findings(found: DataFrame) -> DataFrame:
    """Findings labelled by rule, as far as rules can tell: ``label`` 1 for what has a provider's form or
    is a value of good variety assigned to a password, a secret, a token or an API key, 0 for an address, a
    number, a placeholder or dictionary words.

    Values of other names (access keys, authentication keys, credentials), and opaque strings without a name, such as
    digests and identifiers, get no label: the forest alone decides on them.
    """
    s, before = F.col("surface"), F.lower("before")
    provider = s.rlike(r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{10,}|eyJ[0-9A-Za-z_.-]{20,})$")
    named = before.rlike("(passw(or)?d|secret|token|api.?key)[a-z0-9_-]{0,16}[\"']?\\s*[:=]\\s*[\"'`]?$")
    various = (F.col("f_distinct") * F.col("f_length") >= 6) & s.rlike("[0-9]") & (F.col("f_dictionary") <= 0.5)
    wrong = (
        (F.col("f_placeholder") == 1) | (F.col("f_address") == 1) | s.rlike(r"^[0-9.+/-]+$")
        | (F.col("f_dictionary") > 0.5) | s.rlike(r"^[$%]")
    )
    label = F.when((F.col("f_placeholder") == 0) & (provider | (named & various)), 1.0).when(wrong, 0.0)
    return found.where("kind in ('opaque', 'assigned')").withColumn("label", label).where("label is not null")


def train(findings: DataFrame, how: Forest = Forest()) -> RandomForestClassificationModel | None:
    """A forest fitted to labelled findings (``label`` and the features); None without both outcomes."""
    names = _names(findings)
    rows = findings.select("label", *names, F.xxhash64("surface", "line", "start").alias("order"))
    parts = [rows.where(F.col("label") == y).orderBy("order").limit(how.rows) for y in (0.0, 1.0)]
    sample = parts[0].unionByName(parts[1]).coalesce(1).sortWithinPartitions("order")
    sample = materialize(sample, "secret-sample")
    if sample.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    sample = VectorAssembler(inputCols=names, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=how.trees, maxDepth=how.depth, seed=how.seed).fit(sample)


def secrets(
    docs: DataFrame, texts: DataFrame, findings: DataFrame | None = None, how: Forest = Forest()
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source): candidates, secrets, their spans.

    ``texts`` (text) gives the dictionary.  ``findings`` are labelled findings; by
    default those that ``weak_findings`` labels.  Without both outcomes nothing
    but private keys is a secret.  A null or empty text has no candidates;
    repeated rows are scanned each on its own, with equal results.  A score equal
    to the threshold is a secret.  Texts of any length are scanned whole.  An empty
    table gives no rows; columns besides these three are ignored.
    """
    found = proposals(docs, texts, how)
    model = train(weak_findings(found) if findings is None else findings, how)
    names = _names(found)
    opaque = found.where("kind in ('opaque', 'assigned')")
    if model is None:
        scored = opaque.withColumn("score", F.lit(0.0))
    else:
        scored = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(opaque))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    keys = found.where("kind = 'private-key'").withColumn("score", F.lit(1.0))
    columns = ["line", "kind", "start", "stop", "score"]
    every = scored.select(columns).unionByName(keys.select(columns))
    is_secret = F.col("score") >= how.threshold
    span = F.struct("start", F.lit(0).alias("rank"), "stop", "kind")
    spans = every.groupBy("line").agg(
        F.count("*").alias("n_candidates"), F.count(F.when(is_secret, 1)).alias("n_secrets"),
        joined(F.collect_list(F.when(is_secret, span))).alias("spans"), F.max("score").alias("score"),
    )
    zero = F.lit(0).cast("long")
    return found.where(F.col("kind").isNull()).select("line", "row.doc_id").join(spans, "line", "left").select(
        "doc_id", F.coalesce("n_candidates", zero).alias("n_candidates"), F.coalesce("n_secrets", zero).alias("n_secrets"),
        F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets(docs, docs)
