"""From raw documents to packed sequences, in five stages.

Quality classifier, near duplicates, benchmark decontamination, personal data,
packing.  Every stage is written as Parquet and read again by the next one, and
what it wrote on the way is deleted; all but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.decontaminate import matches
from starlane.llm.jaccard_join import Similarity, linked, same_text
from starlane.llm.packing import pack
from starlane.llm.personal_data import redacted
from starlane.llm.quality_classifier import quality_classifier
from starlane.llm.texts import table
from starlane.session import materialize, scratch

# Five words and 80 percent, as near-duplicate stages take.
NEAR = Similarity(words=5, percent=80)


def unused(name: str, docs: DataFrame) -> str:
    """``name``, or with marks behind it, so that no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good; a null or empty text is judged like any other."""
    scored = quality_classifier(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 1").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts: the one with the smallest id, or without any if none has one.

    Rows are told apart by id and text; rows that only share an id are not folded,
    nor are texts without words, which are linked with nothing.
    """
    with scratch(spark) as keep:
        found = keep(linked(docs, NEAR), "near-duplicates").where("n_shingles > 0")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")
    first = found.groupBy("comp").agg(F.min(row).alias("row")).select("row.doc_id", "row.same")
    dropped = materialize(found.select("doc_id", "same").subtract(first), "near-copies")
    again = found.groupBy("doc_id", "same").count().where("count > 1").select("doc_id", "same")
    again = materialize(again, "repeated-rows")
    same = unused("same", docs)

    def within(rows: DataFrame, named: DataFrame, how: str) -> DataFrame:
        rows, named = rows.alias("a"), named.alias("b")
        return rows.join(
            named, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col(f"a.{same}") == F.col("b.same")), how
        )

    kept = within(docs.withColumn(same, same_text()), dropped, "left_anti")
    # Repeated rows are exact copies but for their other columns; the smallest stays.
    whole = F.struct(*docs.columns)
    one = within(kept, again, "left_semi").groupBy("doc_id", same).agg(F.min(whole).alias("row")).select("row.*")
    return within(kept, again, "left_anti").select(*docs.columns).unionByName(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no window of a benchmark item, whatever their id."""
    found = matches(docs.withColumn("doc_id", same_text()), table(spark, sf_dir, "benchmark"))
    same = unused("same", docs)
    found = found.where(F.size("hits") > 0).select(F.col("doc_id").alias(same)).distinct()
    return docs.withColumn(same, same_text()).join(found, same, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets, and their lengths where they have them.

    A null text stays null, with a null length; repeated rows are redacted each on its own.
    """
    cleaned = redacted(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents; a null or empty text is its end id alone, repeated rows are packed each."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("packing", packing),
]

# The classifier and the tokenizer are beyond SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), f"stage-{name.lower().replace(' ', '-')}")
    return docs
