"""Spans of pattern matches with their places and surroundings, in plain DataFrame functions.

All matches of a pattern come from one split of the text: the pieces between the
matches give the surroundings, and their running lengths the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Code points of surroundings kept on each side of a match.
CONTEXT = 32

FOUND = T.ArrayType(
    T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("number", T.IntegerType()),
        T.StructField("gap", T.IntegerType()),
        T.StructField("before", T.StringType()),
        T.StructField("surface", T.StringType()),
        T.StructField("after", T.StringType()),
    ])
)


def matches(kind: str, text: Column, pattern: str, possible: Column) -> Column:
    """Leftmost non-overlapping matches as an array of FOUND's structs.

    Patterns see Java's syntax.  They must not repeat groups without bound, which
    overflows the stack on long runs; ``possible`` is a cheap necessary condition.
    """
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        pieces,
        F.slice(pieces, F.lit(2), F.size(pieces)),
    )
    found = F.transform(
        F.filter(zipped, lambda x: x["0"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("number"), F.length(x["1"]).alias("gap"),
            F.right(x["1"], F.lit(CONTEXT)).alias("before"), x["0"].alias("surface"),
            F.left(x["2"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return F.when(possible, found).otherwise(F.array()).cast(FOUND)


def located(
    docs: DataFrame, found: list[Column], kept: list[str], tag: Column | None = None
) -> DataFrame:
    """One row for each match, and one with a null kind for each row of ``docs``.

    Columns: ``line`` (a number for each row of ``docs``), kind, start and stop
    (code points, stop exclusive), before, surface, after; the row with the null
    kind has ``row``, a struct of the columns ``kept``, which is null elsewhere.  ``tag`` goes along with every row.
    """
    blank = F.array(F.lit(None)).cast(FOUND)
    rows = docs.select(
        F.monotonically_increasing_id().alias("line"), F.struct(*kept).alias("row"),
        (F.lit(None).cast("string") if tag is None else tag).alias("tag"),
        F.concat(blank, *found).alias("found"),
    )
    rows = rows.select("line", "row", "tag", F.posexplode("found").alias("at", "one"))
    rows = rows.select("line", "tag", F.when(F.col("at") == 0, F.col("row")).alias("row"), "one.*")
    own = Window.partitionBy("line", "kind").orderBy("number")
    start = F.sum("gap").over(own.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(
        F.sum(F.length("surface")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return rows.select(
        "line", "tag", "row", "kind", start.alias("start"),
        (start + F.length("surface")).alias("stop"), "before", "surface", "after",
    )


def joined(spans: Column) -> Column:
    """``kind:start:stop`` of an array of structs (start, rank, stop, kind), in that order."""
    texts = F.transform(
        F.array_sort(spans),
        lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string")),
    )
    return F.array_join(texts, ",")


def letters(surface: Column, unwanted: str) -> Column:
    """How many characters of ``surface`` the class keeps whose complement is ``unwanted``."""
    return F.length(F.regexp_replace(surface, unwanted, ""))
