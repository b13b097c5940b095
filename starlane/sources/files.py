"""CSV and JSON readers.  Every column is read as text; the gate does the typing.

Reading text keeps leading zeros of phone and identity numbers and lets one
malformed value fail its own row only.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.sources.json_ranges import record_texts
from starlane.sources.ranges import RANGE_BYTES, listed

# The dataset name in a path: a file ``t.csv``, or a folder ``t.csv`` of part files.
_DATASET = r"/([^/.=]+)\.(?:csv|json)(?:/|$)"
_RUN_DATE = r"/(?:run_date=)?(\d{4}-\d{2}-\d{2})/"
_RUN_HOUR = r"/(?:run_date=)?\d{4}-\d{2}-\d{2}/(?:run_hour=)?(\d{2})/"


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("escape", '"')


def literal(path: str) -> str:
    """A path whose special characters readers take for themselves, not for patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _large(spark: SparkSession, paths: str | list[str], span: int) -> DataFrame | None:
    """The listing of ``paths`` if a file in it is longer than one range, else None."""
    found = listed(spark, paths)
    return None if found.where(F.col("length") > span).isEmpty() else found


def header_names(
    spark: SparkSession, paths: list[str], fmt: str, span: int = RANGE_BYTES
) -> DataFrame:
    """path and names: the columns that each file itself has, empty where it holds nothing.

    One job reads all files: of CSV the first line, of JSON each file as one value, or record
    by record where a file is longer than ``span`` bytes.
    """
    plain = [literal(p) for p in paths]
    if fmt == "csv":
        return _csv_names(spark, plain)
    found = _large(spark, plain, span)
    if found is None:
        whole = spark.read.text(plain, wholetext=True)
        records = F.from_json("value", "array<map<string,string>>")
        names = F.array_distinct(F.flatten(F.transform(records, F.map_keys)))
        return whole.select(F.col("_metadata.file_path").alias("path"), _or_empty(names).alias("names"))
    names = F.map_keys(F.from_json("record", "map<string,string>")).alias("names")
    # Records of a file mostly have the same names: those lists are told apart before any is opened up.
    alike = record_texts(found, span=span).select("path", names).distinct()
    seen = alike.select("path", F.explode("names").alias("name")).groupBy("path")
    per_file = seen.agg(F.collect_set("name").alias("names"))
    return found.select("path").join(per_file, "path", "left").select("path", _or_empty(F.col("names")).alias("names"))


def _or_empty(names: Column) -> Column:
    return F.coalesce(names, F.array().cast("array<string>"))


def _csv_names(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Header cells of each file, read as the CSV reader reads them."""
    whole = spark.read.text(paths, wholetext=True)
    line = F.regexp_extract("value", r"^\x{FEFF}?([^\r\n]*)", 1)
    cells = F.regexp_extract_all(line, F.lit(r'(?:^|,)(\s*"(?:[^"]|"")*"[^,]*|[^,]*)'), 1)
    names = F.transform(cells, lambda c: F.replace(F.regexp_replace(F.trim(c), r'^"|"$', ""), F.lit('""'), F.lit('"')))
    return whole.select(
        F.col("_metadata.file_path").alias("path"), _or_empty(F.when(line != "", names)).alias("names")
    )


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """CSV with a header; all files must have the header of the first.

    With ``columns`` the header must match them, without it the header's own
    names are used.
    """
    if columns is None:
        columns = _csv(spark).csv(path).columns
    return (
        _csv(spark)
        .schema(_text_schema(columns))
        .option("enforceSchema", False)
        .csv(path)
    )


def stream_json_numbers(spark: SparkSession) -> None:
    """Take numbers as parsed when a JSON column is read as text.

    The default copies their exact characters, for which Spark seeks from the
    start of a multi-line file again for every single number.
    """
    spark.conf.set("spark.sql.json.enableExactStringParsing", "false")


def read_json(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    lines: bool = False,
    span: int = RANGE_BYTES,
) -> DataFrame:
    """JSON: an array of records or one record per file, or one per line.

    Where an array file is longer than ``span`` bytes, ranges of that size are read by tasks
    of their own (see ``json_ranges``); ``lines`` files are split by Spark.  Without
    ``columns`` the names are found by reading the files once more.
    """
    stream_json_numbers(spark)
    found = None if lines else _large(spark, path, span)
    if found is not None:
        records = record_texts(found, span=span)
        if columns is None:
            names = F.explode(F.map_keys(F.from_json("record", "map<string,string>")))
            columns = sorted(r[0] for r in records.select(names).distinct().collect())
        return records.select(F.from_json("record", _text_schema(columns)).alias("r")).select("r.*")
    reader = spark.read.option("multiLine", not lines)
    if columns is None:
        columns = reader.option("primitivesAsString", True).json(path).columns
    return spark.read.option("multiLine", not lines).schema(_text_schema(columns)).json(path)


def read_keyed_json(
    spark: SparkSession, path: str, columns: list[str], span: int = RANGE_BYTES
) -> DataFrame:
    """JSON files that hold one object of records by key; in ranges as ``read_json``."""
    stream_json_numbers(spark)
    found = _large(spark, path, span)
    if found is not None:
        parsed = F.from_json("record", _text_schema(columns)).alias("r")
        return record_texts(found, True, span).select(parsed).select("r.*")
    record = T.MapType(T.StringType(), _text_schema(columns))
    whole = spark.read.text(path, wholetext=True)
    return whole.select(
        F.explode(F.map_values(F.from_json("value", record))).alias("r")
    ).select("r.*")


Reader = Callable[..., DataFrame]
READERS: dict[str, Reader] = {".csv": read_csv, ".json": read_json}


def reader_for(path: str) -> Reader | None:
    """Reader for the path's extension, None if the format is not supported."""
    return READERS.get(os.path.splitext(path.rstrip("/"))[1].lower())


def table_name(path: str) -> str:
    """Dataset name of a path, lower case."""
    return os.path.basename(path.rstrip("/")).split(".")[0].lower()


def path_table(path: Column) -> Column:
    """Dataset name of a file path as a column; empty where there is none."""
    return F.lower(F.regexp_extract(path, _DATASET, 1))


def path_run_date(path: Column) -> Column:
    return F.regexp_extract(path, _RUN_DATE, 1)


def path_run_hour(path: Column) -> Column:
    return F.regexp_extract(path, _RUN_HOUR, 1)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every file under ``root``, without reading contents."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("length").alias("file_size"))
    )


def route(files: DataFrame) -> DataFrame:
    """Table, run date and run hour of each path."""
    return files.withColumns(
        {
            "table_name": path_table(F.col("path")),
            "run_date": path_run_date(F.col("path")),
            "run_hour": path_run_hour(F.col("path")),
        }
    )
