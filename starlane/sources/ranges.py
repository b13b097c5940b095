"""Ranges of files, read by tasks of their own through Arrow's file systems."""

from __future__ import annotations

from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 64 << 20


def listed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, length and content of the files at ``paths``; contents are read only where they are used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)


def task_count(found: DataFrame, span: int) -> int:
    """Tasks for the ranges of the listed files: one for each ``RANGE_BYTES``, and as many as a
    shuffle has where ranges are shorter."""
    length = F.col("length")
    # One row of sums of the listing.
    n, spans = found.agg(F.sum(F.ceil(length / span)), F.sum(F.ceil(length / RANGE_BYTES))).first()
    least = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(int(n or 0), max(least, int(spans or 0))))


def split_files(found: DataFrame, span: int, n_tasks: int) -> DataFrame:
    """path, length and start of every range of the listed files, dealt over ``n_tasks``.

    The number of tasks is given outright: adaptive execution sees only a few short rows
    and would put them all into one task.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(span).cast("long")))
    sized = found.select("path", "length").where(F.col("length") > 0)
    return sized.select("path", "length", starts.alias("start")).repartition(n_tasks, "path", "start")


def _system(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(quote(unquote(path), safe="/:"))


def open_file(path: str) -> pa.NativeFile:
    """The file at a path as Spark writes it."""
    system, name = _system(path)
    return system.open_input_file(name)


def file_state(path: str) -> tuple[int, int] | None:
    """Size and time of the last change of a file, None if there is no such file."""
    system, name = _system(path)
    info = system.get_file_info(name)
    return (info.size, info.mtime_ns or 0) if info.type == pa.fs.FileType.File else None
