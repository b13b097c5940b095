"""Ledger of processed files, keyed by the digest of their content.

A renamed copy of a processed file has the same digest and is skipped.  A file too
large to be one value is digested range by range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.operators.lookup import lookup_join
from starlane.sources.ranges import RANGE_BYTES, listed, open_file, split_files, task_count

SCHEMA = T.StructType(
    [
        T.StructField("file_hash", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("processed_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


# From this size on a file is read in ranges.
LARGE_BYTES = 256 << 20


def hash_files(
    spark: SparkSession, paths: str | list[str], large: int = LARGE_BYTES, span: int = RANGE_BYTES
) -> DataFrame:
    """Digest, path and size of the files at ``paths``, hashed by the executors.

    The digest of a file below ``large`` bytes is the SHA-256 of its content.  A larger one's
    is the SHA-256 of its ranges' SHA-256 digests, one after the other as text; ranges are
    read by tasks of their own, so a file may have any size.  Which of both a file gets
    depends on its size alone, so copies agree.
    """
    found = listed(spark, paths)
    size = F.col("length").alias("file_size")
    # A filter on the length keeps Spark from opening the others.
    whole = found.where(F.col("length") < large).select(
        F.sha2("content", 256).alias("file_hash"), "path", size
    )
    beyond = found.where(F.col("length") >= max(large, 1))
    digests = split_files(beyond, span, task_count(beyond, span)).mapInArrow(
        _digests(span), "path string, file_size long, start long, digest string"
    )
    # One short text for each range of a file.
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("start", "digest"))), lambda r: r["digest"])
    parts = digests.groupBy("path", "file_size").agg(F.sha2(F.array_join(ordered, "").cast("binary"), 256).alias("file_hash"))
    return whole.unionByName(parts)


def _digests(span: int):
    """Reads ranges of files through Arrow's file systems, a piece at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                digest, left = hashlib.sha256(), min(span, r["length"] - r["start"])
                with open_file(r["path"]) as source:
                    source.seek(r["start"])
                    while left:
                        piece = source.read(min(left, 1 << 20))
                        if not piece:
                            raise OSError(f"{r['path']} became shorter while it was read")
                        digest.update(piece)
                        left -= len(piece)
                out.append((r["path"], r["length"], r["start"], digest.hexdigest()))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["path", "file_size", "start", "digest"],
            )

    return run


def new_files(hashed: DataFrame, ledger: DataFrame) -> DataFrame:
    """One path per content not yet in the ledger."""
    first = hashed.groupBy("file_hash").agg(
        F.min("path").alias("path"), F.max("file_size").alias("file_size")
    )
    return lookup_join(first, ledger.select("file_hash").distinct(), ["file_hash"], "left_anti")


def ledger_rows(files: DataFrame, batch_id: str) -> DataFrame:
    return files.select(
        "file_hash",
        "path",
        "file_size",
        F.current_timestamp().cast("timestamp_ntz").alias("processed_at"),
        F.lit(batch_id).alias("batch_id"),
    )
