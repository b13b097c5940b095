"""Session defaults and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Options that matter for skewed and uneven data; all can be set at run time.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(app: str, cores: str = "8", **options: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in {**SQL_DEFAULTS, **options}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master, where one process is the whole cluster, may fall back
    to a temporary folder; elsewhere, ``local-cluster`` included, an unset option
    is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="starlane-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/starlane/{label}-{uuid.uuid4().hex}"


def run_number() -> int:
    """Rising number for a run: the clock in milliseconds.

    All jobs that write to one store must number their runs the same way.
    """
    return int(time.time() * 1000)


# Spark's option that removes an execution's shuffle files at its end.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path``, replacing what is there, and read it back.

    The shuffle files of the write go with its end: readers take what was written.
    """
    conf = df.sparkSession.conf
    usual = conf.get(_RELEASE, "false")
    conf.set(_RELEASE, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.set(_RELEASE, usual)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Folders that the innermost ``scratch`` deletes; None outside of any.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh path of the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimizer the real size of the result.  Inside ``scratch`` the folder goes
    with its end.
    """
    path = new_folder(df.sparkSession, label)
    folders = _SCRATCH.get()
    if folders is not None:
        folders.append(path)
    return write_and_read(df, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes at its end what ``materialize`` writes inside.

    Gives a function that materializes what is to stay: a frame that is used
    after the end must read nothing else that was written inside.
    """
    outer, folders = _SCRATCH.get(), []

    def keep(df: DataFrame, label: str) -> DataFrame:
        inside = _SCRATCH.set(outer)
        try:
            return materialize(df, label)
        finally:
            _SCRATCH.reset(inside)

    token = _SCRATCH.set(folders)
    try:
        yield keep
    finally:
        _SCRATCH.reset(token)
        for folder in folders:
            remove_folder(spark, folder)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(
        [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table at ``path``, or an empty frame of ``schema`` before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, schema)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this engine wrote, wherever it is stored; whether there was one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
