"""A stored fact: batches that become visible by one manifest row, and an index of their keys.

A batch's rows go to a folder that no reader looks at; one row appended to the
manifest then puts the folder in the place of what the batch held before.  Until
that row is written, by a load that died or has yet to finish, readers get the
earlier rows.  A reader's snapshot is the newest manifest row of each batch.

Beside the rows lie the batch's keys, dealt by hash into a few folders.  The manifest
has the range of the first key column.  A duplicate check reads only batches whose
range meets that of the incoming keys, of those only the folders that incoming keys
hash to, and of the files only parts within the range.

Each manifest row has its batch's schema.  Readers get all columns that any batch has:
absent ones as NULL, numbers in the wider type, other differences as text.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.session import read_if_exists, remove_folder, run_number

MANIFEST = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("keys", T.StringType()),
        T.StructField("low", T.StringType()),
        T.StructField("high", T.StringType()),
    ]
)

# Folders that a batch's keys are dealt into.
BUCKETS = 16

# Marks folders of several batches; the names begin with the clock, so later ones come later.
_MANY = "-many"

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds values of both."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    numbers = (*_WHOLE, T.FloatType(), T.DoubleType())
    if a in numbers and b in numbers:
        return T.DoubleType()
    return T.StringType()


def merged(schemas: list[T.StructType]) -> T.StructType:
    """All columns in the order in which they came, in types that hold every batch's values."""
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema:
            types[field.name] = wider(types.get(field.name, field.dataType), field.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def bucket_of(keys: list[str]) -> Column:
    """The folder of a key; of its text, so that a widened type changes nothing."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(BUCKETS)).cast("int")


def _comparable(kind: T.DataType) -> bool:
    return kind in _WHOLE or isinstance(kind, T.StringType)


def _value(text: str | None, kind: T.DataType):
    """A bound as Spark orders it: whole numbers as such, text by its bytes."""
    if text is None:
        return None
    return text.encode() if isinstance(kind, T.StringType) else int(text)


@dataclass(frozen=True)
class FactTable:
    spark: SparkSession
    root: str

    @property
    def _manifest(self) -> str:
        return f"{self.root}/manifest"

    def snapshot(self) -> list[Row]:
        """The newest manifest row of each batch: one short row a batch, as a listing of files is."""
        newest = (
            read_if_exists(self.spark, self._manifest, MANIFEST)
            .groupBy("batch_id")
            .agg(F.max_by(F.struct(*MANIFEST.fieldNames()), F.struct("version", "folder")).alias("row"))
        )
        rows = [r.row for r in newest.collect()]
        return sorted(rows, key=lambda r: (r.version, r.batch_id))

    def stage(self, df: DataFrame, batch_id: str, keys: tuple[str, ...]) -> Row:
        """Write a batch and its keys where no reader looks; returns the row that commits them."""
        folder = f"{run_number()}-{uuid.uuid4().hex[:12]}"
        df = df.withColumn("batch_id", F.lit(batch_id))
        counted = Observation()
        path = f"{self.root}/rows/{folder}"
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        low = high = None
        listed = [k for k in keys if k in df.columns] if keys else []
        if listed:
            kind = df.schema[listed[0]].dataType
            found = self.spark.read.schema(df.schema).parquet(path).select(*listed, "batch_id").dropna(subset=listed)
            bounds = Observation()
            first = F.col(listed[0])
            found = found.withColumn("bucket", bucket_of(listed)).observe(
                bounds, F.min(first).cast("string").alias("low"), F.max(first).cast("string").alias("high")
            )
            found.write.partitionBy("bucket").parquet(f"{self.root}/keys/load={folder}")
            if _comparable(kind):
                low, high = bounds.get["low"], bounds.get["high"]
        return Row(*MANIFEST.fieldNames())(
            batch_id, run_number(), counted.get["rows"], folder, df.schema.json(), json.dumps(listed), low, high
        )

    def commit(self, rows: list[Row]) -> None:
        """Make staged batches what readers get, all at once."""
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(self._manifest)

    def replace(self, df: DataFrame, batch_id: str, keys: tuple[str, ...] = ()) -> int:
        """Make ``df`` all that a batch holds, even if it is empty; returns its number of rows."""
        row = self.stage(df, batch_id, keys)
        self.commit([row])
        return row.rows

    def replace_many(self, df: DataFrame, versions: dict[str, int]) -> None:
        """Make the rows of ``df`` (with batch_id) all that these batches hold, in one folder and one step.

        The batches get the versions given; one that has a later version already keeps its rows.
        """
        folder = f"{run_number()}-{uuid.uuid4().hex[:12]}{_MANY}"
        df.write.parquet(f"{self.root}/rows/{folder}")
        counts = self.spark.read.schema(df.schema).parquet(f"{self.root}/rows/{folder}").groupBy("batch_id").count()
        held = {r.batch_id: r["count"] for r in counts.collect()}  # one row a batch
        schema = df.schema.json()
        self.commit([
            Row(*MANIFEST.fieldNames())(b, v, held.get(b, 0), folder, schema, "[]", None, None)
            for b, v in sorted(versions.items())
        ])

    def _stale(self, rows: list[Row]) -> dict[str, list[str]]:
        """Batches in each folder that another folder now holds; only compacted folders have such."""
        shared = {r.folder for r in rows if r.folder.endswith(_MANY)}
        if not shared:
            return {}
        current = {(r.folder, r.batch_id) for r in rows}
        out = defaultdict(list)
        every = read_if_exists(self.spark, self._manifest, MANIFEST)
        held = every.where(F.col("folder").isin(sorted(shared))).select("folder", "batch_id").distinct()
        for r in held.collect():
            if (r.folder, r.batch_id) not in current:
                out[r.folder].append(r.batch_id)
        return out

    def read(self, rows: list[Row] | None = None) -> DataFrame | None:
        """All rows of a snapshot, the present one by default; None before the first commit.

        Folders of one schema are read together.
        """
        rows = self.snapshot() if rows is None else rows
        if not rows:
            return None
        whole = merged([T.StructType.fromJson(json.loads(r.schema)) for r in rows])
        names = [c for c in whole.fieldNames() if c != "batch_id"] + ["batch_id"]
        stale = self._stale(rows)
        groups: dict[tuple, set[str]] = defaultdict(set)
        for r in rows:
            groups[r.schema, tuple(sorted(stale.get(r.folder, ())))].add(f"{self.root}/rows/{r.folder}")
        parts = []
        for (schema, gone), paths in groups.items():
            own = T.StructType.fromJson(json.loads(schema))
            part = self.spark.read.schema(own).parquet(*sorted(paths))
            if gone:
                part = part.where(~F.col("batch_id").isin(*gone))
            have = set(own.fieldNames())
            parts.append(part.select([
                (F.col(f"`{c}`") if c in have else F.lit(None)).cast(whole[c].dataType).alias(c) for c in names
            ]))
        return reduce(DataFrame.unionByName, parts)

    def known_keys(self, incoming: DataFrame, keys: list[str], without: str) -> DataFrame | None:
        """Stored keys, of batches other than ``without``, among which all of ``incoming``'s are that are stored.

        None if no stored batch can hold any of them.
        """
        rows = [r for r in self.snapshot() if r.batch_id != without and r.rows]
        if not rows:
            return None
        if any(json.loads(r.keys) != keys for r in rows):
            return self.read(rows).select(*keys)  # stored without an index of these keys
        kind = incoming.schema[keys[0]].dataType
        first = F.col(keys[0])
        met = incoming.dropna(subset=keys).agg(
            F.min(first).cast("string").alias("low"), F.max(first).cast("string").alias("high"),
            F.collect_set(bucket_of(keys)).alias("buckets"),  # at most BUCKETS numbers
        ).first()
        if not met.buckets:
            return None
        types = [T.StructType.fromJson(json.loads(r.schema)) for r in rows]
        same = _comparable(kind) and all(t[keys[0]].dataType == kind for t in types)
        if same:
            low, high = _value(met.low, kind), _value(met.high, kind)
            rows = [r for r in rows if r.low is None or (_value(r.low, kind) <= high and _value(r.high, kind) >= low)]
            if not rows:
                return None
        whole = merged(types)
        stale = self._stale(rows)
        held = T.StructType([whole[k] for k in keys] + [
            T.StructField("batch_id", T.StringType()), T.StructField("load", T.StringType()),
            T.StructField("bucket", T.IntegerType()),
        ])
        folders = sorted({r.folder for r in rows})
        stored = (
            self.spark.read.schema(held).option("basePath", f"{self.root}/keys")
            .parquet(*[f"{self.root}/keys/load={f}" for f in folders])
            .where(F.col("bucket").isin(*sorted(met.buckets)) & (F.col("batch_id") != without))
        )
        if same:
            stored = stored.where(first.between(F.lit(met.low).cast(kind), F.lit(met.high).cast(kind)))
        for folder, gone in stale.items():
            stored = stored.where(~((F.col("load") == folder) & F.col("batch_id").isin(*gone)))
        return stored.select(*keys)

    def compact(self, small: int = 1_000_000) -> int:
        """Put all batches of fewer than ``small`` rows into one folder, keys in order; returns how many.

        Batches keep their names, so each can be replaced afterwards as before.  A batch
        that is replaced meanwhile stays replaced: its row is newer.
        """
        rows = [r for r in self.snapshot() if r.rows < small]
        if len(rows) < 2:
            return 0
        folder = f"{run_number()}-{uuid.uuid4().hex[:12]}{_MANY}"
        whole = self.read(rows)
        keys = json.loads(rows[0].keys)
        keys = keys if all(json.loads(r.keys) == keys for r in rows) else []
        if keys:
            whole = whole.repartitionByRange(*keys).sortWithinPartitions(*keys)
        whole.write.parquet(f"{self.root}/rows/{folder}")
        if keys:
            listed = whole.select(*keys, "batch_id").dropna(subset=keys).withColumn("bucket", bucket_of(keys))
            listed.repartitionByRange("bucket", *keys).sortWithinPartitions("bucket", *keys).write.partitionBy(
                "bucket"
            ).parquet(f"{self.root}/keys/load={folder}")
        schema = whole.schema.json()
        self.commit([
            Row(*MANIFEST.fieldNames())(r.batch_id, r.version, r.rows, folder, schema, json.dumps(keys), r.low, r.high)
            for r in rows
        ])
        return len(rows)

    def expire(self) -> int:
        """Remove folders that the present snapshot does not name; returns how many.

        Only while no reader of an earlier snapshot and no writer is at work.
        """
        named = {r.folder for r in self.snapshot()}
        old = read_if_exists(self.spark, self._manifest, MANIFEST).select("folder").distinct()
        gone = sorted({r.folder for r in old.collect()} - named)
        for folder in gone:
            remove_folder(self.spark, f"{self.root}/keys/load={folder}")
        return sum(remove_folder(self.spark, f"{self.root}/rows/{folder}") for folder in gone)

