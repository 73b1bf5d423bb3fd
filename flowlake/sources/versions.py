"""Versioned Parquet tables: every write goes to a folder of its own.

A table ``name`` of a layer folder has its record in
``{layer}/dataset={name}/_commits`` and its data in *parts*, folders
``{layer}/parts/{unique}/dataset={name}`` that are never written twice. A
commit is one small JSON file, ``{version}.json``, that names the parts which
make up the table, the increments they hold and the fingerprint of the inputs
they were built from. It is written under a temporary name and moved to its
own, so at every moment the table is what the highest commit says: a writer
that dies before the move leaves the old version, one that dies after it
leaves the new one. Parts that no commit names are invisible; ``vacuum``
removes them, and old versions, once nobody can be writing or reading them.

Two writers of one table: the second move finds its version taken and fails
with ``Conflict``, its parts unnamed; nothing is lost, the caller merges again.
A file system whose rename replaces an existing target must give the table one
writer at a time.

Bucketed parts hold the rows dealt by a hash of the whole row
(``ROW_HASH``), one file per bucket, so that later increments can be compared
with them without a shuffle of what is stored (``distinct_from``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.joins import input_bytes
from .paths import delete_path, list_names, move_new, path_exists, read_text, write_text

#: Column of bucketed parts: a hash of all other columns.
ROW_HASH = "_row_hash"

#: Bytes of input per bucket, and the most buckets that Spark takes.
BUCKET_BYTES, MAX_BUCKETS = 32 << 20, 100_000


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Commit:
    """A version of a table."""

    version: int = 0
    parts: tuple[str, ...] = ()  # relative to the layer folder
    consumed: tuple[str, ...] = ()  # increments merged into this version
    buckets: int | None = None  # of every part, if all are bucketed
    rows: int | None = None
    inputs: str | None = None
    schema: dict | None = None
    extra: dict = field(default_factory=dict)


def home(layer: str, name: str) -> str:
    return f"{layer.rstrip('/')}/dataset={name}"


def _commits(layer: str, name: str) -> str:
    return f"{home(layer, name)}/_commits"


def history(spark: SparkSession, layer: str, name: str) -> list[int]:
    """The versions of a table, ascending; an absent table has none."""
    found = list_names(spark, _commits(layer, name))
    return sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, layer: str, name: str, version: int | None = None) -> Commit:
    """A version of a table (the current one); version 0 is the table that nobody has written."""
    if version is None:
        version = (history(spark, layer, name) or [0])[-1]
    if not version:
        return Commit()
    raw = json.loads(read_text(spark, f"{_commits(layer, name)}/{version:010d}.json"))
    return Commit(**raw | {"parts": tuple(raw["parts"]), "consumed": tuple(raw["consumed"])})


def new_part(layer: str, name: str | None = None) -> tuple[str, str]:
    """A fresh part: its name for the commit and its path. Without a table name, the folder above
    the parts of several tables that one job writes with ``partitionBy("dataset")``."""
    part = f"parts/{uuid.uuid4().hex}" + (f"/dataset={name}" if name else "")
    return part, f"{layer.rstrip('/')}/{part}"


def commit(spark: SparkSession, layer: str, name: str, after: Commit, parts: Iterable[str],
           consumed: Iterable[str] = (), buckets: int | None = None, rows: int | None = None,
           inputs: str | None = None, schema: T.StructType | None = None, **extra) -> Commit:
    """Make ``parts`` the table, as the version after ``after``, whose schema it keeps if none is given."""
    told = json.loads(schema.json()) if schema is not None else after.schema
    new = Commit(after.version + 1, tuple(parts), tuple(consumed), buckets, rows, inputs, told, extra)
    folder = _commits(layer, name)
    aside = f"{folder}/_{uuid.uuid4().hex}.tmp"
    write_text(spark, aside, json.dumps(asdict(new)))
    if not move_new(spark, aside, f"{folder}/{new.version:010d}.json"):
        raise Conflict(f"version {new.version} of {home(layer, name)} is taken")
    return new


def paths(layer: str, state: Commit) -> list[str]:
    return [f"{layer.rstrip('/')}/{p}" for p in state.parts]


def read(spark: SparkSession, layer: str, name: str, version: int | None = None) -> DataFrame:
    """The rows of a version; fails if nobody has written the table."""
    state = load(spark, layer, name, version)
    if not state.version:
        raise FileNotFoundError(f"no version of {home(layer, name)}")
    return read_parts(spark, layer, state, state.parts)


def read_parts(spark: SparkSession, layer: str, state: Commit, parts: Iterable[str]) -> DataFrame:
    """The rows of some parts of a version."""
    reader = spark.read.schema(T.StructType.fromJson(state.schema))
    return reader.parquet(*(f"{layer.rstrip('/')}/{p}" for p in parts))


def vacuum(spark: SparkSession, layer: str, name: str, keep: int = 2) -> int:
    """Remove the parts of a table that its last ``keep`` versions do not name, and older commits.

    Parts of writers at work count as unnamed: run it when no job writes the
    layer. Returns the number of parts removed."""
    versions = history(spark, layer, name)
    named = {p for v in versions[-keep:] for p in load(spark, layer, name, v).parts}
    removed = 0
    for unique in list_names(spark, f"{layer.rstrip('/')}/parts"):
        part = f"parts/{unique}/dataset={name}"
        if part not in named and path_exists(spark, f"{layer.rstrip('/')}/{part}"):
            delete_path(spark, f"{layer.rstrip('/')}/{part}")
            removed += 1
    for v in versions[:-keep]:
        delete_path(spark, f"{_commits(layer, name)}/{v:010d}.json")
    return removed


# ---------------------------------------------------------------- bucketed parts


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 8) -> int:
    """Buckets for a table of the rows of ``df``: one per ``bucket_bytes`` of the tables it reads, so that a task
    that compares a bucket holds as much of a large table as of a small one."""
    return min(MAX_BUCKETS, max(least, -(-(input_bytes(df) or 0) // bucket_bytes)))


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row, columns by name."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in sorted(df.columns)))


def write_bucketed(pieces: Iterable[DataFrame], path: str, buckets: int) -> None:
    """Write a part whose rows, given as one frame or several, are dealt to ``buckets`` by their hash: a file each,
    if the frames hold different buckets."""
    name, df = f"flowlake_{uuid.uuid4().hex}", None
    try:
        for df in pieces:
            dealt = df.withColumn(ROW_HASH, row_hash(df)).repartition(buckets, ROW_HASH)
            writer = dealt.write.mode("append").bucketBy(buckets, ROW_HASH).sortBy(ROW_HASH)
            writer.option("path", path).format("parquet").saveAsTable(name)
    finally:
        if df is not None:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int) -> DataFrame:
    """A bucketed part with its buckets known to the planner, ``ROW_HASH`` included."""
    name = f"flowlake_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}, `{ROW_HASH}` bigint) USING parquet "
              f"CLUSTERED BY ({ROW_HASH}) SORTED BY ({ROW_HASH}) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def distinct_from(rows: DataFrame, layer: str, state: Commit) -> DataFrame:
    """The different ``rows`` that no part of a bucketed table holds.

    The rows are shuffled once, to the table's buckets; every part is scanned
    where it lies. Rows meet by their hash and are then compared whole, null
    like null, so two different rows with one hash both stay."""
    spark = rows.sparkSession
    names = sorted(rows.columns)
    left = rows.dropDuplicates()
    left = left.withColumn(ROW_HASH, row_hash(rows)).repartition(state.buckets, ROW_HASH)
    left = left.withColumn("_row", F.struct(*(F.col(f"`{c}`") for c in names)))
    for path in paths(layer, state):
        part = read_bucketed(spark, path, T.StructType.fromJson(state.schema), state.buckets)
        part = part.select(F.col(ROW_HASH).alias("_hash"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("_other"))
        # an equality of the rows would become a join key, which the buckets are not dealt by
        same = F.array_contains(F.array("_other"), F.col("_row"))
        left = left.join(part, (F.col(ROW_HASH) == F.col("_hash")) & same, "left_anti")
    return left.select(*rows.columns)
