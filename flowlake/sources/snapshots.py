"""API snapshot files: JSON landing and the all-string Parquet snapshots.

A snapshot is one Parquet dataset (or file) named
``{prefix}_{yyyyMMdd_HHmmss}`` anywhere below a landing root, in dated
subfolders as well; every column is text. Reading all snapshots of a
dataset is one distributed Parquet scan with ``mergeSchema``, which stacks
files by column name and fills absent columns with NULL.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from .paths import delete_path, find_paths

#: Column that holds the text of a line which is not a JSON record.
MALFORMED = "_malformed_line"
#: Folder below the landing root for the text of such lines.
REJECTED = "_rejected"


@dataclass(frozen=True)
class Landing:
    """What ``land_json`` did: the snapshot (None if it was skipped), records
    landed, and malformed lines kept out of it."""

    path: str | None
    rows: int
    malformed: int


def snapshot_name(prefix: str, ts: _dt.datetime | str | None = None) -> str:
    if ts is None:
        ts = _dt.datetime.now(_dt.timezone.utc)
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y%m%d_%H%M%S")
    return f"{prefix}_{ts}.parquet"


def stringify(df: DataFrame) -> DataFrame:
    """Every column to text: nested values as JSON, the rest cast."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
    return df.select(out)


def _read_json(spark: SparkSession, src: str | list[str], schema: StructType | str | None) -> DataFrame:
    reader = (spark.read.option("primitivesAsString", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", MALFORMED))
    if schema is None:
        return reader.json(src)
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    return reader.schema(StructType([*schema.fields, StructField(MALFORMED, StringType())])).json(src)


def land_json(
    spark: SparkSession,
    src: str | list[str],
    landing_root: str,
    prefix: str,
    ts: _dt.datetime | str | None = None,
    schema: StructType | str | None = None,
) -> Landing:
    """Land JSON-lines records as an all-string Snappy Parquet snapshot.

    Scalars are read as text (``primitivesAsString``) so no value changes
    type on the way in; JSON nulls stay NULL. Pass ``schema`` to skip
    inference on large inputs. Lines that are no JSON record never become
    records: they are counted during the write and their text goes to
    ``{landing_root}/_rejected/{snapshot}``. Without any record nothing is
    landed (a skip).
    """
    root, name = landing_root.rstrip("/"), snapshot_name(prefix, ts)
    raw = _read_json(spark, src, schema)
    records = [c for c in raw.columns if c != MALFORMED]
    counted, rows, malformed = MALFORMED in raw.columns, 0, 0
    path = f"{root}/{name}" if records else None
    if path:
        seen, kept = Observation(), Observation()
        bad = F.count(F.col(MALFORMED)) if counted else F.lit(0).cast("long")
        raw = raw.observe(seen, F.count(F.lit(1)).alias("lines"), F.max(bad) if not counted else bad.alias("bad"))
        good = raw.where(F.col(MALFORMED).isNull()).drop(MALFORMED) if counted else raw
        good = stringify(good).observe(kept, F.count(F.lit(1)).alias("rows"))
        good.write.mode("errorifexists").option("compression", "snappy").parquet(path)
        rows, malformed = kept.get["rows"], seen.get["bad"] if counted else 0
        if not rows:
            delete_path(spark, path)
            path = None
    if counted and (malformed or not records):
        text = spark.read.text(src if isinstance(src, list) else [src]).where(F.trim("value") != "")
        whole = StructType([StructField(MALFORMED, StringType())])
        lines = text.select("value", F.from_json("value", whole, {"columnNameOfCorruptRecord": MALFORMED}).alias("r"))
        lines.where(F.col(f"r.{MALFORMED}").isNotNull()).select("value").write.mode("overwrite").text(
            f"{root}/{REJECTED}/{name}")
        if not records:
            malformed = spark.read.text(f"{root}/{REJECTED}/{name}").count()
    return Landing(path, rows, malformed)


def write_snapshot(df: DataFrame, landing_root: str, prefix: str, ts=None) -> str:
    """Write a frame as an all-string snapshot (used for API pulls that are
    already tabular)."""
    out = f"{landing_root.rstrip('/')}/{snapshot_name(prefix, ts)}"
    stringify(df).write.mode("errorifexists").option("compression", "snappy").parquet(out)
    return out


def find_snapshots(spark: SparkSession, landing_root: str, prefix: str) -> list[str]:
    """Every file or folder below the landing root, at any depth, whose name
    contains ``prefix`` (folders of rejected lines excepted)."""
    return find_paths(spark, landing_root, prefix, skip=(REJECTED,))


def read_snapshots(spark: SparkSession, landing_root: str, prefix: str) -> DataFrame | None:
    """All snapshots whose name contains ``prefix``, stacked by column name.

    Returns None when no snapshot exists (the dataset then runs on its bulk
    source alone).
    """
    paths = find_snapshots(spark, landing_root, prefix)
    if not paths:
        return None
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths)
    except Exception as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # folders without a data file
            return None
        raise
