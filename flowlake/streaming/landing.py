"""Incremental pick-up of newly landed API snapshots.

The batch silver job re-reads every snapshot on each run. For a landing
folder that keeps growing, this module runs the same mapping and cleaning on
*new* snapshot files only: a Structured Streaming file source over the
landing folder, triggered with ``availableNow`` (process what has landed,
then stop), with its progress in a checkpoint folder.

A micro-batch is projected, code-filtered, cleaned and de-duplicated and
written to a folder of its own, ``increments/dataset=<name>/batch=<query>-<id>``;
its cost follows the batch, not the silver table. A batch replayed after a
failure overwrites its folder, so nothing is appended twice; the name holds the
stream's own id, so a stream with a new checkpoint takes new names.

``compact_increments`` merges the increments that it finds when it starts into
a new version of the silver table (``sources.versions``) and names them in the
commit; afterwards exactly those are deleted. An increment that lands meanwhile
is left for the next run. A failure before the commit leaves the old version
and all increments, one after it leaves the new version and increments that it
already holds, which readers and the next run pass over.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from .. import registry as R
from ..operators import silver
from ..plans import incremental
from ..sources import tables, versions
from ..sources.paths import delete_path, list_names, read_text
from ..sources.snapshots import REJECTED


def api_schema(dataset: str) -> StructType:
    """All-text schema of the snapshot fields a dataset maps (absent fields
    of a file read as NULL)."""
    return StructType([StructField(c, StringType(), True) for c in R.MAPPINGS[dataset]["api"]])


def snapshot_stream(spark: SparkSession, landing_root: str, prefix: str, dataset: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Files at any depth whose own or folder's name contains ``prefix``."""
    reader = spark.readStream.schema(api_schema(dataset)).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    name = F.col("_metadata.file_path")
    named = name.rlike(f"/[^/]*{re.escape(prefix)}[^/]*(/[^/]*)?$") & ~name.contains(f"/{REJECTED}/")
    return reader.parquet(landing_root).where(named)


def increments_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/increments/dataset={dataset}"


def ingest_increments(spark: SparkSession, landing_root: str, dataset: str, root: str,
                      checkpoint: str, prefix: str | None = None,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream that writes the new snapshot rows of
    ``dataset`` as increments under ``root``. Call ``awaitTermination()`` on
    the result to wait for it."""
    if prefix is None:
        prefix = {d: p for d, _, p in R.SILVER_TASKS}[dataset]
    stream = snapshot_stream(spark, landing_root, prefix, dataset, max_files_per_trigger)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = silver.dedup(silver.clean(silver.filter_codes(silver.project_api(batch, dataset), dataset)))
        stream_id = json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        tables.write_table(rows, f"{increments_path(root, dataset)}/batch={stream_id}-{batch_id}")

    return (stream.writeStream.foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def pending_increments(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """Names of the landed increments that the silver table does not hold yet."""
    held = versions.load(spark, tables.silver_layer(root), dataset).consumed
    return [n for n in list_names(spark, increments_path(root, dataset)) if n not in held]


def _increments(spark: SparkSession, root: str, dataset: str, names: list[str]) -> DataFrame:
    paths = [f"{increments_path(root, dataset)}/{n}" for n in names]
    return spark.read.parquet(*paths).select(*R.target_columns(dataset))


def read_with_increments(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The silver rows of ``dataset`` with all landed increments, distinct."""
    names = pending_increments(spark, root, dataset)
    state = versions.load(spark, tables.silver_layer(root), dataset)
    parts = []
    if state.version:
        parts.append(versions.read(spark, tables.silver_layer(root), dataset, state.version).select(*R.target_columns(dataset)))
    if names:
        parts.append(_increments(spark, root, dataset, names))
    return silver.dedup(reduce(lambda a, b: a.unionByName(b), parts))


def compact_increments(spark: SparkSession, root: str, dataset: str) -> int:
    """Merge the landed increments into a new version of the silver table;
    returns its rows. A bucketed table is not rewritten: the rows that are new
    become one more part (``incremental.merge``)."""
    layer = tables.silver_layer(root)
    state = versions.load(spark, layer, dataset)
    names = pending_increments(spark, root, dataset)
    if names and state.buckets:
        state = incremental.merge(_increments(spark, root, dataset, names), root, dataset, consumed=names).commit
    elif names:
        merged = read_with_increments(spark, root, dataset)
        part, rows = tables.stage_silver(merged, root, dataset)
        state = versions.commit(spark, layer, dataset, state, [part], consumed=names, rows=rows, schema=merged.schema)
    versions.vacuum(spark, layer, dataset)
    for n in state.consumed:  # also those that a failed run left behind
        delete_path(spark, f"{increments_path(root, dataset)}/{n}")
    return state.rows
