"""The layered job: bronze files -> silver tables -> gold tables.

``run_silver`` builds every registered silver dataset; datasets cut from the
same bulk file (``itpas2.txt``) are built from one scan and one distinct.
``run_gold`` reads the silver tables back and writes the three gold tables.
Each layer is written to storage before the next reads it, so a lost
executor only repeats work of the current layer.

A silver table is staged, checked and only then published: its write
collects how many values the cleaning rules could not read, and with
``max_bad_share`` a table with more of them than that keeps its old version.
A published version records the fingerprint of its input files, so with
``resume`` a second run after a failure builds only what is missing or whose
inputs have changed.
"""

from __future__ import annotations

import hashlib
import logging
from collections import OrderedDict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import registry as R
from ..operators import gold, silver
from ..session import sized_for
from ..sources import snapshots, tables, versions
from ..sources.paths import delete_path, fingerprint, path_exists, size_of

log = logging.getLogger(__name__)


def _tasks_by_file(tasks):
    groups: OrderedDict[str, list[tuple[str, str]]] = OrderedDict()
    for dataset, bulk_file, prefix in tasks:
        groups.setdefault(bulk_file, []).append((dataset, prefix))
    return groups


def _describe(spark: SparkSession, text: str) -> None:
    """Label the jobs of the current thread (shown in the event log)."""
    try:
        spark.sparkContext.setJobDescription(text)
    except Exception:
        pass


def _observe_bulk(df: DataFrame | None):
    """Raw rows and malformed rows (wrong field count), counted while the
    write job scans the file."""
    if df is None:
        return None, None
    obs = Observation()
    # A metric over every raw column keeps the whole row in the scan; with
    # CSV column pruning the parser would otherwise tokenize only the mapped
    # columns and never notice a row with the wrong field count. (A
    # non-nullable expression such as a struct would be folded to count(1).)
    raw = [F.col(f"`{c}`") for c in df.columns if c != silver.CORRUPT_COLUMN and not c.startswith("_origin")]
    return df.observe(obs, F.count(F.lit(1)).alias("bulk_rows"),
                      F.count(silver.CORRUPT_COLUMN).alias("malformed_rows"),
                      F.count(F.coalesce(*raw)).alias("non_empty_rows")), obs


def _observe_rows(df: DataFrame | None, name: str):
    if df is None:
        return None, None
    obs = Observation()
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def _metrics(*observations) -> dict:
    out: dict = {}
    for o in observations:
        if o is not None:
            out.update(o.get)
    return out


def _inputs(spark: SparkSession, bulk_path: str | None, landing_root: str | None, prefix: str) -> str:
    """A hash of the names, sizes and times of a dataset's input files."""
    found = [bulk_path] if bulk_path and path_exists(spark, bulk_path) is not False else []
    found += snapshots.find_snapshots(spark, landing_root, prefix) if landing_root else []
    return hashlib.sha256(fingerprint(spark, *found).encode()).hexdigest()


def bad_share(metrics: dict) -> float:
    """The largest share of unreadable values that any column's cleaning rule met."""
    rows = metrics.get("candidate_rows") or 0
    return max((v / rows for k, v in metrics.items() if k.startswith("bad_") and rows), default=0.0)


def _publish(spark, root, dataset, part, rejected, schema, metrics, inputs, max_bad_share) -> dict:
    """Make a staged part the table, unless too many of its values were
    unreadable. The rejected lines are published in either case."""
    layer = tables.silver_layer(root)
    name, lines = f"{tables.REJECTED_PREFIX}{dataset}", [rejected] if rejected else []
    versions.commit(spark, layer, name, versions.load(spark, layer, name), lines, rows=metrics["rejected_lines"],
                    schema=StructType.fromDDL(tables.REJECTED_SCHEMA))
    versions.vacuum(spark, layer, name)
    published = max_bad_share is None or bad_share(metrics) <= max_bad_share
    if published:
        versions.commit(spark, layer, dataset, versions.load(spark, layer, dataset), [part], rows=metrics["rows"],
                        inputs=inputs, schema=schema, metrics=metrics)
        versions.vacuum(spark, layer, dataset)
    else:
        log.warning("%s: %.3f of a column is unreadable; the old version stays", dataset, bad_share(metrics))
        delete_path(spark, f"{layer}/{part}")
    return {**metrics, "published": published}


def _build_group(spark: SparkSession, bulk_file: str, group, bronze_root, landing_root, out_root, layouts,
                 max_bad_share=None, resume=False):
    """Read the sources of one bulk file's dataset(s) once, build, stage,
    publish. Returns per-dataset metrics observed during the write (no extra
    scans)."""
    _describe(spark, "silver " + "+".join(d for d, _ in group))
    bulk_path = f"{bronze_root.rstrip('/')}/{bulk_file}" if bronze_root else None
    inputs = {d: _inputs(spark, bulk_path, landing_root, prefix) for d, prefix in group}
    if resume:
        done = {d: versions.load(spark, tables.silver_layer(out_root), d) for d, _ in group}
        if all(done[d].inputs == inputs[d] for d in done):
            return {d: {**done[d].extra["metrics"], "published": True, "resumed": True} for d in done}
    bulk, bulk_obs = _observe_bulk(silver.with_origin(
        silver.read_bulk(spark, bulk_path, layouts.get(bulk_file), flag_corrupt=True)))
    api, api_obs = {}, {}
    for d, prefix in group:
        raw = snapshots.read_snapshots(spark, landing_root, prefix) if landing_root else None
        api[d], api_obs[d] = _observe_rows(silver.with_origin(raw), "api_rows")
    if bulk is None and all(v is None for v in api.values()):
        log.warning("no source for %s; skipped", [d for d, _ in group])
        return {}
    counters = Observation()
    datasets = tuple(d for d, _ in group)
    out = silver.silver_and_rejected(bulk, api, datasets, counters)
    schema = out.select(R.target_columns(datasets[0])).schema
    aside = {d: f"{tables.REJECTED_PREFIX}{d}" for d in datasets}
    staged = tables.stage_split_silver(out, out_root, datasets, aside.values())
    shared, done = _metrics(bulk_obs, counters), {}
    for d in datasets:
        (part, rows), (lines, n) = staged[d], staged[aside[d]]
        metrics = {**shared, **_metrics(api_obs[d]), "rows": rows, "rejected_lines": n}
        done[d] = _publish(spark, out_root, d, part, lines, schema, metrics, inputs[d], max_bad_share)
    return done


def run_silver(spark: SparkSession, bronze_root: str | None, landing_root: str | None, out_root: str,
               tasks=R.SILVER_TASKS, layouts: dict[str, list[str]] | None = None,
               max_parallel: int = 4, max_bad_share: float | None = None, resume: bool = False
               ) -> dict[str, dict | None]:
    """Build and publish all silver tables. Returns per-dataset metrics
    observed during the write job itself: ``bulk_rows`` and
    ``malformed_rows`` of the bulk scan, ``api_rows`` of the snapshots,
    ``bad_*`` and ``sub_cent_*`` values met by the cleaning rules (for a
    split source, over all its datasets), ``rows`` written, ``rejected_lines``
    kept whole beside the table (``tables.load_rejected``) in the same pass
    over the sources, and whether the rows were ``published``. A dataset with no source at all is skipped; one with
    more than ``max_bad_share`` unreadable values in a column keeps its old
    version; with ``resume`` one whose input files are those of its current
    version is left as it is.

    The datasets are independent jobs; up to ``max_parallel`` of them are
    submitted at once (Spark runs concurrent jobs side by side), so the
    cluster is not idle during the tail of each small job. Shuffles are sized
    for the input."""
    layouts = {**R.BULK_LAYOUTS, **(layouts or {})}
    groups = list(_tasks_by_file(tasks).items())
    inputs = [f"{bronze_root.rstrip('/')}/{f}" for f, _ in groups] if bronze_root else []
    size = size_of(spark, *inputs, *([landing_root] if landing_root else []))
    done: dict[str, dict | None] = {}
    with sized_for(spark, size), ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(groups)))) as pool:
        futures = [pool.submit(_build_group, spark, f, g, bronze_root, landing_root, out_root, layouts,
                               max_bad_share, resume) for f, g in groups]
        for fut in futures:
            done.update(fut.result())
    return done


def run_gold(spark: SparkSession, root: str, partition_by_cycle: bool = True, max_parallel: int = 3,
             **edge_params) -> dict[str, int]:
    """Read the six silver tables and write the three gold tables (as
    concurrent jobs), with shuffles sized for the silver tables. Returns the
    number of cycle list elements that were no number."""
    shared = tables.table_path(root, "gold", "_shared_committee_state")
    silver_in = tables.load_silver(spark, root)
    size = size_of(spark, *(p for d in silver_in for p in tables.silver_paths(spark, root, d)))
    with sized_for(spark, size):
        built = gold.build_gold(silver_in, shared_path=shared, **edge_params)
        network = gold.network_pieces(*gold.network_inputs(silver_in), **edge_params)
        tables.write_gold(built, root, partition_by_cycle=partition_by_cycle, max_parallel=max_parallel,
                          pieces={"network_metrics": network})
        bad = silver_in["candidate_master"].agg(F.sum(gold.rejected_cycles()).alias("n")).first().n
    delete_path(spark, shared)
    return {"bad_cycles": bad or 0}


def run_all(spark: SparkSession, bronze_root: str | None, landing_root: str | None, root: str) -> dict:
    metrics = run_silver(spark, bronze_root, landing_root, root)
    return {**metrics, "gold": run_gold(spark, root)}
