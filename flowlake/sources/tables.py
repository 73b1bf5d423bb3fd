"""Silver and gold table IO.

Tables are written as Parquet datasets (many part files, one per task), not
as a single file: funnelling a large table through one writer task would
serialise the whole write. Silver tables are versioned (``versions``): a write
goes to a folder of its own and becomes the table by one small commit, so
readers see the old rows or the new ones. Gold tables that the views filter by cycle can be partitioned on
``election_cycle`` so a drill-down reads one folder; rows are clustered by
the partition column before such a write (adaptive execution splits a large
value over several tasks), so the number of files follows the data, not
tasks x values; a table written in pieces is not clustered. The cycles of each gold table are collected during its write
and kept in a small table, so a list of cycles scans no gold table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..registry import GOLD_INPUTS
from . import versions
from .paths import delete_path, move_folder

GOLD_TABLES = ("geo_summary", "donor_type_summary", "network_metrics")
GOLD_SCHEMAS = {
    "geo_summary": "cand_id string, cand_name string, office_type string, election_cycle string, "
                   "state string, total_amount double, total_donations bigint",
    "donor_type_summary": "cand_id string, cand_name string, election_cycle string, "
                          "individual_funds double, committee_funds double",
    "network_metrics": "source_node string, source_type string, target_node string, "
                       "transaction_flow string, election_cycle string, weight double, "
                       "transaction_count bigint",
}
CYCLES = "cycles"
REJECTED_PREFIX = "rejected_"
REJECTED_SCHEMA = "reason string, line string, file string, line_id bigint"


def table_path(root: str, layer: str, name: str) -> str:
    folder = f"dataset={name}" if layer == "silver" else name
    return f"{root.rstrip('/')}/{layer}/{folder}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                observe: bool = False, mode: str | None = None, rebalance: bool = True,
                append: bool = False, compression: str = "snappy") -> dict | None:
    """Overwrite a Parquet table (Snappy), or append to it. With ``observe`` the row count is
    collected as a metric of the write itself, not by a second scan; ``mode``
    is the partition overwrite mode. Rows are clustered by the partition
    columns first unless ``rebalance`` is False."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    obs = None
    if observe:
        obs = Observation("rows_written")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode("append" if append else "overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if mode:
        w = w.option("partitionOverwriteMode", mode)
    w.parquet(path)
    return obs.get if obs is not None else None


def silver_layer(root: str) -> str:
    return f"{root.rstrip('/')}/silver"


def silver_paths(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """The folders that hold the current version of a silver table (none if it was never written)."""
    return versions.paths(silver_layer(root), versions.load(spark, silver_layer(root), dataset))


def stage_silver(df: DataFrame, root: str, dataset: str, buckets: int | None = None,
                 pieces: Iterable[DataFrame] | None = None) -> tuple[str, int]:
    """Write a part of a silver table that no version names yet: its name and its rows. With ``pieces``, frames
    that make up ``df``, they are written one after the other and ``df`` gives the schema alone."""
    part, path = versions.new_part(silver_layer(root), dataset)
    several = [df] if pieces is None else pieces
    if buckets:
        versions.write_bucketed(several, path, buckets)
        return part, df.sparkSession.read.schema(df.schema).parquet(path).count()  # from the files' footers
    return part, sum(write_table(piece, path, observe=True, append=i > 0)["rows"] for i, piece in enumerate(several))


def write_silver(df: DataFrame, root: str, dataset: str, observe: bool = False, buckets: int | None = None,
                 pieces: Iterable[DataFrame] | None = None):
    """Replace a silver table by a new version; with ``buckets`` its rows are
    dealt by their hash, for ``incremental.merge``; ``pieces`` as in ``stage_silver``."""
    layer = silver_layer(root)
    part, rows = stage_silver(df, root, dataset, buckets, pieces)
    after = versions.load(df.sparkSession, layer, dataset)
    versions.commit(df.sparkSession, layer, dataset, after, [part], buckets=buckets, rows=rows,
                    schema=df.schema)
    return {"rows": rows} if observe else None


def stage_split_silver(df: DataFrame, root: str, datasets: Iterable[str],
                       optional: Iterable[str] = ()) -> dict[str, tuple[str | None, int]]:
    """Datasets cut from one source (``dataset`` column) in one write: part
    and rows of each; a dataset without rows gets an empty part, an
    ``optional`` one none. With a few labels every task writes its own files;
    ``session.sized_for`` lets it do so without sorting its rows."""
    datasets, optional = list(datasets), list(optional)
    group, path = versions.new_part(silver_layer(root))
    obs = Observation()
    counts = [F.count(F.when(F.col("dataset") == d, 1)).alias(d) for d in datasets + optional]
    write_table(df.observe(obs, *counts), path, partition_by=["dataset"], rebalance=False)
    for d in datasets:
        if not obs.get[d]:
            write_table(df.drop("dataset").limit(0), f"{path}/dataset={d}")
    return {d: (f"{group}/dataset={d}" if d in datasets or obs.get[d] else None, obs.get[d])
            for d in datasets + optional}


def write_split_silver(df: DataFrame, root: str, datasets: Iterable[str]) -> dict[str, int]:
    """Replace several silver tables by one write; returns the rows of each.
    A dataset without rows becomes an empty table instead of keeping its old rows."""
    spark, layer = df.sparkSession, silver_layer(root)
    staged = stage_split_silver(df, root, datasets)
    for d, (part, rows) in staged.items():
        versions.commit(spark, layer, d, versions.load(spark, layer, d), [part], rows=rows,
                        schema=df.drop("dataset").schema)
    return {d: rows for d, (_, rows) in staged.items()}


def load_split_silver(spark: SparkSession, root: str, datasets: Iterable[str]) -> DataFrame:
    """Several datasets of equal columns with their ``dataset`` label."""
    parts = [versions.read(spark, silver_layer(root), d).withColumn("dataset", F.lit(d)) for d in datasets]
    return reduce(lambda a, b: a.unionByName(b), parts)


def load_silver(spark: SparkSession, root: str, datasets=GOLD_INPUTS) -> dict[str, DataFrame]:
    """All silver inputs of the gold job; fails if any is missing."""
    return {d: versions.read(spark, silver_layer(root), d) for d in datasets}


def load_rejected(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The lines that the current load of a silver table could not read in
    full: reason, line, file and a number (see ``operators.silver``)."""
    layer, name = silver_layer(root), f"{REJECTED_PREFIX}{dataset}"
    if not versions.load(spark, layer, name).parts:
        return spark.createDataFrame([], REJECTED_SCHEMA)
    return versions.read(spark, layer, name)


def cycles_path(root: str, name: str) -> str:
    return table_path(root, "gold", f"{CYCLES}/table={name}")


def load_cycles(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The distinct cycles of a gold table, written with it."""
    return spark.read.schema("election_cycle string").parquet(cycles_path(root, name))


def write_gold(tables: Mapping[str, DataFrame], root: str, partition_by_cycle: bool = False,
               max_parallel: int = 1, pieces: Mapping[str, Iterable[DataFrame]] | None = None) -> None:
    """Write the gold tables; with ``max_parallel`` > 1 as concurrent jobs.

    A table that has ``pieces``, frames that make up its rows, is written from them, one after the other
    and without clustering them by cycle: a piece's shuffles are of its own size, and with
    ``session.sized_for`` they are gone before the next one starts. The table gets its name after the last
    piece; until then there is none, as while any table is overwritten."""
    from concurrent.futures import ThreadPoolExecutor

    def one(item):
        name, df = item
        try:
            df.sparkSession.sparkContext.setJobDescription(f"gold {name}")
        except Exception:
            pass
        path = table_path(root, "gold", name)
        if "election_cycle" not in df.columns:
            write_table(df, path)
            return
        cycles, by = set(), ["election_cycle"] if partition_by_cycle else None
        several = (pieces or {}).get(name)
        if several is not None:
            delete_path(df.sparkSession, path)
            path = table_path(root, "gold", f"_{name}")
        for i, piece in enumerate([df] if several is None else several):
            obs = Observation()  # a few years, whatever the rows
            seen = piece.observe(obs, F.collect_set("election_cycle").alias("cycles"),
                                 F.count_if(F.col("election_cycle").isNull()).alias("without"))
            write_table(seen, path, partition_by=by, rebalance=several is None, append=i > 0)
            cycles |= {(c,) for c in obs.get["cycles"]} | ({(None,)} if obs.get["without"] else set())
        if several is not None:
            move_folder(df.sparkSession, path, table_path(root, "gold", name))
        cycles = sorted(cycles, key=lambda c: (c[0] is not None, c))
        write_table(df.sparkSession.createDataFrame(cycles, "election_cycle string").coalesce(1), cycles_path(root, name))

    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(tables)))) as pool:
        list(pool.map(one, tables.items()))


def load_gold(spark: SparkSession, root: str, names=GOLD_TABLES, cache: bool = False) -> dict[str, DataFrame]:
    """Gold tables for the views. ``cache`` keeps them in executor memory
    (serialized, spill to disk) for repeated interactive drill-downs."""
    from pyspark import StorageLevel

    out = {n: spark.read.schema(GOLD_SCHEMAS[n]).parquet(table_path(root, "gold", n)) for n in names}
    if cache:
        out = {n: df.persist(StorageLevel.MEMORY_AND_DISK) for n, df in out.items()}
    return out
