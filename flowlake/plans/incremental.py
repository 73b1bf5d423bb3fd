"""Increments: silver rows merged without a rebuild, gold kept from partial sums.

Silver. A silver table written with buckets holds its rows dealt by a hash of
the row. ``merge`` brings an increment into it: the increment is shuffled to
the table's buckets, compared there with what is stored, and the rows that
are new become one more part of the next version. The stored rows are read,
but neither shuffled nor written again; the result is what a DISTINCT over
everything would give. After ``MAX_PARTS`` parts they are folded into one.

Gold. Every gold measure is a sum of cents or a count of rows, so it can be
kept as partial sums by key (``PARTIALS``), which do not depend on the
registers. ``refresh`` adds the sums of those silver parts that a partial
table does not hold yet; its commit names the parts it holds, so a part is
never added twice or left out, whenever the job stops. ``gold_tables`` joins
the partials with the current registers and applies absolute values, floors
and thresholds to the merged sums only, so sums that turn out negative or
small after a later increment come out as a full run gives them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold
from ..sources import tables, versions

#: Parts of a table before they are folded into one.
MAX_PARTS = 32

#: Partial sums: silver dataset and key.
PARTIALS = {
    "individual_by_state": ("individual_contributions", ("com_id", "contrib_state")),
    "individual_by_donor": ("individual_contributions", ("contrib_name", "com_id")),
    "direct": ("committee_contributions_to_candidates", ("com_id", "cand_id")),
    "independent": ("independent_expenditures", ("com_id", "cand_id")),
    "transfers": ("inter_committee_transactions", ("com_id", "other_com_id")),
}


@dataclass(frozen=True)
class Merged:
    """What ``merge`` did: the table's version and the rows that were new."""

    commit: versions.Commit
    new_rows: int


def append(rows: DataFrame, root: str, dataset: str, consumed: Iterable[str] = (),
           max_parts: int = MAX_PARTS) -> Merged:
    """Add ``rows`` as one more part of a silver table (the first, if nobody has written it); the caller
    knows that the table does not hold them."""
    spark, layer = rows.sparkSession, tables.silver_layer(root)
    state = versions.load(spark, layer, dataset)
    part, n = tables.stage_silver(rows, root, dataset, state.buckets)
    parts = [*state.parts, part] if n or not state.parts else state.parts
    total = n if not state.version else None if state.rows is None else state.rows + n
    done = versions.commit(spark, layer, dataset, state, parts, consumed, state.buckets, total, schema=rows.schema)
    if len(parts) > max_parts:
        done = fold(spark, layer, dataset)
    return Merged(done, n)


def merge(rows: DataFrame, root: str, dataset: str, consumed: Iterable[str] = (),
          max_parts: int = MAX_PARTS) -> Merged:
    """Add the different ``rows`` that a bucketed silver table does not hold."""
    layer = tables.silver_layer(root)
    state = versions.load(rows.sparkSession, layer, dataset)
    if not state.buckets:
        raise ValueError(f"{dataset} was not written with buckets")
    return append(versions.distinct_from(rows, layer, state), root, dataset, consumed, max_parts)


def fold(spark: SparkSession, layer: str, name: str) -> versions.Commit:
    """Rewrite the parts of a table as one; its rows stay the same."""
    state = versions.load(spark, layer, name)
    part, path = versions.new_part(layer, name)
    rows = versions.read(spark, layer, name, state.version)
    if state.buckets:
        versions.write_bucketed([rows], path, state.buckets)
    else:
        tables.write_table(rows, path)
    return versions.commit(spark, layer, name, state, [part], state.consumed, state.buckets, state.rows,
                           same_rows_as=list(state.parts))


# ---------------------------------------------------------------- partial sums


def partials_layer(root: str) -> str:
    return f"{root.rstrip('/')}/partials"


def _held(spark: SparkSession, root: str, dataset: str, held: set[str]) -> tuple[list[str], bool]:
    """The silver parts that are not among ``held``, and whether all held rows are still in the table."""
    state = versions.load(spark, tables.silver_layer(root), dataset)
    same = set(state.extra.get("same_rows_as", ())) if len(state.parts) == 1 else set()
    if same and same <= held:
        return [], True
    return [p for p in state.parts if p not in held], held <= set(state.parts)


def _write_sums(sums: DataFrame, keys: Iterable[str], path: str) -> None:
    """Write partial sums, which nobody but the engine reads, as small as they get: near keys beside each other."""
    tables.write_table(sums.sortWithinPartitions(*keys), path, compression="zstd")


def refresh(spark: SparkSession, root: str, max_parts: int = MAX_PARTS) -> dict[str, int]:
    """Bring the partial sums up to the current silver tables; returns how many silver parts each one read.

    A silver table that was rewritten since is summed anew."""
    layer = partials_layer(root)

    def one(name: str) -> int:
        dataset, keys = PARTIALS[name]
        state = versions.load(spark, layer, name)
        new, intact = _held(spark, root, dataset, set(state.extra.get("holds", ())))
        holds = versions.load(spark, tables.silver_layer(root), dataset).parts
        if not intact:
            new = list(holds)
        if not new and set(holds) == set(state.extra.get("holds", ())):
            return 0
        parts, schema = list(state.parts) if intact else [], None
        if new:
            table = versions.load(spark, tables.silver_layer(root), dataset)
            rows = versions.read_parts(spark, tables.silver_layer(root), table, new)
            part, path = versions.new_part(layer, name)
            sums = gold.preaggregate(rows, list(keys))
            _write_sums(sums, keys, path)
            parts, schema = [*parts, part], sums.schema
        state = versions.commit(spark, layer, name, state, parts, schema=schema, holds=list(holds))
        if len(parts) > max_parts:
            part, path = versions.new_part(layer, name)
            _write_sums(gold.preaggregate(versions.read(spark, layer, name), list(keys)), keys, path)
            versions.commit(spark, layer, name, state, [part], holds=list(holds))
        return len(new)

    with ThreadPoolExecutor(max_workers=len(PARTIALS)) as pool:  # independent tables, one writer each
        return dict(zip(PARTIALS, pool.map(one, PARTIALS)))


def _sums_and_registers(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    sums = {n: versions.read(spark, partials_layer(root), n) for n in PARTIALS}
    registers = tables.load_silver(spark, root, ("candidate_master", "committee_master"))
    return sums, registers["committee_master"], gold.explode_cycles(registers["candidate_master"])


def network_pieces(spark: SparkSession, root: str, **edge_params) -> Iterator[DataFrame]:
    """The network of ``gold_tables`` in pieces, for ``tables.write_gold``."""
    sums, com, cycles = _sums_and_registers(spark, root)
    return gold.network_pieces(sums["individual_by_donor"], com, cycles, sums["direct"], sums["transfers"],
                               sums["independent"], **edge_params)


def gold_tables(spark: SparkSession, root: str, **edge_params) -> dict[str, DataFrame]:
    """The three gold tables from the partial sums and the current registers."""
    sums, com, cycles = _sums_and_registers(spark, root)
    state = sums["individual_by_state"]
    return {
        "geo_summary": gold.geo_summary(None, com, cycles, rollup=state),
        "donor_type_summary": gold.donor_type_summary(None, com, sums["direct"], cycles, rollup=state),
        "network_metrics": gold.network_edges(sums["individual_by_donor"], com, cycles, sums["direct"],
                                              sums["transfers"], sums["independent"], **edge_params),
    }
