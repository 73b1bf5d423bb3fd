"""Gold layer: star-join rollups and the weighted transaction network.

Facts (contributions, transfers, expenditures) are much larger than the
dimensions (committees, candidate cycles), and every gold measure is a SUM
or COUNT, which decompose. Each rollup (``_rollup``) runs one of two plans:

  eager aggregation (Yan & Larson, VLDB 1995)
    facts ─ partial agg(join keys) ─ shuffle ─ final agg ─ join dims ─ agg(out keys)
    The facts shrink to one row per join key before any join; a hot key (one
    committee holding a third of all rows) is collapsed map-side.

  join first
    facts ─ join dims ─ partial agg(out keys) ─ shuffle ─ final agg

Rollups whose key collapses many rows (committee, committee x state,
committee x candidate, committee x committee) aggregate first. The donor x
committee key of the individual edges is nearly unique, so that branch joins
first: the register with its candidates' cycles if they are small, else the
register, and the cycles after a sum per (donor, candidate id)
(``edges_individual``). A fact frame may also be partial
sums of facts by key (the parts of ``rules.money_parts`` and ``_n`` rows, as
``preaggregate`` makes them), which ``plans.incremental`` keeps per increment. Independently, each dimension is
broadcast only if it passes the size check in ``plans.joins``; candidate
cycles come from exploded lists, whose size the planner cannot estimate, so
they carry no hint and adaptive execution decides on their real size.

Both plans give identical results: sums are taken in exact integer parts
(order-independent), and a join against duplicated dimension rows multiplies
sums and counts exactly as join-then-aggregate does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import rules
from ..plans.heavy import row_bytes, salted_join
from ..plans.joins import broadcast_limit as limit_of
from ..plans.joins import dealt, fits_broadcast, in_slice, sized_broadcast, slices_for
from ..session import PARTITION_BYTES


def explode_cycles(candidates: DataFrame, even_only: bool = False) -> DataFrame:
    """Candidate -> one row per election cycle parsed from list text.

    ``[2024, 2026]``, ``['2024']``, ``["2024"]`` and ``2024,`` all split
    alike; empty or non-numeric elements are dropped instead of failing.
    """
    base = candidates.where(rules.is_non_blank("cand_el_yr"))
    parts = F.explode(F.split(rules.strip_list_text("cand_el_yr"), ",")).alias("_cycle")
    out = (
        base.select("cand_id", "cand_name", "cand_off", parts)
        .select("cand_id", "cand_name", "cand_off",
                F.col("_cycle").try_cast("int").alias("election_cycle"))
        .where(F.col("election_cycle").isNotNull())
    )
    return out.where(rules.is_even("election_cycle")) if even_only else out


def rejected_cycles() -> F.Column:
    """How many list elements of a candidate row ``explode_cycles`` drops
    because they are no number (empty elements are no cycle)."""
    parts = F.split(rules.strip_list_text("cand_el_yr"), ",")
    bad = F.filter(parts, lambda x: (x != "") & x.try_cast("int").isNull())
    return F.when(rules.is_non_blank("cand_el_yr"), F.size(bad)).otherwise(0)


def even_cycles(cycles: DataFrame) -> DataFrame:
    return cycles.where(rules.is_even("election_cycle"))


#: What every rollup sums: the parts of the money and the rows.
MEASURES = (*rules.MONEY_PARTS, "_n")


def _measures(fact: DataFrame) -> list[F.Column]:
    """The measures of a fact, or of a partial sum of facts."""
    if "_amt" in fact.columns:
        return [F.col(m) for m in MEASURES]
    return [*rules.money_parts("trans_amt"), F.lit(1).cast("long").alias("_n")]


def _sums() -> list[F.Column]:
    return [F.sum(m).alias(m) for m in MEASURES]


def _rollup(fact: DataFrame, fact_keys: list[str], dims: list[tuple[DataFrame, str]],
            out_keys: list, eager: bool | None = None) -> DataFrame:
    """Attach dimensions to a fact and aggregate amount (cents) and count.

    Aggregates the facts first unless ``eager`` is False. Output:
    ``out_keys`` + ``MEASURES``.
    """
    if eager is None or eager:
        return _from_preaggregated(preaggregate(fact, fact_keys), dims, out_keys)
    return _from_preaggregated(fact.select(*fact_keys, *_measures(fact)), dims, out_keys)


def preaggregate(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Facts summed and counted per key: ``keys`` + ``MEASURES``."""
    return fact.select(*keys, *_measures(fact)).groupBy(*keys).agg(*_sums())


def _from_preaggregated(pre: DataFrame, dims: list[tuple[DataFrame, str]], out_keys: list) -> DataFrame:
    for dim, key in dims:
        pre = pre.join(sized_broadcast(dim), key)
    return pre.groupBy(*out_keys).agg(*_sums())


def committee_state_rollup(individual: DataFrame) -> DataFrame:
    """Individual money per (committee, donor state): the shared input of
    the geographic summary and the donor-type summary. Its size is bounded
    by committees x states, not by the number of contributions."""
    return preaggregate(individual, ["com_id", "contrib_state"])


def _cycle_dim(cycles: DataFrame, *cols: str) -> DataFrame:
    return even_cycles(cycles).select(*cols)


def _cycle_text() -> F.Column:
    return F.col("election_cycle").cast("string").alias("election_cycle")


def geo_summary(individual: DataFrame | None, committees: DataFrame, cycles: DataFrame,
                eager: bool | None = None, rollup: DataFrame | None = None) -> DataFrame:
    """Donations per candidate, office, cycle and donor state:
    ``ABS(SUM(amount))`` and ``COUNT(*)``; blank states dropped, even cycles
    only. A donation counts once per even cycle of its candidate. With
    ``rollup`` (``committee_state_rollup``) the facts are not read again."""
    dims = [(committees.select("com_id", "cand_id"), "com_id"),
            (_cycle_dim(cycles, "cand_id", "cand_name", "cand_off", "election_cycle"), "cand_id")]
    keys = ["cand_id", "cand_name", F.col("cand_off").alias("office_type"), _cycle_text(),
            F.col("contrib_state").alias("state")]
    if rollup is not None:
        r = _from_preaggregated(rollup.where(rules.is_non_blank("contrib_state")), dims, keys)
    else:
        r = _rollup(individual.where(rules.is_non_blank("contrib_state")), ["com_id", "contrib_state"],
                    dims, keys, eager)
    return r.select("cand_id", "cand_name", "office_type", "election_cycle", "state",
                    F.abs(rules.from_parts()).alias("total_amount"),
                    F.col("_n").alias("total_donations"))


def indiv_rollup(individual: DataFrame | None, committees: DataFrame, exact: bool = False,
                 eager: bool | None = None, rollup: DataFrame | None = None) -> DataFrame:
    """Individual money per candidate (via the receiving committee);
    ``exact`` keeps exact cents (DECIMAL); ``rollup`` as in ``geo_summary``."""
    dims = [(committees.select("com_id", "cand_id"), "com_id")]
    if rollup is not None:
        r = _from_preaggregated(rollup.select("com_id", *MEASURES), dims, ["cand_id"])
    else:
        r = _rollup(individual, ["com_id"], dims, ["cand_id"], eager)
    funds = rules.exact_cents() if exact else rules.from_parts()
    return r.select("cand_id", funds.alias("individual_funds"))


def committee_rollup(direct: DataFrame, exact: bool = False) -> DataFrame:
    """Committee money given directly to each candidate."""
    funds = rules.exact_cents() if exact else rules.from_parts()
    return preaggregate(direct, ["cand_id"]).select("cand_id", funds.alias("committee_funds"))


def donor_type_summary(individual: DataFrame | None, committees: DataFrame, direct: DataFrame,
                       cycles: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """Per candidate and even cycle: individual vs committee funds, each
    floored at zero; rows where neither raw sum is positive are dropped
    (a NULL side does not count as positive). The nearest DOUBLE has the sign
    of the exact sum."""
    ind = sized_broadcast(indiv_rollup(individual, committees, rollup=rollup))
    com = sized_broadcast(committee_rollup(direct))
    cyc = even_cycles(cycles).select("cand_id", "cand_name", "election_cycle")
    joined = cyc.join(ind, "cand_id", "left").join(com, "cand_id", "left")
    return joined.where((F.col("individual_funds") > 0) | (F.col("committee_funds") > 0)).select(
        "cand_id",
        "cand_name",
        _cycle_text(),
        rules.floor_at_zero("individual_funds").alias("individual_funds"),
        rules.floor_at_zero("committee_funds").alias("committee_funds"),
    )


def _edges(r: DataFrame, source_type: str, flow: str, min_weight: float | None) -> DataFrame:
    r = r.withColumn("_w", F.abs(rules.from_parts()))
    if min_weight is not None:  # exact for thresholds below 2^33: a millionth above one is another DOUBLE
        r = r.where(F.col("_w") > F.lit(float(min_weight)))
    return r.select(
        "source_node",
        F.lit(source_type).alias("source_type"),
        "target_node",
        F.lit(flow).alias("transaction_flow"),
        "election_cycle",
        F.col("_w").alias("weight"),
        F.col("_n").alias("transaction_count"),
    )


def _small_races(register: DataFrame, cycles: DataFrame, limit: int | None) -> DataFrame | None:
    """com_id, cand_name and cycle of the register's candidates for a broadcast; None if they are too many.

    Lists hide how many rows they give, so a job counts them, if the register is small."""
    if not fits_broadcast(register, limit):
        return None
    races = _cycle_dim(cycles, "cand_id", "cand_name", "election_cycle").join(F.broadcast(register), "cand_id").select(
        "com_id", "cand_name", "election_cycle")
    size = races.agg(F.sum(row_bytes(races))).first()[0] or 0
    return F.broadcast(races) if size <= (limit if limit is not None else limit_of(races)) else None


def edges_individual(individual: DataFrame, committees: DataFrame, cycles: DataFrame,
                     min_weight: float | None = L.INDIVIDUAL_MIN_WEIGHT,
                     eager: bool | None = None, partition_bytes: int = PARTITION_BYTES,
                     broadcast_limit: int | None = None) -> DataFrame:
    """Donor -> candidate edges (even cycles), kept when ``ABS(SUM)`` exceeds
    ``min_weight``.

    If the register and the cycles of its candidates are small, facts meet
    both by broadcast and are shuffled once, to their edges. Otherwise the
    facts meet the committee register, are summed per (donor, candidate id),
    and only the sums meet the candidates' cycles. A register too big to broadcast is
    joined by shuffle, and a committee with more than ``partition_bytes`` of
    payments is dealt over as many tasks as its bytes ask for
    (``plans.heavy``); where no committee has that many, nothing is salted.
    """
    register = committees.select("com_id", "cand_id")
    facts = individual.select("contrib_name", "com_id", *_measures(individual))
    if eager:  # the (donor, committee) key rarely collapses; kept for comparison
        facts = facts.groupBy("contrib_name", "com_id").agg(*_sums())
    edge = [F.col("contrib_name").alias("source_node"), F.col("cand_name").alias("target_node"), _cycle_text()]
    races = _small_races(register, cycles, broadcast_limit)
    if races is not None:
        r = facts.join(races, "com_id").groupBy(*edge).agg(*_sums())
        return _edges(r, L.SOURCE_INDIVIDUAL, L.FLOW_DIRECT, min_weight)
    if fits_broadcast(register, broadcast_limit):
        joined = facts.join(F.broadcast(register), "com_id")
    else:
        # payments of one donor may be many as well: dealt by amount too
        spread = F.struct("contrib_name", "_amt")
        joined = salted_join(facts, register, "com_id", spread, partition_bytes)
    sums = joined.groupBy("contrib_name", "cand_id").agg(*_sums())
    sums, races = dealt(sums, _cycle_dim(cycles, "cand_id", "cand_name", "election_cycle"), ["cand_id"], ["cand_id"])
    r = _from_preaggregated(sums, [(races, "cand_id")], edge)
    return _edges(r, L.SOURCE_INDIVIDUAL, L.FLOW_DIRECT, min_weight)


def _committee_to_candidate(payments: DataFrame, committees: DataFrame, cycles: DataFrame,
                            flow: str, min_weight: float | None, eager: bool | None) -> DataFrame:
    r = _rollup(
        payments, ["com_id", "cand_id"],
        [(committees.select("com_id", "com_name"), "com_id"),
         (_cycle_dim(cycles, "cand_id", "cand_name", "election_cycle"), "cand_id")],
        [F.col("com_name").alias("source_node"), F.col("cand_name").alias("target_node"), _cycle_text()],
        eager,
    )
    return _edges(r, L.SOURCE_COMMITTEE, flow, min_weight)


def edges_direct(direct: DataFrame, committees: DataFrame, cycles: DataFrame,
                 min_weight: float | None = None, eager: bool | None = None) -> DataFrame:
    """Committee -> candidate direct contributions (no threshold)."""
    return _committee_to_candidate(direct, committees, cycles, L.FLOW_PAC_TO_CANDIDATE, min_weight, eager)


def edges_independent(independent: DataFrame, committees: DataFrame, cycles: DataFrame,
                      min_weight: float | None = None, eager: bool | None = None) -> DataFrame:
    """Committee -> candidate independent expenditures, for and against
    alike (no threshold)."""
    return _committee_to_candidate(independent, committees, cycles, L.FLOW_INDEPENDENT, min_weight, eager)


def edges_transfer(transfers: DataFrame, committees: DataFrame, cycle: str = L.TRANSFER_CYCLE,
                   min_weight: float | None = L.TRANSFER_MIN_WEIGHT,
                   eager: bool | None = None, sources: DataFrame | None = None) -> DataFrame:
    """Committee -> committee transfers; both ends resolved against the
    committee table (source and target roles), labelled with a fixed cycle.
    With ``sources`` only transfers of these committees."""
    src = (committees if sources is None else sources).select("com_id", F.col("com_name").alias("source_node"))
    tgt = committees.select(F.col("com_id").alias("other_com_id"), F.col("com_name").alias("target_node"))
    r = _rollup(transfers, ["com_id", "other_com_id"], [(src, "com_id"), (tgt, "other_com_id")],
                ["source_node", "target_node", F.lit(cycle).alias("election_cycle")], eager)
    return _edges(r, L.SOURCE_COMMITTEE, L.FLOW_TRANSFER, min_weight)


def network_edges(individual: DataFrame, committees: DataFrame, cycles: DataFrame,
                  direct: DataFrame, transfers: DataFrame, independent: DataFrame,
                  individual_min_weight: float | None = L.INDIVIDUAL_MIN_WEIGHT,
                  transfer_min_weight: float | None = L.TRANSFER_MIN_WEIGHT,
                  transfer_cycle: str = L.TRANSFER_CYCLE) -> DataFrame:
    """The four edge branches stacked into one edge list."""
    branches = [
        edges_individual(individual, committees, cycles, individual_min_weight),
        edges_direct(direct, committees, cycles),
        edges_transfer(transfers, committees, transfer_cycle, transfer_min_weight),
        edges_independent(independent, committees, cycles),
    ]
    return reduce(lambda a, b: a.unionByName(b), branches)


def individual_pieces(individual: DataFrame, committees: DataFrame, cycles: DataFrame,
                      individual_min_weight: float | None = L.INDIVIDUAL_MIN_WEIGHT) -> Iterator[DataFrame]:
    """``edges_individual`` in slices of the donors, to be written one after the other."""
    n = slices_for(individual)
    for i in range(n):
        some = individual if n == 1 else individual.where(in_slice("contrib_name", i, n))
        yield edges_individual(some, committees, cycles, individual_min_weight)


def _by_source(payments: DataFrame, committees: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Payments and the committees that make them, in slices of the committees' names, which are the source
    of every edge. A register too big to broadcast is not sliced: each slice would shuffle all payments."""
    register = committees.select("com_id", "com_name")
    n = slices_for(payments) if fits_broadcast(register) else 1
    for i in range(n):
        if n == 1:
            yield payments, committees
            continue
        some = committees.where(in_slice("com_name", i, n))
        yield payments.join(sized_broadcast(some.select("com_id")), "com_id", "left_semi"), some


def committee_pieces(committees: DataFrame, cycles: DataFrame, direct: DataFrame, transfers: DataFrame,
                     independent: DataFrame, transfer_min_weight: float | None = L.TRANSFER_MIN_WEIGHT,
                     transfer_cycle: str = L.TRANSFER_CYCLE) -> Iterator[DataFrame]:
    """The committees' branches of ``network_edges`` in slices, to be written one after the other."""
    for paid, some in _by_source(direct, committees):
        yield edges_direct(paid, some, cycles)
    for paid, some in _by_source(transfers, committees):
        yield edges_transfer(paid, committees, transfer_cycle, transfer_min_weight, sources=some)
    for paid, some in _by_source(independent, committees):
        yield edges_independent(paid, some, cycles)


def network_pieces(individual: DataFrame, committees: DataFrame, cycles: DataFrame, direct: DataFrame,
                   transfers: DataFrame, independent: DataFrame,
                   individual_min_weight: float | None = L.INDIVIDUAL_MIN_WEIGHT,
                   transfer_min_weight: float | None = L.TRANSFER_MIN_WEIGHT,
                   transfer_cycle: str = L.TRANSFER_CYCLE) -> Iterator[DataFrame]:
    """The rows of ``network_edges`` as frames that share no edge: written one after the other, only one of
    them has shuffle files on disk."""
    yield from individual_pieces(individual, committees, cycles, individual_min_weight)
    yield from committee_pieces(committees, cycles, direct, transfers, independent, transfer_min_weight, transfer_cycle)


def network_inputs(silver: dict[str, DataFrame]) -> list[DataFrame]:
    """The arguments of ``network_edges`` and ``network_pieces`` among the silver tables."""
    return [silver["individual_contributions"], silver["committee_master"], explode_cycles(silver["candidate_master"]),
            silver["committee_contributions_to_candidates"], silver["inter_committee_transactions"],
            silver["independent_expenditures"]]


def build_gold(silver: dict[str, DataFrame], shared_path: str | None = None,
               **edge_params) -> dict[str, DataFrame]:
    """The three gold tables from the six silver tables.

    With ``shared_path`` the (committee, state) rollup of the individual
    contributions is written there first and both the geographic and the
    donor-type summary read it, so the largest fact table is scanned and
    aggregated once for the two of them (and the written rollup survives a
    lost executor). Without it everything stays lazy."""
    cycles = explode_cycles(silver["candidate_master"])
    com = silver["committee_master"]
    ind = silver["individual_contributions"]
    direct = silver["committee_contributions_to_candidates"]
    rollup = None
    if shared_path:
        committee_state_rollup(ind).write.mode("overwrite").parquet(shared_path)
        rollup = ind.sparkSession.read.parquet(shared_path)
    return {
        "geo_summary": geo_summary(ind, com, cycles, rollup=rollup),
        "donor_type_summary": donor_type_summary(ind, com, direct, cycles, rollup=rollup),
        "network_metrics": network_edges(*network_inputs(silver), **edge_params),
    }
