"""Dashboard drill-down views over the gold tables.

Selections (cycle, office, candidate) are either literal values, None for
"all", or a one-row DataFrame such as ``latest_cycle(df)``; the latter is
applied as an equi-join with that single row, so default selections are
resolved on the cluster instead of being collected to the driver first.
Every view returns a lazy DataFrame; the small ones (metrics, shares, top-k)
are bounded by the number of flows / states / k, never by the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lookups as L
from ..functions import rules
from ..plans.joins import sized_broadcast

Selection = str | DataFrame | None


def exact_sum(c: str | F.Column) -> F.Column:
    """Order-independent exact sum of amounts, as DOUBLE."""
    return rules.sum_money(c)


def _select(df: DataFrame, column: str, value: Selection) -> DataFrame:
    if value is None:
        return df
    if isinstance(value, DataFrame):
        (sel_col,) = value.columns
        return df.join(sized_broadcast(value.select(F.col(sel_col).alias(column))), column)
    return df.where(F.col(column) == F.lit(value))


def view_filter(df: DataFrame, cycle: Selection = None, office: Selection = None,
                candidate: Selection = None, candidate_column: str | None = None) -> DataFrame:
    """Equality drill-down; None means "all". The candidate column is
    ``target_node`` on the network and ``cand_name`` elsewhere."""
    if candidate_column is None:
        candidate_column = "target_node" if "target_node" in df.columns else "cand_name"
    df = _select(df, "election_cycle", cycle)
    df = _select(df, "office_type", office)
    return _select(df, candidate_column, candidate)


def cycle_list(df: DataFrame) -> DataFrame:
    """Sorted cycles of a gold table, or of its small cycles table
    (``tables.load_cycles``), which spares the scan of the table itself."""
    return df.select("election_cycle").distinct().orderBy("election_cycle")


def latest_cycle(df: DataFrame) -> DataFrame:
    """One row: the last cycle of the sorted list (the default selection)."""
    return df.agg(F.max("election_cycle").alias("election_cycle"))


def candidate_list(network_view: DataFrame) -> DataFrame:
    """Candidates reachable from individual donors (committee-only
    candidates are not selectable)."""
    return (network_view.where(F.col("source_type") != L.SOURCE_COMMITTEE)
            .select("target_node").distinct().orderBy("target_node"))


def first_listed(listing: DataFrame) -> DataFrame:
    """One row: the first entry of a one-column sorted list (the default
    choice of a select box)."""
    (c,) = listing.columns
    return listing.agg(F.min(c).alias(c))


def first_candidate(geo_view: DataFrame) -> DataFrame:
    """One row: the first name of the sorted candidate list."""
    return geo_view.agg(F.min("cand_name").alias("cand_name"))


def network_metrics(view: DataFrame) -> DataFrame:
    """Total weight, edge count and mean weight (0 when empty)."""
    agg = view.agg(exact_sum("weight").alias("total_flow"), F.count(F.lit(1)).alias("edge_count"))
    return agg.select(
        F.coalesce("total_flow", F.lit(0.0)).alias("total_flow"),
        "edge_count",
        F.when(F.col("edge_count") > 0, F.col("total_flow") / F.col("edge_count"))
        .otherwise(F.lit(0.0)).alias("mean_weight"),
    )


def format_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        rules.format_currency("total_flow").alias("total_flow_text"),
        rules.format_count("edge_count").alias("edge_count_text"),
        rules.format_currency("mean_weight").alias("mean_weight_text"),
    )


def flow_composition(view: DataFrame) -> DataFrame:
    return view.groupBy("transaction_flow").agg(
        exact_sum("weight").alias("weight"), F.sum("transaction_count").alias("transaction_count"))


def _with_share(df: DataFrame, value: str, share: str = "share") -> DataFrame:
    """``value / total`` over an un-partitioned window. Private on purpose:
    it is applied only to results bounded by a fixed number of categories
    (the four flow labels, the two donor types), so the single window
    partition holds at most four rows whatever the data size. The shares of
    a zero total are NULL."""
    total = rules.sum_money(value, Window.partitionBy())
    return df.withColumn(share, F.try_divide(F.col(value), total))


def flow_share(view: DataFrame) -> DataFrame:
    return _with_share(flow_composition(view), "weight")


def _order_all(df: DataFrame, first: str, desc: bool = True) -> list[F.Column]:
    head = F.col(first).desc() if desc else F.col(first).asc()
    return [head] + [F.col(c).asc_nulls_first() for c in df.columns if c != first]


def top_edges(view: DataFrame, n: int = L.TOP_EDGES) -> DataFrame:
    """Heaviest n edges; ties broken by the remaining columns."""
    return view.orderBy(*_order_all(view, "weight")).limit(n)


def top_sources(top: DataFrame) -> DataFrame:
    """Source ranking over the top edges (stacked bar order)."""
    return (top.groupBy("source_node").agg(exact_sum("weight").alias("total_weight"))
            .orderBy(F.col("total_weight").desc(), F.col("source_node")))


def anomaly_matrix(top: DataFrame) -> DataFrame:
    """Frequency vs weight of the top edges."""
    return top.select("source_node", "transaction_flow", "transaction_count", "weight")


def with_state_full(geo: DataFrame) -> DataFrame:
    return geo.withColumn("state_full", rules.state_full("state"))


def donor_mix(donor: DataFrame, candidate: Selection, cycle: Selection) -> DataFrame:
    """First summary row of the candidate in the cycle, as two labelled
    rows (individual vs committee) with their share."""
    sel = view_filter(donor, cycle=cycle, candidate=candidate, candidate_column="cand_name")
    first = sel.orderBy("cand_id", "cand_name", "election_cycle",
                        "individual_funds", "committee_funds").limit(1)
    long = first.unpivot(
        ["cand_name", "election_cycle"], ["individual_funds", "committee_funds"], "source_type", "amount",
    ).select("cand_name", "election_cycle",
             rules.lookup("source_type", {"individual_funds": L.MIX_INDIVIDUAL,
                                          "committee_funds": L.MIX_COMMITTEE}).alias("source_type"),
             "amount")
    return _with_share(long, "amount")


def candidate_states(geo: DataFrame, candidate: Selection, cycle: Selection) -> DataFrame:
    """All donor states of one candidate in one cycle, largest first."""
    sel = view_filter(with_state_full(geo), cycle=cycle, candidate=candidate, candidate_column="cand_name")
    return sel.select("state", "state_full", "total_amount", "total_donations").orderBy(
        F.col("total_amount").desc(), F.col("state"))


def state_map(geo: DataFrame, cycle: Selection, office: Selection, candidate: Selection = None) -> DataFrame:
    """Amount and donations per donor state for the selection."""
    sel = view_filter(with_state_full(geo), cycle=cycle, office=office, candidate=candidate,
                      candidate_column="cand_name")
    return sel.groupBy("state", "state_full").agg(
        exact_sum("total_amount").alias("total_amount"), F.sum("total_donations").alias("total_donations"))


def top_states(state_totals: DataFrame, n: int = L.TOP_STATES) -> DataFrame:
    return state_totals.orderBy(F.col("total_amount").desc(), F.col("state")).limit(n)


def office_labels(geo: DataFrame) -> DataFrame:
    return geo.select("office_type", rules.office_label("office_type").alias("office_label")).distinct()

