"""Query catalogue: one Spark query per operator of the inventory, each with
its DuckDB oracle SQL.

Every query reads the bound test tables (``bindings``) or files Spark wrote
from them, so its work grows with the scale factor. Queries that exercise
file sources and sinks write under a fresh folder of the shared checkpoint
root (``scratch.new_scratch``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import registry as R
from ..functions import rules
from ..operators import gold, silver, views
from ..sources import delimited, snapshots, tables, versions
from ..session import PARTITION_BYTES, sized_for
from ..sources.paths import delete_path, fingerprint, path_exists
from . import bindings as B
from . import oracle as O
from . import incremental, pipeline
from .joins import TASK_BYTES, input_bytes
from .scratch import new_scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Scaled thresholds for ``having_threshold``: test amounts are about ten
# times the reference's, so these make the HAVING clause cut edges.
SCALED_INDIVIDUAL_MIN = 150000
SCALED_TRANSFER_MIN = 300000


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _in(spark, sf):
    return B.silver_inputs(spark, sf)


def _cycles(spark, sf):
    return gold.explode_cycles(B.frame(spark, sf, "candidate"))


def _network(spark, sf, **kw):
    s = _in(spark, sf)
    return gold.network_edges(
        s["individual_contributions"], s["committee_master"], gold.explode_cycles(s["candidate_master"]),
        s["committee_contributions_to_candidates"], s["inter_committee_transactions"],
        s["independent_expenditures"], **kw)


def _geo(spark, sf):
    s = _in(spark, sf)
    return gold.geo_summary(s["individual_contributions"], s["committee_master"],
                            gold.explode_cycles(s["candidate_master"]))


def _donor(spark, sf):
    s = _in(spark, sf)
    return gold.donor_type_summary(s["individual_contributions"], s["committee_master"],
                                   s["committee_contributions_to_candidates"],
                                   gold.explode_cycles(s["candidate_master"]))


_GOLD_ROOTS: dict[tuple[str, str, str], str] = {}


#: What the gold tables read of a payment.
_PAYMENT = ("com_id", "contrib_name", "contrib_state", "trans_amt")


def _write_gold(spark: SparkSession, sf: str, root: str) -> None:
    """The gold tables of an input under ``root``, network and geo partitioned by cycle. The payments are
    joined once, to a table that the state rollup and the edges both read and that is deleted once they
    have; shuffles are sized for the input, and a task writes its few cycles' files without sorting its
    rows. The network is written piece by piece, so the disks hold it and the shuffles of one piece."""
    inputs = _in(spark, sf)
    payments, path = inputs["individual_contributions"].select(*_PAYMENT), f"{root}/_payments"
    with sized_for(spark, (input_bytes(payments) or 0) * (PARTITION_BYTES // TASK_BYTES)):  # TASK_BYTES a partition
        tables.write_table(payments, path, compression="zstd")
        inputs["individual_contributions"] = spark.read.schema(payments.schema).parquet(path)
        built = gold.build_gold(inputs, shared_path=f"{root}/_shared")

        def network():
            com, cycles = inputs["committee_master"], gold.explode_cycles(inputs["candidate_master"])
            yield from gold.individual_pieces(inputs["individual_contributions"], com, cycles)
            delete_path(spark, path)
            yield from gold.committee_pieces(com, cycles, inputs["committee_contributions_to_candidates"],
                                             inputs["inter_committee_transactions"], inputs["independent_expenditures"])

        tables.write_gold(built, root, partition_by_cycle=True, max_parallel=3, pieces={"network_metrics": network()})
    delete_path(spark, f"{root}/_shared")


def stored_gold_root(spark: SparkSession, sf: str) -> str:
    """Where the gold tables of an input are stored, as a dashboard reads
    them: built once per application and state of the input files (names,
    sizes, times), network and geo partitioned by cycle, under the shared
    scratch root. Writing them cuts the lineage back to the raw tables."""
    inputs = [f"{sf.rstrip('/')}/{t}.parquet" for t in ("supplier", "part", "orders", "customer", "lineitem")]
    key = (spark.sparkContext.applicationId, sf, fingerprint(spark, *inputs))
    if key not in _GOLD_ROOTS:
        root = new_scratch(spark, "gold")
        _write_gold(spark, sf, root)
        _GOLD_ROOTS[key] = root
    return _GOLD_ROOTS[key]


def stored_gold(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return tables.load_gold(spark, stored_gold_root(spark, sf))


def _stored_cycles(spark, sf, name):
    return tables.load_cycles(spark, stored_gold_root(spark, sf), name)


def _stored_network(spark, sf):
    return stored_gold(spark, sf)["network_metrics"]


def _stored_geo(spark, sf):
    return stored_gold(spark, sf)["geo_summary"]


def _stored_donor(spark, sf):
    return stored_gold(spark, sf)["donor_type_summary"]


def _net_view(spark, sf):
    """Network tab default: latest cycle, all candidates."""
    latest = views.latest_cycle(_stored_cycles(spark, sf, "network_metrics"))
    return views.view_filter(_stored_network(spark, sf), cycle=latest)


# ------------------------------------------------------------------ gold


@query("explode_cycles", O.with_ctes("SELECT * FROM cand_cycles_all", "cand_cycles_all"))
def q_explode_cycles(spark, sf):
    return _cycles(spark, sf)


@query("filter_even_cycle", O.with_ctes(
    "SELECT * FROM cand_cycles_all WHERE election_cycle % 2 = 0", "cand_cycles_all"))
def q_filter_even_cycle(spark, sf):
    return gold.even_cycles(_cycles(spark, sf))


@query("geo_summary", O.with_ctes("SELECT * FROM geo", "geo"))
def q_geo_summary(spark, sf):
    return _geo(spark, sf)


@query("indiv_rollup", O.with_ctes(
    f"SELECT cand_id, {O.money('c')} AS individual_funds FROM raised", "raised"))
def q_indiv_rollup(spark, sf):
    s = _in(spark, sf)
    return gold.indiv_rollup(s["individual_contributions"], s["committee_master"])


@query("committee_rollup", O.with_ctes(
    f"SELECT cand_id, {O.money('c')} AS committee_funds FROM given", "given"))
def q_committee_rollup(spark, sf):
    return gold.committee_rollup(B.frame(spark, sf, "direct"))


@query("donor_type_summary", O.with_ctes("SELECT * FROM donor", "donor"))
def q_donor_type_summary(spark, sf):
    return _donor(spark, sf)


@query("floor_at_zero", O.with_ctes(f"""
SELECT cand_id, {O.money('c')} AS individual_funds,
       CASE WHEN c > 0 THEN {O.money('c')} ELSE 0.0 END AS floored_funds
FROM candidate LEFT JOIN raised USING (cand_id)""", "candidate", "raised"))
def q_floor_at_zero(spark, sf):
    s = _in(spark, sf)
    ind = gold.indiv_rollup(s["individual_contributions"], s["committee_master"])
    cand = s["candidate_master"].select("cand_id")
    return cand.join(ind, "cand_id", "left").select(
        "cand_id", "individual_funds", rules.floor_at_zero("individual_funds").alias("floored_funds"))


@query("network_individual", O.with_ctes("SELECT * FROM edges_individual", "edges_individual"))
def q_network_individual(spark, sf):
    s = _in(spark, sf)
    return gold.edges_individual(s["individual_contributions"], s["committee_master"],
                                 gold.explode_cycles(s["candidate_master"]))


@query("network_pac_to_candidate", O.with_ctes("SELECT * FROM edges_direct", "edges_direct"))
def q_network_pac_to_candidate(spark, sf):
    s = _in(spark, sf)
    return gold.edges_direct(s["committee_contributions_to_candidates"], s["committee_master"],
                             gold.explode_cycles(s["candidate_master"]))


@query("network_transfers", O.with_ctes("SELECT * FROM edges_transfer", "edges_transfer"))
def q_network_transfers(spark, sf):
    s = _in(spark, sf)
    return gold.edges_transfer(s["inter_committee_transactions"], s["committee_master"])


@query("network_independent", O.with_ctes("SELECT * FROM edges_independent", "edges_independent"))
def q_network_independent(spark, sf):
    s = _in(spark, sf)
    return gold.edges_independent(s["independent_expenditures"], s["committee_master"],
                                  gold.explode_cycles(s["candidate_master"]))


@query("network_edges", O.with_ctes("SELECT * FROM network", "network"))
def q_network_edges(spark, sf):
    return _network(spark, sf)


O.CTE["having_ind"] = (O._edge_individual(SCALED_INDIVIDUAL_MIN), ["individual", "register", "race"])
O.CTE["having_tr"] = (O._edge_transfer(SCALED_TRANSFER_MIN), ["transfers", "register"])


@query("having_threshold", O.with_ctes(
    "SELECT * FROM having_ind UNION ALL SELECT * FROM having_tr", "having_ind", "having_tr"))
def q_having_threshold(spark, sf):
    s = _in(spark, sf)
    ind = gold.edges_individual(s["individual_contributions"], s["committee_master"],
                                gold.explode_cycles(s["candidate_master"]), SCALED_INDIVIDUAL_MIN)
    tr = gold.edges_transfer(s["inter_committee_transactions"], s["committee_master"],
                             min_weight=SCALED_TRANSFER_MIN)
    return ind.unionByName(tr)


# ------------------------------------------------------------------ filters


@query("filter_code_eq", O.with_ctes("SELECT * FROM pas2 WHERE trans_type = '24K'", "pas2"))
def q_filter_code_eq(spark, sf):
    return silver.filter_codes(B.frame(spark, sf, "pas2"), "committee_contributions_to_candidates")


@query("filter_code_in", O.with_ctes("SELECT * FROM pas2 WHERE trans_type IN ('24E', '24A')", "pas2"))
def q_filter_code_in(spark, sf):
    return silver.filter_codes(B.frame(spark, sf, "pas2"), "independent_expenditures")


@query("filter_non_blank", O.with_ctes("""
SELECT com_id, contrib_name, contrib_state, trans_amt FROM individual
WHERE contrib_state IS NOT NULL AND contrib_state <> ''""", "individual"))
def q_filter_non_blank(spark, sf):
    ind = B.frame(spark, sf, "individual")
    return ind.where(rules.is_non_blank("contrib_state")).select(
        "com_id", "contrib_name", "contrib_state", "trans_amt")


# ------------------------------------------------------------------ scalar rules


def _rule(source: str, target: str, sql: str):
    return O.with_ctes(f"SELECT l_orderkey, l_linenumber, {source}, {sql} AS {target} FROM payment_text",
                       "payment_text")


@query("normalize_date", _rule("raw_date", "trans_date", O.date_sql("raw_date")))
def q_normalize_date(spark, sf):
    p = B.frame(spark, sf, "payment_text")
    return p.select("l_orderkey", "l_linenumber", "raw_date", rules.normalize_date("raw_date").alias("trans_date"))


@query("normalize_amount", _rule("raw_amount", "trans_amt", O.amount_sql("raw_amount")))
def q_normalize_amount(spark, sf):
    p = B.frame(spark, sf, "payment_text")
    return p.select("l_orderkey", "l_linenumber", "raw_amount", rules.normalize_amount("raw_amount").alias("trans_amt"))


@query("normalize_id", _rule("raw_id", "com_id", O.id_sql("raw_id")))
def q_normalize_id(spark, sf):
    p = B.frame(spark, sf, "payment_text")
    return p.select("l_orderkey", "l_linenumber", "raw_id", rules.normalize_id("raw_id").alias("com_id"))


@query("normalize_label", _rule("raw_label", "contrib_emp", O.label_sql("raw_label")))
def q_normalize_label(spark, sf):
    p = B.frame(spark, sf, "payment_text")
    return p.select("l_orderkey", "l_linenumber", "raw_label", rules.normalize_label("raw_label").alias("contrib_emp"))


# ------------------------------------------------------------------ views


@query("view_cycle_list", O.with_ctes("SELECT DISTINCT election_cycle FROM network", "network"))
def q_view_cycle_list(spark, sf):
    return views.cycle_list(_stored_cycles(spark, sf, "network_metrics"))


@query("view_default_cycle", O.with_ctes(
    "SELECT max(election_cycle) AS election_cycle FROM network", "network"))
def q_view_default_cycle(spark, sf):
    return views.latest_cycle(_stored_cycles(spark, sf, "network_metrics"))


@query("view_filter", O.with_ctes("""
SELECT * FROM network WHERE election_cycle = '2024' AND target_node =
  (SELECT min(target_node) FROM network WHERE election_cycle = '2024' AND source_type <> 'Committee/PAC')""",
                                  "network"))
def q_view_filter(spark, sf):
    """Network tab with cycle 2024 and the first listed candidate selected."""
    net = _stored_network(spark, sf)
    first = views.first_listed(views.candidate_list(views.view_filter(net, cycle="2024")))
    return views.view_filter(net, cycle="2024", candidate=first)


@query("view_candidate_list", O.with_ctes(
    "SELECT DISTINCT target_node FROM net_view WHERE source_type <> 'Committee/PAC'", "net_view"))
def q_view_candidate_list(spark, sf):
    return views.candidate_list(_net_view(spark, sf))


_METRICS_SQL = f"""
SELECT COALESCE({O.money("SUM(" + O.exact('weight') + ")")}, 0.0) AS total_flow,
       COUNT(*) AS edge_count,
       CASE WHEN COUNT(*) > 0 THEN {O.money("SUM(" + O.exact('weight') + ")")} / COUNT(*)
            ELSE 0.0 END AS mean_weight
FROM net_view"""
O.CTE["net_metrics"] = (_METRICS_SQL, ["net_view"])


@query("view_network_metrics", O.with_ctes("SELECT * FROM net_metrics", "net_metrics"))
def q_view_network_metrics(spark, sf):
    return views.network_metrics(_net_view(spark, sf))


@query("format_currency", O.with_ctes("""
SELECT '$' || format('{:,.2f}', total_flow) AS total_flow_text,
       format('{:,}', edge_count) AS edge_count_text,
       '$' || format('{:,.2f}', mean_weight) AS mean_weight_text
FROM net_metrics""", "net_metrics"))
def q_format_currency(spark, sf):
    return views.format_metrics(views.network_metrics(_net_view(spark, sf)))


O.CTE["flow_comp"] = (f"""
SELECT transaction_flow, {O.money("SUM(" + O.exact('weight') + ")")} AS weight,
       CAST(SUM(transaction_count) AS BIGINT) AS transaction_count
FROM net_view GROUP BY 1""", ["net_view"])


@query("view_flow_composition", O.with_ctes("SELECT * FROM flow_comp", "flow_comp"))
def q_view_flow_composition(spark, sf):
    return views.flow_composition(_net_view(spark, sf))


@query("view_flow_share", O.with_ctes(f"""
SELECT *, weight / nullif({O.money("SUM(" + O.exact('weight') + ") OVER ()")}, 0) AS share FROM flow_comp""",
                                      "flow_comp"))
def q_view_flow_share(spark, sf):
    return views.flow_share(_net_view(spark, sf))


@query("view_flow_share_zero_total", O.with_ctes("""
SELECT transaction_flow, 0.0::DOUBLE AS weight, transaction_count, NULL::DOUBLE AS share FROM flow_comp""", "flow_comp"))
def q_view_flow_share_zero_total(spark, sf):
    """Flows whose weights net to zero have no shares."""
    return views.flow_share(_net_view(spark, sf).withColumn("weight", F.lit(0.0)))


@query("view_empty_selection", """
SELECT 'network_metrics' AS view, 1 AS n_rows, 0.0::DOUBLE AS total_flow, 0 AS edge_count, 0.0::DOUBLE AS mean_weight
UNION ALL SELECT v, 0, NULL, NULL, NULL FROM (VALUES ('flow_share'), ('top_edges'), ('candidate_list'),
                                              ('donor_mix'), ('state_map'), ('candidate_states')) t(v)""")
def q_view_empty_selection(spark, sf):
    """Every view of a cycle that no table holds: zero metrics, no rows."""
    g = stored_gold(spark, sf)
    net = views.view_filter(g["network_metrics"], cycle="1900")
    geo, donor = g["geo_summary"], g["donor_type_summary"]
    listed = {
        "flow_share": views.flow_share(net), "top_edges": views.top_edges(net),
        "candidate_list": views.candidate_list(net),
        "donor_mix": views.donor_mix(donor, candidate="NOBODY", cycle="1900"),
        "state_map": views.state_map(geo, cycle="1900", office="P"),
        "candidate_states": views.candidate_states(geo, candidate="NOBODY", cycle="1900"),
    }
    none = F.lit(None)
    out = views.network_metrics(net).select(F.lit("network_metrics").alias("view"), F.lit(1).alias("n_rows"),
                                            "total_flow", F.col("edge_count").cast("int"), "mean_weight")
    for name, df in listed.items():
        out = out.unionAll(df.agg(F.count(F.lit(1)).cast("int").alias("n_rows")).select(
            F.lit(name).alias("view"), "n_rows", none.cast("double").alias("total_flow"),
            none.cast("int").alias("edge_count"), none.cast("double").alias("mean_weight")))
    return out


@query("view_top_edges", O.with_ctes("SELECT * FROM top_edges", "top_edges"))
def q_view_top_edges(spark, sf):
    return views.top_edges(_net_view(spark, sf))


@query("view_top_sources", O.with_ctes(f"""
SELECT source_node, {O.money("SUM(" + O.exact('weight') + ")")} AS total_weight
FROM top_edges GROUP BY 1""", "top_edges"))
def q_view_top_sources(spark, sf):
    return views.top_sources(views.top_edges(_net_view(spark, sf)))


@query("view_anomaly_matrix", O.with_ctes(
    "SELECT source_node, transaction_flow, transaction_count, weight FROM top_edges", "top_edges"))
def q_view_anomaly_matrix(spark, sf):
    return views.anomaly_matrix(views.top_edges(_net_view(spark, sf)))


@query("view_state_full", O.with_ctes("SELECT * FROM geo_full", "geo_full"))
def q_view_state_full(spark, sf):
    return views.with_state_full(_stored_geo(spark, sf))


@query("view_office_label", O.with_ctes("""
SELECT DISTINCT office_type, CASE office_type WHEN 'P' THEN 'President' WHEN 'H' THEN 'House'
       WHEN 'S' THEN 'Senate' ELSE office_type END AS office_label FROM geo""", "geo"))
def q_view_office_label(spark, sf):
    return views.office_labels(_stored_geo(spark, sf))


def _tab2(spark, sf):
    """Donor tab defaults: latest donor cycle, office P, first candidate."""
    geo, donor = _stored_geo(spark, sf), _stored_donor(spark, sf)
    cyc = views.latest_cycle(_stored_cycles(spark, sf, "donor_type_summary"))
    cand = views.first_candidate(views.view_filter(geo, cycle=cyc, office="P"))
    return geo, donor, cyc, cand


O.CTE["t2_first"] = ("""
SELECT d.* FROM donor d JOIN t2_sel s ON d.cand_name = s.cand AND d.election_cycle = s.cyc
ORDER BY cand_id NULLS FIRST, cand_name NULLS FIRST, election_cycle NULLS FIRST,
         individual_funds NULLS FIRST, committee_funds NULLS FIRST LIMIT 1""", ["donor", "t2_sel"])
O.CTE["t2_mix"] = ("""
SELECT cand_name, election_cycle, 'Individual Donors' AS source_type, individual_funds AS amount FROM t2_first
UNION ALL
SELECT cand_name, election_cycle, 'Political Committees (PACs)' AS source_type, committee_funds AS amount
FROM t2_first""", ["t2_first"])


@query("view_donor_mix", O.with_ctes(f"""
SELECT *, amount / nullif({O.money("SUM(" + O.exact('amount') + ") OVER ()")}, 0) AS share FROM t2_mix""", "t2_mix"))
def q_view_donor_mix(spark, sf):
    _, donor, cyc, cand = _tab2(spark, sf)
    return views.donor_mix(donor, candidate=cand, cycle=cyc)


@query("view_candidate_states", O.with_ctes("""
SELECT state, state_full, total_amount, total_donations FROM geo_full g, t2_sel s
WHERE g.cand_name = s.cand AND g.election_cycle = s.cyc""", "geo_full", "t2_sel"))
def q_view_candidate_states(spark, sf):
    geo, _, cyc, cand = _tab2(spark, sf)
    return views.candidate_states(geo, candidate=cand, cycle=cyc)


def _tab3_map(spark, sf):
    geo = _stored_geo(spark, sf)
    latest = views.latest_cycle(_stored_cycles(spark, sf, "geo_summary"))
    return views.state_map(geo, cycle=latest, office="P")


@query("view_state_map", O.with_ctes("SELECT * FROM t3_map", "t3_map"))
def q_view_state_map(spark, sf):
    return _tab3_map(spark, sf)


@query("view_top_states", O.with_ctes(
    "SELECT * FROM t3_map ORDER BY total_amount DESC, state NULLS FIRST LIMIT 5", "t3_map"))
def q_view_top_states(spark, sf):
    return views.top_states(_tab3_map(spark, sf))


# ------------------------------------------------------------------ sources, silver

_CM_COLS = B.columns("raw_cm")
_CM_API_COLS = B.columns("raw_cm_api")


@query("scan_delimited", O.with_ctes(
    "SELECT " + ", ".join(f"NULLIF(\"{c}\", '') AS \"{c}\"" for c in _CM_COLS) + " FROM raw_cm", "raw_cm"))
def q_scan_delimited(spark, sf):
    root = new_scratch(spark, "scan_delimited")
    delimited.write_delimited(B.frame(spark, sf, "raw_cm"), f"{root}/cm.txt")
    return delimited.read_delimited(spark, f"{root}/cm.txt", "cm.txt")


@query("scan_snapshots", O.with_ctes("""
SELECT committee_id, name, designation_full, committee_type_full, candidate_ids, cycles,
       CAST(NULL AS VARCHAR) AS filing_frequency FROM raw_cm_api
UNION ALL
SELECT committee_id, name, designation_full, CAST(NULL AS VARCHAR), candidate_ids, CAST(NULL AS VARCHAR),
       'Q' FROM raw_cm_api""", "raw_cm_api"))
def q_scan_snapshots(spark, sf):
    root = new_scratch(spark, "scan_snapshots")
    api = B.frame(spark, sf, "raw_cm_api")
    snapshots.write_snapshot(api, root, "api_raw_committees", "20260101_000000")
    drift = api.drop("cycles", "committee_type_full").withColumn("filing_frequency", F.lit("Q"))
    snapshots.write_snapshot(drift, f"{root}/2026-01/02", "api_raw_committees", "20260102_000000")
    # another dataset's snapshot in the same landing folder must be ignored
    snapshots.write_snapshot(B.frame(spark, sf, "raw_itcont_api"), root, "api_raw_individual_contribs",
                             "20260101_000000")
    return snapshots.read_snapshots(spark, root, "api_raw_committees")


def _json_source(spark, sf):
    s = B._table(spark, sf, "supplier")
    return s.select(
        F.array(F.concat(F.lit("H"), F.col("s_nationkey").cast("string"))).alias("candidate_ids"),
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("committee_id"),
        F.array(F.lit(2024), F.lit(2026)).alias("cycles"),
        (F.col("s_suppkey") % 12).alias("filing_count"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") % 3 == 0, "DEM").when(F.col("s_nationkey") % 3 == 1, "REP").alias("party"),
        F.struct(F.col("s_name").alias("name"),
                 (F.lit(10000) + F.col("s_suppkey") % 90000).alias("zip")).alias("treasurer"),
    )


_LANDED_JSON = """
SELECT '["H' || CAST(s_nationkey AS VARCHAR) || '"]' AS candidate_ids,
       'C' || CAST(s_suppkey AS VARCHAR) AS committee_id,
       '["2024","2026"]' AS cycles,
       CAST(s_suppkey % 12 AS VARCHAR) AS filing_count,
       s_name AS name,
       CASE s_nationkey % 3 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' END AS party,
       '{"name":"' || s_name || '","zip":"' || CAST(10000 + s_suppkey % 90000 AS VARCHAR) || '"}' AS treasurer
FROM supplier"""


@query("land_json", f"SELECT *, (SELECT count(*) FROM supplier WHERE s_suppkey % 10 = 3) AS malformed FROM ({_LANDED_JSON})")
def q_land_json(spark, sf):
    """Records with a truncated line for every tenth supplier, which is kept out and counted."""
    root = new_scratch(spark, "land_json")
    good = _json_source(spark, sf)
    good.write.json(f"{root}/incoming.json")
    good.where("substr(committee_id, 2) % 10 = 3").select(
        F.concat(F.lit('{"committee_id": "C'), F.substring("committee_id", 2, 20)).alias("value")
    ).write.mode("append").text(f"{root}/incoming.json")
    out = snapshots.land_json(spark, f"{root}/incoming.json", f"{root}/landing", "api_raw_committees",
                              ts="20260101_000000")
    return spark.read.parquet(out.path).withColumn("malformed", F.lit(out.malformed).cast("long"))


def _bulk_committees(spark, sf):
    return silver.project_bulk(B.frame(spark, sf, "raw_cm"), "committee_master")


def _api_committees(spark, sf):
    return silver.project_api(B.frame(spark, sf, "raw_cm_api").drop("party_full"), "committee_master")


_CM_BULK_SQL = "SELECT " + O.mapped_select("committee_master", "bulk", _CM_COLS) + " FROM raw_cm"
_CM_API_SQL = ("SELECT " + O.mapped_select("committee_master", "api",
                                           [c for c in _CM_API_COLS if c != "party_full"],
                                           missing_tokens=True) + " FROM raw_cm_api")


@query("project_mapping", O.with_ctes(_CM_BULK_SQL, "raw_cm"))
def q_project_mapping(spark, sf):
    return _bulk_committees(spark, sf)


@query("unify_sources", O.with_ctes(f"{_CM_BULK_SQL} UNION ALL {_CM_API_SQL}", "raw_cm", "raw_cm_api"))
def q_unify_sources(spark, sf):
    return silver.unify(_bulk_committees(spark, sf), _api_committees(spark, sf))


@query("unify_single_source", O.with_ctes(_CM_API_SQL, "raw_cm_api"))
def q_unify_single_source(spark, sf):
    return silver.unify(bulk=None, api=_api_committees(spark, sf))


_IND = "individual_contributions"
_ITCONT_COLS = B.columns("raw_itcont")
_ITCONT_API_COLS = B.columns("raw_itcont_api")
O.CTE["ind_bulk_mem"] = ("SELECT " + O.mapped_select(_IND, "bulk", _ITCONT_COLS) + " FROM raw_itcont",
                         ["raw_itcont"])
O.CTE["ind_bulk_file"] = ("SELECT " + O.mapped_select(_IND, "bulk", _ITCONT_COLS, text_roundtrip=True)
                          + " FROM raw_itcont", ["raw_itcont"])
O.CTE["ind_api"] = ("SELECT " + O.mapped_select(_IND, "api", _ITCONT_API_COLS, missing_tokens=True)
                    + " FROM raw_itcont_api", ["raw_itcont_api"])
O.CTE["ind_unified_file"] = ("SELECT * FROM ind_bulk_file UNION ALL SELECT * FROM ind_api "
                             "UNION ALL SELECT * FROM ind_api", ["ind_bulk_file", "ind_api"])
O.CTE["ind_silver_file"] = (f"SELECT DISTINCT {O.clean_select(_IND)} FROM ind_unified_file",
                            ["ind_unified_file"])


@query("silver_clean", O.with_ctes(f"SELECT {O.clean_select(_IND)} FROM ind_bulk_mem", "ind_bulk_mem"))
def q_silver_clean(spark, sf):
    return silver.clean(silver.project_bulk(B.frame(spark, sf, "raw_itcont"), _IND))


@query("silver_dedup", O.with_ctes(
    f"SELECT DISTINCT {O.clean_select(_IND)} FROM "
    "(SELECT * FROM ind_bulk_mem UNION ALL SELECT * FROM ind_api UNION ALL SELECT * FROM ind_api) u",
    "ind_bulk_mem", "ind_api"))
def q_silver_dedup(spark, sf):
    bulk = B.frame(spark, sf, "raw_itcont")
    api = B.frame(spark, sf, "raw_itcont_api")
    api = api.unionByName(api)  # the same pull landed twice
    return silver.silver_from_sources(_IND, bulk, api)


def _land_individual(spark, sf, root):
    """Bulk text file + two identical snapshots (+ a foreign one); the text, eight times the tables' bytes, is compressed."""
    delimited.write_delimited(B.frame(spark, sf, "raw_itcont"), f"{root}/bronze/itcont.txt", compression="gzip")
    api = B.frame(spark, sf, "raw_itcont_api")
    pulled = snapshots.write_snapshot(api, f"{root}/landing", "api_raw_individual_contribs", "20260101_000000")
    again = spark.read.schema(snapshots.stringify(api).schema).parquet(pulled)  # the join is not run twice
    snapshots.write_snapshot(again, f"{root}/landing", "api_raw_individual_contribs", "20260102_000000")
    snapshots.write_snapshot(B.frame(spark, sf, "raw_cm_api"), f"{root}/landing", "api_raw_committees",
                             "20260101_000000")


@query("silver_dataset", O.with_ctes("SELECT * FROM ind_silver_file", "ind_silver_file"))
def q_silver_dataset(spark, sf):
    root = new_scratch(spark, "silver_dataset")
    with sized_for(spark, 0):  # shuffle files end with their job
        _land_individual(spark, sf, root)
        rows = silver.cleaned_silver(spark, _IND, bulk_path=f"{root}/bronze/itcont.txt", landing_root=f"{root}/landing")
        tables.write_silver(rows, root, _IND, pieces=silver.distinct_pieces(rows, f"{root}/_aside"))
    return tables.load_silver(spark, root, [_IND])[_IND]


@query("layer_counts", O.with_ctes("""
SELECT 'bulk_raw' AS layer, COUNT(*) AS row_count FROM raw_itcont
UNION ALL SELECT 'api_raw', 2 * COUNT(*) FROM raw_itcont_api
UNION ALL SELECT 'silver', COUNT(*) FROM ind_silver_file""", "raw_itcont", "raw_itcont_api", "ind_silver_file"))
def q_layer_counts(spark, sf):
    root = new_scratch(spark, "layer_counts")
    _land_individual(spark, sf, root)
    bulk = silver.read_bulk(spark, f"{root}/bronze/itcont.txt", "itcont.txt")
    api = snapshots.read_snapshots(spark, f"{root}/landing", "api_raw_individual_contribs")
    out = silver.silver_from_sources(_IND, bulk, api)
    tables.write_silver(out, root, _IND)
    written = tables.load_silver(spark, root, [_IND])[_IND]
    counts = silver.layer_counts(bulk, api, written)
    return counts.select("layer", F.col("rows").alias("row_count"))


_SPLIT = ("committee_contributions_to_candidates", "independent_expenditures")
_PAS2_COLS = B.columns("raw_itpas2")
O.CTE["pas2_bulk_file"] = ("SELECT " + O.mapped_select(_SPLIT[0], "bulk", _PAS2_COLS, text_roundtrip=True)
                           + " FROM raw_itpas2", ["raw_itpas2"])
O.CTE["disb_api"] = ("SELECT " + O.mapped_select(_SPLIT[0], "api", B.columns("raw_disb_api"), missing_tokens=True)
                     + " FROM raw_disb_api", ["raw_disb_api"])
O.CTE["ie_api"] = ("SELECT " + O.mapped_select(_SPLIT[1], "api", B.columns("raw_ie_api"), missing_tokens=True)
                   + " FROM raw_ie_api", ["raw_ie_api"])


@query("silver_split_codes", O.with_ctes(f"""
SELECT DISTINCT '{_SPLIT[0]}' AS dataset, {O.clean_select(_SPLIT[0])}
FROM (SELECT * FROM pas2_bulk_file UNION ALL SELECT * FROM disb_api) u WHERE trans_type = '24K'
UNION ALL
SELECT DISTINCT '{_SPLIT[1]}' AS dataset, {O.clean_select(_SPLIT[1])}
FROM (SELECT * FROM pas2_bulk_file UNION ALL SELECT * FROM ie_api) u WHERE trans_type IN ('24E', '24A')""",
                                         "pas2_bulk_file", "disb_api", "ie_api"))
def q_silver_split_codes(spark, sf):
    root = new_scratch(spark, "silver_split_codes")
    delimited.write_delimited(B.frame(spark, sf, "raw_itpas2"), f"{root}/bronze/itpas2.txt")
    snapshots.write_snapshot(B.frame(spark, sf, "raw_disb_api"), f"{root}/landing",
                             "api_raw_committee_disbursements", "20260101_000000")
    snapshots.write_snapshot(B.frame(spark, sf, "raw_ie_api"), f"{root}/landing",
                             "api_raw_independent_expenditures", "20260101_000000")
    bulk = silver.read_bulk(spark, f"{root}/bronze/itpas2.txt", "itpas2.txt")
    api = {d: snapshots.read_snapshots(spark, f"{root}/landing", p)
           for d, _, p in R.SILVER_TASKS if d in _SPLIT}
    out = silver.build_split_silver(bulk, api, _SPLIT)
    tables.write_split_silver(out, root, _SPLIT)
    return tables.load_split_silver(spark, root, _SPLIT)


@query("scan_header_layout", O.with_ctes(
    "SELECT " + ", ".join(f"NULLIF(\"{c}\", '') AS \"{c}\"" for c in _CM_COLS) + " FROM raw_cm", "raw_cm"))
def q_scan_header_layout(spark, sf):
    """The layout of a bulk file read from a header-only CSV file."""
    root = new_scratch(spark, "scan_header_layout")
    spark.createDataFrame([(",".join(_CM_COLS),)], "value string").coalesce(1).write.text(f"{root}/header.csv")
    delimited.write_delimited(B.frame(spark, sf, "raw_cm"), f"{root}/cm.txt")
    layouts = delimited.layouts_from_headers(spark, {"cm.txt": f"{root}/header.csv"})
    return delimited.read_delimited(spark, f"{root}/cm.txt", layouts["cm.txt"])


def _silver_job(dataset: str, bulk: str, api: str | None = None):
    """The file job of one dataset: bulk text and a snapshot to its silver table."""
    _, bulk_file, prefix = next(t for t in R.SILVER_TASKS if t[0] == dataset)
    unified = "SELECT " + O.mapped_select(dataset, "bulk", B.columns(bulk), text_roundtrip=True) + f" FROM {bulk}"
    if api:
        unified += " UNION ALL SELECT " + O.mapped_select(dataset, "api", B.columns(api), missing_tokens=True)
        unified += f" FROM {api}"

    @query(f"silver_job_{dataset}", O.with_ctes(f"SELECT DISTINCT {O.clean_select(dataset)} FROM ({unified}) u",
                                                bulk, *([api] if api else [])))
    def job(spark, sf):
        root = new_scratch(spark, f"silver_job_{dataset}")
        delimited.write_delimited(B.frame(spark, sf, bulk), f"{root}/bronze/{bulk_file}")
        if api:
            snapshots.write_snapshot(B.frame(spark, sf, api), f"{root}/landing", prefix, "20260101_000000")
        pipeline.run_silver(spark, f"{root}/bronze", f"{root}/landing" if api else None, root,
                            tasks=[(dataset, bulk_file, prefix)])
        return tables.load_silver(spark, root, [dataset])[dataset]


_silver_job("committee_master", "raw_cm", "raw_cm_api")
_silver_job("candidate_master", "raw_cn")
_silver_job("inter_committee_transactions", "raw_itoth")


@query("sink_roundtrip", O.with_ctes("SELECT * FROM network", "network"))
def q_sink_roundtrip(spark, sf):
    root = new_scratch(spark, "sink_roundtrip")
    _write_gold(spark, sf, root)
    return tables.load_gold(spark, root)["network_metrics"]


# ------------------------------------------------------------------ increments, heavy keys


@query("network_individual_shuffled", O.with_ctes("SELECT * FROM edges_individual", "edges_individual"))
def q_network_individual_shuffled(spark, sf):
    """The register joined by shuffle, committees of more than 64 KB of payments dealt over several tasks."""
    s = _in(spark, sf)
    return gold.edges_individual(s["individual_contributions"], s["committee_master"],
                                 gold.explode_cycles(s["candidate_master"]), partition_bytes=64 << 10, broadcast_limit=0)


@query("silver_increments", O.with_ctes(
    f"SELECT DISTINCT {O.clean_select(_IND)} FROM (SELECT * FROM ind_bulk_mem UNION ALL SELECT * FROM ind_api) u",
    "ind_bulk_mem", "ind_api"))
def q_silver_increments(spark, sf):
    """The bulk file's rows in buckets, then two overlapping snapshots merged as increments."""
    root = new_scratch(spark, "silver_increments")
    bulk, api = B.frame(spark, sf, "raw_itcont"), B.frame(spark, sf, "raw_itcont_api")
    rows, buckets = silver.cleaned_from_sources(_IND, bulk, None), versions.buckets_for(bulk)
    with sized_for(spark, 0):  # shuffle files end with their job
        tables.write_silver(rows, root, _IND, buckets=buckets,
                            pieces=silver.distinct_pieces(rows, f"{root}/_aside", buckets))
        early = api.where("pmod(xxhash64(contributor_name), 2) = 0")
        for pull in (early, api):
            incremental.merge(silver.silver_from_sources(_IND, None, pull), root, _IND)
    return tables.load_silver(spark, root, [_IND])[_IND]


def maintained_root(spark: SparkSession, sf: str, increments: int = 3) -> str:
    """Silver tables that grow by increments, partial sums refreshed after each; payments are dealt to
    the increments by a hash of the row, so every sum is made of several of them. The joined payments are
    dealt in one write, not joined again for each increment; the tables are appended side by side. An
    increment's rows are deleted once the silver table holds them, shuffle files when their job ends."""
    root = new_scratch(spark, "maintained")
    inputs = _in(spark, sf)
    for d in ("candidate_master", "committee_master"):
        tables.write_silver(inputs[d], root, d)
    dealt = {d: inputs[d].withColumn("_increment", F.pmod(F.xxhash64(*inputs[d].columns), F.lit(increments)))
             for d in {d for d, _ in incremental.PARTIALS.values()}}
    with sized_for(spark, 0):  # a task writes its files without sorting its rows
        dealt[_IND].write.option("compression", "zstd").partitionBy("_increment").parquet(f"{root}/dealt")

    def rows(d: str, i: int) -> DataFrame:
        if d != _IND:
            return dealt[d].where(F.col("_increment") == i).drop("_increment")
        part = f"{root}/dealt/_increment={i}"
        found = path_exists(spark, part)
        return spark.read.schema(inputs[d].schema).parquet(part) if found else inputs[d].limit(0)

    with sized_for(spark, 0), ThreadPoolExecutor(max_workers=len(dealt)) as pool:
        for i in range(increments):
            list(pool.map(lambda d: incremental.append(rows(d, i), root, d), dealt))
            delete_path(spark, f"{root}/dealt/_increment={i}")
            incremental.refresh(spark, root)
    return root


def _maintained(name: str, cte: str):
    @query(f"maintained_{cte}", O.with_ctes(f"SELECT * FROM {cte}", cte))
    def kept(spark, sf):
        root = maintained_root(spark, sf)
        built = incremental.gold_tables(spark, root)[name]
        if name != "network_metrics":
            return built
        with sized_for(spark, (input_bytes(built) or 0) * (PARTITION_BYTES // TASK_BYTES)):
            tables.write_gold({name: built}, root, pieces={name: incremental.network_pieces(spark, root)})
        return tables.load_gold(spark, root, [name])[name]


_maintained("geo_summary", "geo")
_maintained("donor_type_summary", "donor")
_maintained("network_metrics", "network")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
