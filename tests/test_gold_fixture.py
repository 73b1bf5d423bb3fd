"""Golden fixture (FIXTURES.md section 3), hand-computed expectations."""

import pytest
from pyspark.sql import functions as F

from flowlake import registry as R
from flowlake.operators import gold, silver, views


@pytest.fixture(scope="module")
def fx(spark):
    cand = spark.createDataFrame(
        [("H1", "DOE, JANE", "H", "2026"), ("S1", "ROE, RICHARD", "Senate", "[2024, 2026, 2027]")],
        "cand_id string, cand_name string, cand_off string, cand_el_yr string")
    com = spark.createDataFrame(
        [("C1", "JANE FOR HOUSE", "H1"), ("C2", "ROE FOR SENATE", "S1"), ("C3", "BIG PAC", "")],
        "com_id string, com_name string, cand_id string")
    ind_raw = spark.createDataFrame(
        [("C1", "A DONOR", "CA", "16000"), ("C1", "A DONOR", "CA", "16000"), ("C1", "B DONOR", "", "500"),
         ("C2", "C DONOR", "NY", "-20000"), ("C2", "C DONOR", "NY", "1000")],
        "CMTE_ID string, NAME string, STATE string, TRANSACTION_AMT string")
    pas2_raw = spark.createDataFrame(
        [("C3", "H1", "24K", "5000"), ("C3", "S1", "24E", "7000"), ("C3", "S1", "24A", "3000"),
         ("C3", "H1", "24Z", "99")],
        "CMTE_ID string, CAND_ID string, TRANSACTION_TP string, TRANSACTION_AMT string")
    tr = spark.createDataFrame([("C3", "C1", 40000.0), ("C3", "C2", 10000.0)],
                               "com_id string, other_com_id string, trans_amt double")
    ind = silver.silver_from_sources("individual_contributions", ind_raw, None)
    split = silver.build_split_silver(pas2_raw, {})
    direct = split.where(F.col("dataset") == "committee_contributions_to_candidates")
    ie = split.where(F.col("dataset") == "independent_expenditures")
    cycles = gold.explode_cycles(cand)
    net = gold.network_edges(ind, com, cycles, direct, tr, ie)
    return dict(cand=cand, com=com, ind=ind, split=split, direct=direct, ie=ie, cycles=cycles, tr=tr, net=net)


def test_silver_individual_dedup(fx):
    assert fx["ind"].count() == 4
    assert fx["ind"].columns == R.target_columns("individual_contributions")


def test_split_codes(fx):
    counts = {r["dataset"]: r["count"] for r in fx["split"].groupBy("dataset").count().collect()}
    assert counts == {"committee_contributions_to_candidates": 1, "independent_expenditures": 2}


def test_even_cycles(fx):
    rows = {(r.cand_id, r.election_cycle) for r in gold.even_cycles(fx["cycles"]).collect()}
    assert rows == {("H1", 2026), ("S1", 2024), ("S1", 2026)}


@pytest.mark.parametrize("eager", [True, False])
def test_geo_summary(fx, eager):
    geo = gold.geo_summary(fx["ind"], fx["com"], fx["cycles"], eager=eager)
    rows = {tuple(r) for r in geo.select("cand_id", "office_type", "election_cycle", "state",
                                         "total_amount", "total_donations").collect()}
    assert rows == {("H1", "H", "2026", "CA", 16000.0, 1), ("S1", "Senate", "2024", "NY", 19000.0, 2),
                    ("S1", "Senate", "2026", "NY", 19000.0, 2)}


def test_donor_type_summary(fx):
    d = gold.donor_type_summary(fx["ind"], fx["com"], fx["direct"], fx["cycles"])
    assert [tuple(r) for r in d.select("cand_id", "election_cycle", "individual_funds",
                                       "committee_funds").collect()] == [("H1", "2026", 16500.0, 5000.0)]


def test_network(fx):
    rows = {(r.source_node, r.target_node, r.transaction_flow, r.election_cycle, r.weight, r.transaction_count)
            for r in fx["net"].collect()}
    assert rows == {
        ("A DONOR", "DOE, JANE", "Direct Campaign Contribution", "2026", 16000.0, 1),
        ("C DONOR", "ROE, RICHARD", "Direct Campaign Contribution", "2024", 19000.0, 2),
        ("C DONOR", "ROE, RICHARD", "Direct Campaign Contribution", "2026", 19000.0, 2),
        ("BIG PAC", "DOE, JANE", "PAC to Candidate Contribution", "2026", 5000.0, 1),
        ("BIG PAC", "JANE FOR HOUSE", "Inter-PAC Transfer", "2026", 40000.0, 1),
        ("BIG PAC", "ROE, RICHARD", "Independent Expenditure (IE)", "2024", 10000.0, 2),
        ("BIG PAC", "ROE, RICHARD", "Independent Expenditure (IE)", "2026", 10000.0, 2),
    }


def test_views_cycle_2026(fx):
    v = views.view_filter(fx["net"], cycle="2026")
    m = views.network_metrics(v).first()
    assert (m.total_flow, m.edge_count, m.mean_weight) == (90000.0, 5, 18000.0)
    comp = {r.transaction_flow: (r.weight, r.transaction_count) for r in views.flow_composition(v).collect()}
    assert comp == {"Direct Campaign Contribution": (35000.0, 3), "PAC to Candidate Contribution": (5000.0, 1),
                    "Inter-PAC Transfer": (40000.0, 1), "Independent Expenditure (IE)": (10000.0, 2)}
    assert [r[0] for r in views.candidate_list(v).collect()] == ["DOE, JANE", "ROE, RICHARD"]
    shares = views.flow_share(v).agg(F.sum("share")).first()[0]
    assert abs(shares - 1.0) < 1e-12
    # default selection resolves to the latest cycle on the cluster
    assert views.latest_cycle(fx["net"]).first()[0] == "2026"


def test_state_map_by_office(fx):
    geo = gold.geo_summary(fx["ind"], fx["com"], fx["cycles"])
    h = views.state_map(geo, cycle="2026", office="H").collect()
    assert [tuple(r) for r in h] == [("CA", "California", 16000.0, 1)]
    assert views.state_map(geo, cycle="2026", office="S").count() == 0


def test_donor_mix_and_empty_metrics(fx, spark):
    d = gold.donor_type_summary(fx["ind"], fx["com"], fx["direct"], fx["cycles"])
    mix = {r.source_type: (r.amount, round(r.share, 6))
           for r in views.donor_mix(d, candidate="DOE, JANE", cycle="2026").collect()}
    assert mix == {"Individual Donors": (16500.0, round(16500 / 21500, 6)),
                   "Political Committees (PACs)": (5000.0, round(5000 / 21500, 6))}
    empty = views.network_metrics(views.view_filter(fx["net"], cycle="1900")).first()
    assert (empty.total_flow, empty.edge_count, empty.mean_weight) == (0.0, 0, 0.0)


def test_shared_rollup_gives_same_gold(fx, tmp_dir):
    silver_in = {"candidate_master": fx["cand"], "committee_master": fx["com"], "individual_contributions": fx["ind"],
                 "committee_contributions_to_candidates": fx["direct"], "inter_committee_transactions": fx["tr"],
                 "independent_expenditures": fx["ie"]}
    lazy = gold.build_gold(silver_in)
    shared = gold.build_gold(silver_in, shared_path=f"{tmp_dir}/shared")
    for name in ("geo_summary", "donor_type_summary"):
        assert sorted(map(tuple, lazy[name].collect())) == sorted(map(tuple, shared[name].collect()))
