"""End-to-end job: bronze files -> silver -> gold, checked against the
oracle's gold SQL run by DuckDB over the silver tables the job wrote."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from flowlake import registry as R
from flowlake.operators import silver
from flowlake.plans import bindings as B
from flowlake.plans import oracle as O
from flowlake.plans import pipeline
from flowlake.sources import tables

ROLE_OF = {
    "committee": "committee_master",
    "candidate": "candidate_master",
    "individual": "individual_contributions",
    "direct": "committee_contributions_to_candidates",
    "independent": "independent_expenditures",
    "transfers": "inter_committee_transactions",
}


@pytest.fixture(scope="module")
def built(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="flowlake-e2e-")
    B.land_bronze(spark, SF_SMALL, f"{root}/bronze", f"{root}/landing")
    metrics = pipeline.run_all(spark, f"{root}/bronze", f"{root}/landing", root)
    return root, metrics


def _gold_sql(cte: str) -> str:
    order = []

    def visit(n):
        if n in order or n in ROLE_OF:
            return
        for d in O.CTE[n][1]:
            visit(d)
        order.append(n)
    visit(cte)
    return "WITH " + ",\n".join(f"{n} AS ({O.CTE[n][0].strip()})" for n in order) + f"\nSELECT * FROM {cte}"


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join("nan" if isinstance(r[i], float) and math.isnan(r[i]) else repr(r[i])
                           for i in order) for r in rows)


def test_silver_written(spark, built):
    root, metrics = built
    silver = tables.load_silver(spark, root)
    assert set(silver) == set(R.GOLD_INPUTS)
    for d, df in silver.items():
        assert df.columns == R.target_columns(d)
        assert df.count() > 0
    m = metrics["individual_contributions"]
    assert m["rows"] == silver["individual_contributions"].count()
    assert m["bulk_rows"] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert m["malformed_rows"] == 0 and m["api_rows"] > 0
    for d in R.DATASET_CODES:
        assert metrics[d]["rows"] == silver[d].count() > 0
    # dates 'junk' and 30 February, amounts 'nan' and 'None'
    assert m["bad_trans_date"] > 0 and m["bad_trans_amt"] > 0 and m["sub_cent_trans_amt"] == 0
    assert metrics["gold"]["bad_cycles"] > 0  # the element 'nan' of '2025, nan'
    assert sorted(r[0] for r in tables.load_cycles(spark, root, "network_metrics").collect()) == sorted(
        r[0] for r in tables.load_gold(spark, root)["network_metrics"].select("election_cycle").distinct().collect())


def test_malformed_rows_counted(spark, tmp_dir):
    from flowlake import registry as R2

    os_root = tmp_dir
    good = "|".join(["C1"] + ["x"] * (len(R2.BULK_LAYOUTS["cm.txt"]) - 1))
    import os
    os.makedirs(f"{os_root}/bronze", exist_ok=True)
    with open(f"{os_root}/bronze/cm.txt", "w") as f:
        f.write(good + "\n" + "C2|short row\n" + good.replace("C1", "C3") + "|extra\n")
    out = pipeline.run_silver(spark, f"{os_root}/bronze", None, os_root,
                              tasks=[("committee_master", "cm.txt", "api_raw_committees")])
    assert out["committee_master"]["bulk_rows"] == 3
    assert out["committee_master"]["malformed_rows"] == 2
    assert out["committee_master"]["rows"] == 3


def test_rejected_lines_are_kept_whole(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/bronze")
    layout = R.BULK_LAYOUTS["itcont.txt"]

    def line(**fields):
        return "|".join(fields.get(c, "") for c in layout)

    good = line(CMTE_ID="C1", NAME="A", TRANSACTION_DT="01052026", TRANSACTION_AMT="5")
    bad_date = line(CMTE_ID="C1", NAME='B "x', TRANSACTION_DT="02302026", TRANSACTION_AMT="7")
    bad_both = line(CMTE_ID="C2", NAME=" C", TRANSACTION_DT="junk", TRANSACTION_AMT="$5")
    long, short = good + "|extra|more", "C3|short"
    with open(f"{tmp_dir}/bronze/itcont.txt", "w") as f:
        f.write("\n".join([good, bad_date, bad_date, bad_both, long, short, good]) + "\n")
    d = "individual_contributions"
    m = pipeline.run_silver(spark, f"{tmp_dir}/bronze", None, tmp_dir, tasks=[(d, "itcont.txt", "api_none")])[d]
    lines = tables.load_rejected(spark, tmp_dir, d).collect()
    assert sorted((r.reason, r.line) for r in lines) == sorted([
        ("trans_date", bad_date), ("trans_date", bad_date), ("trans_amt,trans_date", bad_both),
        ("fields", long), ("fields", short)])
    assert all(r.file.endswith("/itcont.txt") for r in lines) and len({r.line_id for r in lines}) == 5
    assert (m["rejected_lines"], m["malformed_rows"], m["bad_trans_date"], m["bad_trans_amt"]) == (5, 2, 3, 1)
    assert (m["bulk_rows"], m["candidate_rows"], m["rows"]) == (7, 7, 4)
    # the rows are those of the plain plan, and the next load replaces the lines
    plain = silver.build_silver(spark, d, f"{tmp_dir}/bronze/itcont.txt")
    got = tables.load_silver(spark, tmp_dir, [d])[d]
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    with open(f"{tmp_dir}/bronze/itcont.txt", "w") as f:
        f.write(good + "\n")
    pipeline.run_silver(spark, f"{tmp_dir}/bronze", None, tmp_dir, tasks=[(d, "itcont.txt", "api_none")])
    assert tables.load_rejected(spark, tmp_dir, d).count() == 0


def test_rejected_lines_of_a_split_file(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/bronze")
    layout = R.BULK_LAYOUTS["itpas2.txt"]

    def line(**fields):
        return "|".join(fields.get(c, "") for c in layout)

    direct, independent = (d for d, f, _ in R.SILVER_TASKS if f == "itpas2.txt")
    codes = {d: R.DATASET_CODES[d][0] for d in (direct, independent)}
    fine = line(CMTE_ID="C1", TRANSACTION_TP=codes[direct], TRANSACTION_DT="01052026", TRANSACTION_AMT="5")
    wild = line(CMTE_ID="C1", TRANSACTION_TP=codes[independent], TRANSACTION_DT="01052026", TRANSACTION_AMT="inf")
    other = line(CMTE_ID="C1", TRANSACTION_TP="??", TRANSACTION_DT="junk", TRANSACTION_AMT="5")
    with open(f"{tmp_dir}/bronze/itpas2.txt", "w") as f:
        f.write("\n".join([fine, wild, other, "C9|short"]) + "\n")
    tasks = [t for t in R.SILVER_TASKS if t[1] == "itpas2.txt"]
    m = pipeline.run_silver(spark, f"{tmp_dir}/bronze", None, tmp_dir, tasks=tasks)

    def lines(d):
        return [(r.reason, r.line) for r in tables.load_rejected(spark, tmp_dir, d).collect()]

    # a line whose row belongs to no dataset is looked at only if it is malformed
    assert lines(direct) == [("fields", "C9|short")] and lines(independent) == [("trans_amt", wild)]
    assert [m[d]["rows"] for d in (direct, independent)] == [1, 1]
    assert m[direct]["malformed_rows"] == 1 and m[direct]["candidate_rows"] == 2


@pytest.mark.parametrize("table,cte", [("geo_summary", "geo"), ("donor_type_summary", "donor"),
                                       ("network_metrics", "network")])
def test_gold_matches_oracle_on_silver(spark, built, table, cte):
    root, _ = built
    con = duckdb.connect()
    for role, dataset in ROLE_OF.items():
        files = [f"{p.removeprefix('file:')}/*.parquet" for p in tables.silver_paths(spark, root, dataset)]
        con.execute(f"CREATE VIEW {role} AS SELECT * FROM read_parquet({files})")
    res = con.execute(_gold_sql(cte))
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    df = tables.load_gold(spark, root)[table]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(drows) and len(rows) > 0
    assert _canon(df.columns, rows) == _canon(dcols, drows)
