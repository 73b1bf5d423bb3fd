"""Sources, sinks and the silver layer."""

import os

from pyspark.sql import functions as F

from flowlake import registry as R
from flowlake.operators import silver
from flowlake.sources import delimited, snapshots, tables


def test_read_delimited_edge_cases(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw.txt")
    with open(path, "w") as f:
        f.write('C1|ACME "BIG" PAC||5\n')
        f.write('C2|"UNBAL PAC|x|\n')
        f.write("C3|short\n")
        f.write("C4|a|b|c|extra\n")
    df = delimited.read_delimited(spark, path, ["a", "b", "c", "d"], flag_corrupt=True)
    rows = {r.a: r for r in df.collect()}
    assert len(rows) == 4
    assert rows["C1"].b == 'ACME "BIG" PAC' and rows["C1"].c is None and rows["C1"].d == "5"
    assert rows["C2"].b == '"UNBAL PAC' and rows["C2"].c == "x"
    assert rows["C3"].b == "short" and rows["C3"].c is None and rows["C3"]._corrupt_record is not None
    assert rows["C4"].d == "c" and rows["C4"]._corrupt_record is not None
    assert rows["C1"]._corrupt_record is None


def test_delimited_roundtrip_layout(spark, tmp_dir):
    df = spark.createDataFrame([("C1", None, "x")], "CMTE_ID string, CMTE_NM string, TRES_NM string")
    delimited.write_delimited(df, f"{tmp_dir}/out")
    back = delimited.read_delimited(spark, f"{tmp_dir}/out", ["CMTE_ID", "CMTE_NM", "TRES_NM"])
    assert [tuple(r) for r in back.collect()] == [("C1", None, "x")]
    assert len(delimited.read_delimited(spark, f"{tmp_dir}/out", "cm.txt").columns) == 15


def test_read_snapshots_merges_columns(spark, tmp_dir):
    a = spark.createDataFrame([("1", "x")], "committee_id string, name string")
    b = spark.createDataFrame([("2", "y")], "committee_id string, party_full string")
    snapshots.write_snapshot(a, tmp_dir, "api_raw_committees", "20260101_000000")
    snapshots.write_snapshot(b, tmp_dir, "api_raw_committees", "20260102_000000")
    snapshots.write_snapshot(a, tmp_dir, "api_raw_candidates", "20260101_000000")
    df = snapshots.read_snapshots(spark, tmp_dir, "api_raw_committees")
    rows = {r.committee_id: r.asDict() for r in df.collect()}
    assert rows == {"1": {"committee_id": "1", "name": "x", "party_full": None},
                    "2": {"committee_id": "2", "name": None, "party_full": "y"}}
    assert snapshots.read_snapshots(spark, tmp_dir, "api_raw_nothing") is None


def test_land_json_all_text(spark, tmp_dir):
    src = f"{tmp_dir}/in.json"
    with open(src, "w") as f:
        f.write('{"committee_id": "C1", "cycles": [2024, 2026], "count": 3, "party": null}\n')
        f.write('{"committee_id": "C2", "treasurer": {"name": "A"}}\n')
    out = snapshots.land_json(spark, src, f"{tmp_dir}/landing", "api_raw_committees", ts="20260101_000000")
    assert out.path.endswith("api_raw_committees_20260101_000000.parquet")
    assert (out.rows, out.malformed) == (2, 0)
    df = spark.read.parquet(out.path)
    assert all(t == "string" for _, t in df.dtypes)
    rows = {r.committee_id: r for r in df.collect()}
    assert rows["C1"].cycles == '["2024","2026"]' and rows["C1"]["count"] == "3" and rows["C1"].party is None
    assert rows["C2"].treasurer == '{"name":"A"}'


def test_project_mapping_first_match_and_nulls(spark):
    df = spark.createDataFrame([("c1", "n")], "committee_id string, name string")
    out = silver.project_api(df, "committee_master")
    assert out.columns == R.target_columns("committee_master")
    r = out.first()
    assert r.com_id == "c1" and r.com_name == "n" and r.com_party is None


def test_unify_single_and_none(spark):
    df = spark.createDataFrame([("c1",)], "committee_id string")
    api = silver.project_api(df, "committee_master")
    assert silver.unify(None, api).count() == 1
    assert silver.unify(None, None) is None


def test_dedup_idempotent(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "k string, v double")
    once = silver.dedup(df)
    assert once.count() == 2 and silver.dedup(once).count() == 2


def test_target_columns_sorted():
    for d in R.MAPPINGS:
        cols = R.target_columns(d)
        assert cols == sorted(cols)


def test_build_silver_from_files_and_counts(spark, tmp_dir):
    raw = spark.createDataFrame(
        [(" c1 ", "P2026", "A", "X", "CA", "1", None, "o", "03312026", "10", None),
         (" c1 ", "P2026", "A", "X", "CA", "1", None, "o", "03312026", "10", None)],
        ", ".join(f"{c} string" for c in ["CMTE_ID", "TRANSACTION_PGI", "NAME", "CITY", "STATE", "ZIP_CODE",
                                          "EMPLOYER", "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT",
                                          "OTHER_ID"]))
    full = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c)
                        for c in R.BULK_LAYOUTS["itcont.txt"]])
    delimited.write_delimited(full, f"{tmp_dir}/itcont.txt")
    df = silver.build_silver(spark, "individual_contributions", bulk_path=f"{tmp_dir}/itcont.txt",
                             landing_root=f"{tmp_dir}/landing")
    metrics = tables.write_silver(df, tmp_dir, "individual_contributions", observe=True)
    assert metrics["rows"] == 1
    r = spark.read.parquet(*tables.silver_paths(spark, tmp_dir, "individual_contributions")).first()
    assert (r.com_id, r.contrib_emp, r.trans_date, r.trans_amt) == ("C1", "NOT SPECIFIED", "2026-03-31", 10.0)
    assert silver.build_silver(spark, "individual_contributions", bulk_path=f"{tmp_dir}/missing.txt") is None


def test_split_requires_disjoint_codes(spark):
    import pytest

    with pytest.raises(ValueError):
        silver.build_split_silver(None, {}, ("committee_contributions_to_candidates",
                                             "committee_contributions_to_candidates"))


def test_layouts_from_header_files(spark, tmp_dir):
    with open(f"{tmp_dir}/committee_columns.csv", "w") as f:
        f.write(",".join(R.BULK_LAYOUTS["cm.txt"]) + "\n")
    got = delimited.layouts_from_headers(spark, {"cm.txt": f"{tmp_dir}/committee_columns.csv",
                                                 "cn.txt": f"{tmp_dir}/missing.csv"})
    assert got == {"cm.txt": R.BULK_LAYOUTS["cm.txt"]}


def test_land_json_with_given_schema(spark, tmp_dir):
    src = f"{tmp_dir}/in.json"
    with open(src, "w") as f:
        f.write('{"committee_id": "C1", "cycles": [2024, 2026], "ignored": 1}\n')
    schema = "committee_id string, cycles array<string>"
    out = snapshots.land_json(spark, src, f"{tmp_dir}/landing", "api_raw_committees", ts="20260101_000000",
                              schema=schema)
    df = spark.read.parquet(out.path)
    assert sorted(df.columns) == ["committee_id", "cycles"]
    assert df.first().cycles == '["2024","2026"]'


def test_land_json_keeps_malformed_lines_out(spark, tmp_dir):
    src = f"{tmp_dir}/in.json"
    with open(src, "w") as f:
        f.write('{"committee_id": "C1", "name": "A"}\n{"committee_id": "C2", "na\nnot json\n\n{"committee_id": "C3"}\n')
    for i, schema in enumerate((None, "committee_id string, name string")):
        out = snapshots.land_json(spark, src, f"{tmp_dir}/landing{i}", "api_raw_committees", ts="20260101_000000",
                                  schema=schema)
        assert (out.rows, out.malformed) == (2, 2)
        df = snapshots.read_snapshots(spark, f"{tmp_dir}/landing{i}", "api_raw_committees")
        assert sorted(r.committee_id for r in df.collect()) == ["C1", "C3"]
        assert sorted(df.columns) == ["committee_id", "name"]
        bad = spark.read.text(f"{tmp_dir}/landing{i}/_rejected/*").collect()
        assert sorted(r.value for r in bad) == ["not json", '{"committee_id": "C2", "na']
        table = silver.silver_from_sources("committee_master", None, df)
        assert table.where("com_id = ''").count() == 0


def test_land_json_skips_without_records(spark, tmp_dir):
    src = f"{tmp_dir}/in.json"
    for text, bad in (("", 0), ("\n\n", 0), ("junk\n", 1)):
        with open(src, "w") as f:
            f.write(text)
        for i, schema in enumerate((None, "committee_id string")):
            out = snapshots.land_json(spark, src, f"{tmp_dir}/{bad}{i}", "api_raw_committees", ts="20260101_000000",
                                      schema=schema)
            assert (out.path, out.rows, out.malformed) == (None, 0, bad)
            assert snapshots.read_snapshots(spark, f"{tmp_dir}/{bad}{i}", "api_raw_committees") is None
        assert silver.build_silver(spark, "committee_master", landing_root=f"{tmp_dir}/{bad}0") is None


def test_snapshots_are_found_at_any_depth(spark, tmp_dir):
    a = spark.createDataFrame([("1",)], "committee_id string")
    for i, sub in enumerate(("", "/2026-01", "/2026/02/03")):
        snapshots.write_snapshot(a, f"{tmp_dir}{sub}", "api_raw_committees", f"2026010{i + 1}_000000")
    snapshots.write_snapshot(a, f"{tmp_dir}/2026-01", "api_raw_candidates", "20260101_000000")
    assert len(snapshots.find_snapshots(spark, tmp_dir, "api_raw_committees")) == 3
    assert snapshots.read_snapshots(spark, tmp_dir, "api_raw_committees").count() == 3
    assert snapshots.read_snapshots(spark, f"{tmp_dir}/absent", "api_raw_committees") is None


def test_each_dataset_has_one_home(spark, tmp_dir):
    """A newer write wins, whichever of the two writers made it."""
    cols = R.target_columns("independent_expenditures")
    datasets = ("committee_contributions_to_candidates", "independent_expenditures")

    def rows(name, *labels):
        made = [tuple([d] + [name] * len(cols)) for d in labels]
        return spark.createDataFrame(made, ", ".join(f"{c} string" for c in ["dataset", *cols]))

    def held(d):
        return [r.com_id for r in tables.load_silver(spark, tmp_dir, [d])[d].collect()]

    assert tables.write_split_silver(rows("OLD", *datasets), tmp_dir, datasets) == dict.fromkeys(datasets, 1)
    tables.write_silver(rows("NEW", datasets[1]).drop("dataset"), tmp_dir, datasets[1])
    assert held(datasets[1]) == ["NEW"] and held(datasets[0]) == ["OLD"]
    got = tables.write_split_silver(rows("LAST", datasets[0]), tmp_dir, datasets)
    assert got == {datasets[0]: 1, datasets[1]: 0}
    assert held(datasets[0]) == ["LAST"] and held(datasets[1]) == []


def test_partitioned_write_clusters_its_rows(spark, tmp_dir):
    import glob

    df = spark.range(0, 4000, 1, 16).select((F.col("id") % 5).cast("string").alias("election_cycle"), "id")
    tables.write_table(df, f"{tmp_dir}/t", partition_by=["election_cycle"])
    files = glob.glob(f"{tmp_dir}/t/election_cycle=*/*.parquet")
    assert len(files) == 5 and spark.read.parquet(f"{tmp_dir}/t").count() == 4000
