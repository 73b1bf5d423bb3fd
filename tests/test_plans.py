"""Plan checks: dimensions broadcast after a size check, scans pruned and
filtered at the source, no Python UDF anywhere in the catalogue."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowlake.operators import gold
from flowlake.plans import bindings as B
from flowlake.plans import catalog, joins


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_geo_summary_broadcasts_dims_and_prunes(spark):
    plan = _plan(catalog.QUERIES["geo_summary"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # lineitem is read with only the columns the query needs
    lineitem_scan = [ln for ln in plan.splitlines() if "lineitem" in ln and "ReadSchema" in ln]
    assert lineitem_scan and all("l_quantity" not in ln and "l_shipdate" not in ln for ln in lineitem_scan)


def test_size_check_blocks_large_side(spark):
    li = B.frame(spark, SF_SMALL, "individual")
    assert joins.fits_broadcast(li, limit=1) is False
    assert joins.sized_broadcast(li, limit=1) is li
    nat = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    assert joins.fits_broadcast(nat)
    assert joins.parse_bytes("64MB") == 64 << 20


def test_eager_path_when_dims_too_large(spark):
    s = B.silver_inputs(spark, SF_SMALL)
    cyc = gold.explode_cycles(s["candidate_master"])
    eager = gold.geo_summary(s["individual_contributions"], s["committee_master"], cyc, eager=True)
    direct = gold.geo_summary(s["individual_contributions"], s["committee_master"], cyc, eager=False)
    assert sorted(map(tuple, eager.collect())) == sorted(map(tuple, direct.collect()))


def test_union_edge_count(spark):
    s = B.silver_inputs(spark, SF_SMALL)
    cyc = gold.explode_cycles(s["candidate_master"])
    com = s["committee_master"]
    parts = [
        gold.edges_individual(s["individual_contributions"], com, cyc),
        gold.edges_direct(s["committee_contributions_to_candidates"], com, cyc),
        gold.edges_transfer(s["inter_committee_transactions"], com),
        gold.edges_independent(s["independent_expenditures"], com, cyc),
    ]
    total = catalog.QUERIES["network_edges"](spark, SF_SMALL).count()
    assert total == sum(p.count() for p in parts)


def test_filters_pushed_to_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where(F.col("l_returnflag") == "R")
    plan = _plan(df.select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_udf(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_scale_conf():
    from flowlake.session import scale_conf

    assert scale_conf(100 * (1 << 40))["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) >> 28)
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_jobs_run_with_sized_shuffles(spark, monkeypatch):
    from flowlake import session

    monkeypatch.setattr(session, "scale_conf", lambda n, least=1: {"spark.sql.shuffle.partitions": str(least + n)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_for(spark, 5):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(int(before) + 5)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_exploded_register_gets_no_hint(spark):
    """60,000 rows from 1,000: the estimate ignores the fan-out, so it proves nothing."""
    cand = spark.range(1000).select(
        F.concat(F.lit("H"), F.col("id").cast("string")).alias("cand_id"), F.lit("N").alias("cand_name"),
        F.lit("H").alias("cand_off"),
        F.array_join(F.transform(F.sequence(F.lit(1900), F.lit(2018), F.lit(2)), lambda y: y.cast("string")), ",")
        .alias("cand_el_yr"))
    cycles = gold.explode_cycles(cand)
    assert cycles.count() == 60000
    assert joins.estimated_bytes(cycles) < joins.DEFAULT_LIMIT
    assert not joins.fits_broadcast(cycles) and joins.sized_broadcast(cycles) is cycles


def test_individual_edges_shuffle_raw_facts_once(spark):
    """Without a broadcastable register: one fact shuffle before the first
    aggregate, salted, and no fan-out over cycles below it."""
    old = {k: spark.conf.get(k, None) for k in ("flowlake.broadcast.maxBytes", "spark.sql.autoBroadcastJoinThreshold",
                                                "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("1", "-1", "false")):
        spark.conf.set(k, v)
    try:
        facts = spark.range(1000).select(
            F.concat(F.lit("C"), (F.col("id") % 9).cast("string")).alias("com_id"),
            F.col("id").cast("string").alias("contrib_name"), F.lit(1.0).alias("trans_amt"))
        com = spark.range(9).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("com_id"),
                                    F.lit("H0").alias("cand_id"))
        cand = spark.createDataFrame([("H0", "A", "H", "[2024, 2026]")],
                                     "cand_id string, cand_name string, cand_off string, cand_el_yr string")
        df = gold.edges_individual(facts, com, gold.explode_cycles(cand), partition_bytes=1024)
        lines = _plan(df).splitlines()
        depth = lambda ln: len(ln) - len(ln.lstrip(" :|+-*()0123456789"))
        fact = next(i for i, ln in enumerate(lines) if "Range (0, 1000" in ln)
        above, level = [], depth(lines[fact])
        for ln in reversed(lines[:fact]):  # the operators between the facts and the result
            if depth(ln) < level:
                above.append(ln.strip(" :|+-*()0123456789"))
                level = depth(ln)
        first = next(i for i, ln in enumerate(above) if "HashAggregate" in ln)
        below = above[:first]
        exchanges = [ln for ln in below if ln.startswith("Exchange")]
        assert len(exchanges) == 1 and "com_id" in exchanges[0] and "_salt" in exchanges[0]
        joins_below = [ln.split()[0] for ln in below if "Join" in ln]  # the heavy keys, then the register
        assert sorted(joins_below) == ["BroadcastHashJoin", "SortMergeJoin"]
        assert not any("Generate" in ln for ln in below)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_races_shuffle_donor_payments_once(spark):
    """Register and cycles in one broadcast: the payments are shuffled to their edges only; same edges as by shuffles,
    with null keys, a committee named twice and a candidate without cycles."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("C"), (F.col("id") % 9).cast("string"))).alias("com_id"),
        F.when(F.col("id") % 13 > 0, (F.col("id") % 50).cast("string")).alias("contrib_name"),
        (F.col("id") - 1000.0).alias("trans_amt"))
    com = spark.sql("SELECT * FROM VALUES ('C1', 'H0'), ('C2', 'H1'), ('C2', 'H1'), ('C3', NULL), (NULL, 'H0'), "
                    "('C4', 'H2') AS t(com_id, cand_id)")
    cand = spark.sql("SELECT * FROM VALUES ('H0', 'A', 'H', '[2024, 2026]'), ('H1', 'A', 'H', '2024'), "
                     "('H2', 'B', 'S', '2025') AS t(cand_id, cand_name, cand_off, cand_el_yr)")
    cycles = gold.explode_cycles(cand)
    once = gold.edges_individual(facts, com, cycles, min_weight=0.0)
    shuffled = gold.edges_individual(facts, com, cycles, min_weight=0.0, broadcast_limit=0)
    assert len([ln for ln in _plan(once).splitlines() if "- Exchange" in ln]) == 1
    found = sorted(map(repr, once.collect()))
    assert found and found == sorted(map(repr, shuffled.collect()))
    assert gold._small_races(com, cycles, 40) is None  # counted: more than the limit


def test_second_snapshot_is_copied_from_the_first(spark, tmp_dir):
    from flowlake.sources import snapshots

    catalog._land_individual(spark, SF_SMALL, tmp_dir)
    paths = snapshots.find_snapshots(spark, f"{tmp_dir}/landing", "api_raw_individual_contribs")
    first, second = (spark.read.parquet(p) for p in sorted(paths))
    assert first.schema == second.schema and first.count() == second.count() > 0
    assert first.exceptAll(second).isEmpty()


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_payment_joins_are_dealt_by_their_bytes(spark, monkeypatch):
    """A large join gets a partition per ``TASK_BYTES``, whatever the session's number; the rows are the same."""
    def edges():
        return catalog.QUERIES["network_individual"](spark, SF_SMALL)

    before = _rows(edges())
    monkeypatch.setattr(joins, "TASK_BYTES", 1 << 10)
    assert len(re.findall(r"REPARTITION_BY_NUM", _plan(edges()))) >= 2
    assert _rows(edges()) == before


def test_sums_meet_their_cycles_in_dealt_partitions(spark, monkeypatch):
    """The register, then the candidates' cycles, by shuffle: three joins of the payments, all dealt by their bytes."""
    def edges():
        return catalog.QUERIES["network_individual_shuffled"](spark, SF_SMALL)

    before = _rows(edges())
    monkeypatch.setattr(joins, "TASK_BYTES", 1 << 10)
    assert len(re.findall(r"Exchange hashpartitioning\(cand_id#\d+, \d+\), REPARTITION_BY_NUM", _plan(edges()))) == 2
    assert _rows(edges()) == before


def test_stored_gold_joins_the_payments_once(spark, tmp_path, monkeypatch):
    """Rollup and edges read one table of joined payments, not the orders again."""
    built = {}
    monkeypatch.setattr(catalog.tables, "write_gold", lambda t, root, **kw: built.update(t))
    catalog._write_gold(spark, SF_SMALL, str(tmp_path))
    assert "orders.parquet" not in _plan(built["network_metrics"])
    assert spark.read.parquet(f"{tmp_path}/_payments").count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
