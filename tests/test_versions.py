"""Versioned tables: what readers see when a writer dies, resumes or is refused."""

import os
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from flowlake import registry as R
from flowlake.plans import incremental, pipeline
from flowlake.sources import tables, versions

DS = "committee_master"


def rows(spark, n, start=0):
    cols = R.target_columns(DS)
    return spark.range(start, start + n).select(*(F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in cols))


def held(spark, root):
    return tables.load_silver(spark, root, [DS])[DS].count()


def test_versions_replace_one_another(spark, tmp_dir):
    layer = tables.silver_layer(tmp_dir)
    with pytest.raises(FileNotFoundError):
        tables.load_silver(spark, tmp_dir, [DS])
    for n in (3, 5, 7):
        tables.write_silver(rows(spark, n), tmp_dir, DS)
    assert held(spark, tmp_dir) == 7 and versions.read(spark, layer, DS, 1).count() == 3
    assert versions.vacuum(spark, layer, DS) == 1 and versions.history(spark, layer, DS) == [2, 3]
    assert held(spark, tmp_dir) == 7 and versions.read(spark, layer, DS, 2).count() == 5


def test_second_writer_of_a_version_is_refused(spark, tmp_dir):
    layer = tables.silver_layer(tmp_dir)
    tables.write_silver(rows(spark, 3), tmp_dir, DS)
    seen = versions.load(spark, layer, DS)
    part, _ = tables.stage_silver(rows(spark, 4), tmp_dir, DS)
    versions.commit(spark, layer, DS, seen, [part])
    late, _ = tables.stage_silver(rows(spark, 9), tmp_dir, DS)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, layer, DS, seen, [late])
    assert held(spark, tmp_dir) == 4 and versions.vacuum(spark, layer, DS) == 1
    assert not [f for _, _, fs in os.walk(layer) for f in fs if f.endswith(".tmp")]


KILLED = """
import sys, time
sys.path[:0] = [{repo!r}, {tests!r}]
from flowlake.session import get_session
from flowlake.sources import tables, versions
from test_versions import DS, rows
spark = get_session("local[2]", conf={{"spark.checkpoint.dir": {root!r} + "/ckpt"}})
def wait(*a, **k):
    print("READY", flush=True)
    time.sleep(600)
if {step!r} == "while writing":
    from pyspark.sql import functions as F
    slow = F.udf(lambda x: (time.sleep(0.2), x)[1], "string")
    print("READY", flush=True)
    df = rows(spark, 5000).withColumn("com_id", slow("com_id"))
else:
    df = rows(spark, 50)
    setattr(versions, {step!r}, wait)
tables.write_silver(df, {root!r}, DS)
"""


@pytest.mark.parametrize("step", ["while writing", "write_text", "move_new"])
def test_killed_writer_leaves_the_old_version(spark, tmp_dir, step):
    """The writer's process is killed by the system while it rewrites the table."""
    tables.write_silver(rows(spark, 20), tmp_dir, DS)
    here = os.path.dirname(os.path.abspath(__file__))
    code = KILLED.format(repo=os.path.dirname(here), tests=here, root=tmp_dir, step=step)
    writer = subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)
    for line in writer.stdout:
        if "READY" in line:
            break
    time.sleep(3 if step == "while writing" else 0)
    writer.send_signal(signal.SIGKILL)
    writer.wait()
    assert held(spark, tmp_dir) == 20
    tables.write_silver(rows(spark, 30), tmp_dir, DS)  # the next writer goes on
    assert held(spark, tmp_dir) == 30
    versions.vacuum(spark, tables.silver_layer(tmp_dir), DS, keep=1)
    assert held(spark, tmp_dir) == 30


def _bronze(root, lines):
    os.makedirs(f"{root}/bronze", exist_ok=True)
    with open(f"{root}/bronze/itoth.txt", "w") as f:
        f.writelines(line + "\n" for line in lines)


def _transfer(i, amount="5.00", date="01022024"):
    return "|".join([f"C{i}"] + ["x"] * 12 + [date, amount, "C9"] + ["x"] * 5)


TASK = [("inter_committee_transactions", "itoth.txt", "api_raw_none")]


def test_bad_input_keeps_the_published_table(spark, tmp_dir):
    d = TASK[0][0]
    _bronze(tmp_dir, [_transfer(i) for i in range(10)])
    good = pipeline.run_silver(spark, f"{tmp_dir}/bronze", None, tmp_dir, tasks=TASK, max_bad_share=0.2)[d]
    assert good["published"] and good["rows"] == 10
    _bronze(tmp_dir, [_transfer(i, amount="five") for i in range(6)] + [_transfer(i) for i in range(4)])
    bad = pipeline.run_silver(spark, f"{tmp_dir}/bronze", None, tmp_dir, tasks=TASK, max_bad_share=0.2)[d]
    assert not bad["published"] and bad["bad_trans_amt"] == 6 and pipeline.bad_share(bad) == 0.6
    assert tables.load_silver(spark, tmp_dir, [d])[d].agg(F.sum("trans_amt")).first()[0] == 50.0
    assert len(os.listdir(f"{tmp_dir}/silver/parts")) <= 2
    # without a limit the same input is published, bad amounts read as 0.0
    assert pipeline.run_silver(spark, f"{tmp_dir}/bronze", None, tmp_dir, tasks=TASK)[d]["published"]
    assert tables.load_silver(spark, tmp_dir, [d])[d].agg(F.sum("trans_amt")).first()[0] == 20.0


def _jobs(spark, run):
    """The Spark jobs that ``run`` starts."""
    tracker, name = spark.sparkContext.statusTracker(), f"jobs-{time.time()}"
    spark.sparkContext.setJobGroup(name, name, False)
    try:
        run()
        return len(tracker.getJobIdsForGroup(name))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_resume_builds_only_what_changed(spark, tmp_dir):
    other = [*TASK, ("committee_master", "cm.txt", "api_raw_none")]
    _bronze(tmp_dir, [_transfer(i) for i in range(10)])
    with open(f"{tmp_dir}/bronze/cm.txt", "w") as f:
        f.write("|".join(["C1"] + ["x"] * 14) + "\n")
    run = lambda tasks: pipeline.run_silver(spark, f"{tmp_dir}/bronze", None, tmp_dir, tasks=tasks, resume=True)
    first = run(TASK)  # the run stopped before the second dataset
    both = run(other)
    assert both[TASK[0][0]] == {**first[TASK[0][0]], "resumed": True} and "resumed" not in both[DS]
    assert all(m["resumed"] for m in run(other).values())
    versions_of = lambda: {d: versions.history(spark, tables.silver_layer(tmp_dir), d)[-1] for d, _, _ in other}
    before = versions_of()
    assert _jobs(spark, lambda: run(other)) == 0
    _bronze(tmp_dir, [_transfer(i) for i in range(11)])
    again = run(other)
    assert again[TASK[0][0]]["rows"] == 11 and "resumed" in again[DS]
    assert {d: versions_of()[d] - before[d] for d in before} == {TASK[0][0]: 1, DS: 0}


# ---------------------------------------------------------------- increments


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_reads_old_silver_without_a_shuffle(spark, tmp_dir):
    layer = tables.silver_layer(tmp_dir)
    nulls = lambda df: df.withColumn("com_city", F.when(F.rand(3) < 0.5, F.col("com_city"))).cache()
    old, inc = nulls(rows(spark, 500)), nulls(rows(spark, 400, start=300))
    tables.write_silver(old, tmp_dir, DS, buckets=8)
    again = inc.union(inc).union(old.limit(100))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        incremental.merge(rows(spark, 10, start=5000), tmp_dir, DS)  # a second part
        plan = _plan(versions.distinct_from(again, layer, versions.load(spark, layer, DS)))
        scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "parts" in ln]
        assert len(scans) == 2 and all("Bucketed: true" in ln for ln in scans)
        depth = lambda ln: len(ln) - len(ln.lstrip(" :|+-*()0123456789"))
        lines = plan.splitlines()
        for ln in scans:  # nothing between a scan and its join moves rows
            at = lines.index(ln)
            level = depth(ln)
            for above in reversed(lines[:at]):
                if depth(above) < level:
                    level = depth(above)
                    if "Join" in above:
                        break
                    assert "Exchange" not in above
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    done = incremental.merge(again, tmp_dir, DS)
    got = tables.load_silver(spark, tmp_dir, [DS])[DS].select(*old.columns)
    want = old.union(again).union(rows(spark, 10, start=5000).select(*old.columns)).distinct()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert done.commit.rows == want.count() and len(done.commit.parts) == 3
    assert incremental.merge(again, tmp_dir, DS).new_rows == 0  # a replayed increment adds nothing


def test_parts_are_folded(spark, tmp_dir):
    tables.write_silver(rows(spark, 10), tmp_dir, DS, buckets=4)
    for i in range(1, 5):
        state = incremental.merge(rows(spark, 12, start=10 * i), tmp_dir, DS, max_parts=3).commit
        assert len(state.parts) <= 3 and state.rows == held(spark, tmp_dir) == 10 * i + 12
    with pytest.raises(ValueError):
        tables.write_silver(rows(spark, 10), tmp_dir, DS)
        incremental.merge(rows(spark, 1), tmp_dir, DS)


FACTS = {
    "individual_contributions": "contrib_name string, com_id string, contrib_state string, trans_amt double",
    "committee_contributions_to_candidates": "com_id string, cand_id string, trans_amt double",
    "independent_expenditures": "com_id string, cand_id string, trans_amt double",
    "inter_committee_transactions": "com_id string, other_com_id string, trans_amt double",
}
INCREMENTS = [
    {"individual_contributions": [("ANN", "C1", "CA", 900000.0), ("BOB", "C1", "", 5.25)],
     "committee_contributions_to_candidates": [("C2", "H1", 10.0)], "independent_expenditures": [("C2", "H1", -7.0)],
     "inter_committee_transactions": [("C1", "C2", 400.0)]},
    {"individual_contributions": [("ANN", "C1", "CA", -900000.5), ("EVE", "C2", "NY", 1.1)],  # the sum turns negative
     "committee_contributions_to_candidates": [("C2", "H1", -30.0)], "independent_expenditures": [],
     "inter_committee_transactions": [("C1", "C2", -9e9)]},
    {"individual_contributions": [("ANN", "C1", "CA", -9e8), ("EVE", "C1", "NY", 2.2)],
     "committee_contributions_to_candidates": [("C1", "H2", 4.0)], "independent_expenditures": [("C1", "H2", 3.0)],
     "inter_committee_transactions": [("C2", "C1", 1.0)]},
]


def _gold_rows(made):
    return {n: sorted(map(str, df.collect())) for n, df in made.items()}


def test_maintained_gold_equals_a_full_run(spark, tmp_dir):
    from flowlake.operators import gold

    com = spark.createDataFrame([("C1", "H1", "ONE"), ("C2", "H2", "TWO")], "com_id string, cand_id string, com_name string")
    cand = spark.createDataFrame([("H1", "A", "H", "[2024, 2026]"), ("H2", "B", "S", "2024")],
                                 "cand_id string, cand_name string, cand_off string, cand_el_yr string")
    tables.write_silver(com, tmp_dir, "committee_master")
    tables.write_silver(cand, tmp_dir, "candidate_master")
    for k, one in enumerate(INCREMENTS):
        for d, new in one.items():
            incremental.append(spark.createDataFrame(new, FACTS[d]), tmp_dir, d)
        read = incremental.refresh(spark, tmp_dir)
        assert max(read.values()) == 1  # of the silver parts only the new one
        if k == 1:  # a register changes: the partial sums do not
            com = com.union(spark.createDataFrame([("C1", "H2", "ONE")], com.schema))
            tables.write_silver(com, tmp_dir, "committee_master")
        full = gold.build_gold(tables.load_silver(spark, tmp_dir))
        assert _gold_rows(incremental.gold_tables(spark, tmp_dir)) == _gold_rows(full)
    assert set(incremental.refresh(spark, tmp_dir).values()) == {0}
    assert full["geo_summary"].where("total_amount > 9e8").count() > 0


def test_partials_follow_a_rewrite_and_a_fold(spark, tmp_dir):
    d = "inter_committee_transactions"
    for other in set(FACTS) - {d}:
        incremental.append(spark.createDataFrame([], FACTS[other]), tmp_dir, other)
    one = lambda *amounts: spark.createDataFrame([("C1", "C2", float(a)) for a in amounts], FACTS[d])
    total = lambda: versions.read(spark, incremental.partials_layer(tmp_dir), "transfers").agg(
        F.sum("_amt"), F.sum("_n")).first()[:]
    for a in (1, 2, 3):
        incremental.append(one(a), tmp_dir, d)
        incremental.refresh(spark, tmp_dir)
    assert total() == (600, 3)
    incremental.fold(spark, tables.silver_layer(tmp_dir), d)  # the same rows in one part
    assert incremental.refresh(spark, tmp_dir)["transfers"] == 0 and total() == (600, 3)
    incremental.append(one(4), tmp_dir, d)
    assert incremental.refresh(spark, tmp_dir, max_parts=2)["transfers"] == 1 and total() == (1000, 4)
    tables.write_silver(one(7), tmp_dir, d)  # rewritten: summed anew
    assert incremental.refresh(spark, tmp_dir)["transfers"] == 1 and total() == (700, 1)


def test_refresh_that_fails_adds_nothing_twice(spark, tmp_dir, monkeypatch):
    d = "inter_committee_transactions"
    for other in set(FACTS) - {d}:
        incremental.append(spark.createDataFrame([], FACTS[other]), tmp_dir, other)
    incremental.append(spark.createDataFrame([("C1", "C2", 5.0)], FACTS[d]), tmp_dir, d)
    for step in ("write_text", "move_new"):
        monkeypatch.setattr(versions, step, lambda *a, **k: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            incremental.refresh(spark, tmp_dir)
        monkeypatch.undo()
    incremental.refresh(spark, tmp_dir)
    incremental.refresh(spark, tmp_dir)
    sums = versions.read(spark, incremental.partials_layer(tmp_dir), "transfers")
    assert [tuple(r) for r in sums.select("_amt", "_n").collect()] == [(500, 1)]


def test_buckets_follow_the_input(spark, tmp_dir):
    """A larger table gets more buckets, not larger ones."""
    from flowlake.sources.versions import buckets_for

    for name, n in (("small", 1000), ("large", 100_000)):
        rows(spark, n).repartition(4).write.parquet(f"{tmp_dir}/{name}")
    small, large = (spark.read.parquet(f"{tmp_dir}/{name}") for name in ("small", "large"))
    assert buckets_for(small) == 8
    assert buckets_for(large, 4096) > 10 * buckets_for(small, 4096) > 80


def test_maintained_payments_are_joined_once(spark, monkeypatch):
    """Every increment holds its rows of the joined payments, which are dealt in one write."""
    from conftest import SF_SMALL
    from flowlake.plans import catalog

    planned = []
    append = incremental.append
    monkeypatch.setattr(incremental, "append", lambda df, root, d, *a, **k: (
        planned.append((d, df._jdf.queryExecution().optimizedPlan().toString())), append(df, root, d, *a, **k))[1])
    root = catalog.maintained_root(spark, SF_SMALL)
    plans = [p for d, p in planned if d == "individual_contributions"]
    assert len(plans) == 3 and not any("Join" in p for p in plans)
    inputs = catalog._in(spark, SF_SMALL)
    for d in {d for d, _ in incremental.PARTIALS.values()}:
        kept = tables.load_silver(spark, root, [d])[d]
        assert kept.exceptAll(inputs[d]).isEmpty() and inputs[d].exceptAll(kept).isEmpty()
