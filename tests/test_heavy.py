"""Heavy join keys: found by a sketch, dealt over tasks in proportion to their bytes."""

import pytest
from pyspark.sql import functions as F

from flowlake.plans import heavy

N, ROW = 60_000, 100  # rows and bytes of a row


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows on one committee, a sixth on another, the rest on 997."""
    key = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 6 == 1, "WARM").otherwise(
        F.concat(F.lit("C"), (F.col("id") % 997).cast("string")))
    return spark.range(N).select(key.alias("com_id"), F.col("id").alias("x")).repartition(8).cache()


@pytest.fixture(scope="module")
def register(spark):
    names = [("HOT",), ("WARM",), ("WARM",), ("NOBODY",)] + [(f"C{i}",) for i in range(900)]
    return spark.createDataFrame(names, "com_id string").withColumn("cand_id", F.concat(F.lit("H"), "com_id"))


@pytest.mark.parametrize("tasks", [4, 30, 300])
def test_tasks_follow_the_share_of_bytes(facts, tasks):
    size = N * ROW
    got = {r.com_id: r.tasks for r in heavy.key_tasks(facts, "com_id", size // tasks, size).collect()}
    assert abs(got["HOT"] - tasks / 3) <= 1 and abs(got.get("WARM", 1) - tasks / 6) <= 1
    assert set(got) <= {"HOT", "WARM"}


def test_a_third_of_100_tb(facts):
    """At production sizes a committee with a third of the bytes gets a third of the tasks, the table of
    heavy keys stays below the number of tasks."""
    size, part = 100 << 40, 256 << 20
    got = heavy.key_tasks(facts, "com_id", part, size).collect()
    share = {r.com_id: r.tasks / (size / part) for r in got}
    assert abs(share["HOT"] - 1 / 3) < 0.001 and abs(share["WARM"] - 1 / 6) < 0.001
    assert len(got) <= 999 < size // part


def test_small_input_is_not_salted(facts, register):
    assert heavy.key_tasks(facts, "com_id", total_bytes=1 << 20) is None
    joined = heavy.salted_join(facts, register, "com_id", F.col("x"), total_bytes=1 << 20)
    assert heavy.SALT not in joined._jdf.queryExecution().optimizedPlan().toString()


def _sorted(df):
    return sorted(map(str, df.select("com_id", "x", "cand_id").collect()))


def test_salted_join_equals_the_join(spark, facts, register):
    some = facts.where("x < 3000").union(spark.createDataFrame([(None, 1), (None, 2)], facts.schema))
    got = heavy.salted_join(some, register, "com_id", F.col("x"), 1000, 30_000)
    assert _sorted(got) == _sorted(some.join(register, "com_id"))
    none = heavy.salted_join(some.limit(0), register, "com_id", F.col("x"), 1000, 30_000)
    assert none.count() == 0


def test_no_task_holds_the_heavy_committee(spark, facts, register):
    """Rows per task of the join: a task's worth, not a third of everything."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        count = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plain = facts.join(register.dropDuplicates(), "com_id")
        salted = heavy.salted_join(facts, register.dropDuplicates(), "com_id", F.col("x"), N * ROW // 128, N * ROW)
        assert count(plain) >= N / 3 and count(salted) < N / 3 / 8
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bytes_are_measured(spark, facts):
    """Texts weigh what they are long: the same rows with long texts need more tasks."""
    wide = facts.withColumn("note", F.repeat(F.lit("x"), 200))
    short, long = ({r.com_id: r.tasks for r in heavy.key_tasks(df, "com_id", 50_000).collect()} for df in (facts, wide))
    assert abs(long["HOT"] - N / 3 * (24 + 4 + 200) / 50_000) <= 2 and long["HOT"] > 5 * short["HOT"]
    joined = facts.join(facts.select("com_id").distinct(), "com_id")  # nor does the estimate of a join, which multiplies its sides, count
    assert max(r.tasks for r in heavy.key_tasks(joined, "com_id", 50_000).collect()) == short["HOT"]
