"""A third of all rows on one key: both rollup plans agree with a plain
join-then-aggregate, and nothing collapses the hot key into one row early."""

from pyspark.sql import functions as F

from flowlake.operators import gold, silver


def _facts(spark, n=30000):
    # committee C0 receives a third of all rows
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("C0")).otherwise(F.concat(F.lit("C"), (F.col("id") % 97 + 1).cast("string"))).alias("com_id"),
        F.concat(F.lit("DONOR "), (F.col("id") % 500).cast("string")).alias("contrib_name"),
        F.when(F.col("id") % 7 == 0, F.lit("")).otherwise(F.lit("CA")).alias("contrib_state"),
        ((F.col("id") % 1000) / 100 - 2).alias("trans_amt"),
    )
    com = spark.range(98).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("com_id"),
                                 F.concat(F.lit("COM "), F.col("id").cast("string")).alias("com_name"),
                                 F.concat(F.lit("H"), (F.col("id") % 5).cast("string")).alias("cand_id"))
    cand = spark.createDataFrame([(f"H{i}", f"CAND {i}", "H", "[2024, 2026]") for i in range(5)],
                                 "cand_id string, cand_name string, cand_off string, cand_el_yr string")
    return df, com, gold.explode_cycles(cand)


def test_hot_key_rollups_agree(spark):
    facts, com, cyc = _facts(spark)
    eager = gold.geo_summary(facts, com, cyc, eager=True)
    direct = gold.geo_summary(facts, com, cyc, eager=False)
    plain = (facts.where("contrib_state <> ''").join(com, "com_id").join(cyc, "cand_id")
             .groupBy("cand_id", "election_cycle").agg(F.count(F.lit(1)).alias("n")))
    assert sorted(map(tuple, eager.collect())) == sorted(map(tuple, direct.collect()))
    total = {(r.cand_id, str(r.election_cycle)): r.n for r in plain.collect()}
    got = {(r.cand_id, r.election_cycle): r.total_donations for r in eager.collect()}
    assert got == total
    e1 = gold.edges_individual(facts, com, cyc, eager=True)
    e2 = gold.edges_individual(facts, com, cyc, eager=False)
    assert sorted(map(tuple, e1.collect())) == sorted(map(tuple, e2.collect()))


def test_hot_duplicates_dedup(spark):
    facts, _, _ = _facts(spark)
    hot = facts.where("com_id = 'C0'").select("com_id").union(facts.select("com_id"))
    assert silver.dedup(hot).count() == facts.select("com_id").distinct().count()
