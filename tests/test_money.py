"""Exact sums of money: amounts beyond 1e12, below the cent, of mixed signs, in any order."""

import random
from fractions import Fraction

import pytest

from flowlake.functions import rules
from flowlake.operators import gold, views


def _total(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").agg(rules.sum_money("x")).first()[0]


@pytest.mark.parametrize("values,total", [
    ([1e13], 1e13),
    ([0.004] * 1000, 4.0),
    ([0.005, -0.005, 0.001], 0.001),
    ([1e13, 0.25, -1e13], 0.25),
    ([1e26, 0.01, -1e26, -0.004], 0.006),
    ([999999999999.99, 0.01], 1e12),
    ([-25000000000001.25, 25000000000001.25, -7.5], -7.5),
    ([1e27, float("inf"), float("nan"), 3.0], 3.0),
    ([0.1] * 10 + [0.2], 1.2),
    ([None, None], None),
    ([None, 2.5], 2.5),
])
def test_wide_sums_are_exact(spark, values, total):
    assert _total(spark, values) == total


def test_sums_equal_decimal_sums(spark):
    rng = random.Random(7)
    kinds = [lambda: rng.randint(-10 ** 8, 10 ** 8) / 100, lambda: rng.randint(-10 ** 9, 10 ** 9) / 10 ** 6,
             lambda: rng.randint(-10 ** 6, 10 ** 6) * 1e20, lambda: rng.randint(-9 ** 15, 9 ** 15) / 100]
    groups = [[rng.choice(kinds)() for _ in range(rng.choice([1, 2, 3, 30]))] for _ in range(200)]
    rows = [(g, v) for g, values in enumerate(groups) for v in values]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "g int, x double")
        got = dict(df.groupBy("g").agg(rules.sum_money("x")).collect())
        # an amount is what its shortest decimal form says
        assert got == {g: float(sum(Fraction(repr(v)) for v in values)) for g, values in enumerate(groups)}


def test_parts_add_up(spark):
    values = [(1234567890123456.0,), (-1e26,), (2.0 ** 80,), (0.004,), (-17.35,), (25000000012345.67,), (-1e9 - 0.004,)]
    rows = spark.createDataFrame(values, "x double").select("x", *rules.money_parts("x")).collect()
    for r in rows:
        assert r._tera * 10 ** 12 + Fraction(r._amt, 100) + Fraction(r._micro, 10 ** 6) == Fraction(repr(r.x)), r


def test_gold_holds_wide_and_small_amounts(spark):
    ind = spark.createDataFrame(
        [("A", "C1", "NY", 1e13)] * 3 + [("A", "C1", "NY", -1e13), ("B", "C1", "TX", 15000.0), ("B", "C1", "TX", 0.004),
                                         ("D", "C1", "TX", 15000.0), ("E", "C1", "CA", 0.004), ("E", "C1", "CA", -0.004)],
        "contrib_name string, com_id string, contrib_state string, trans_amt double")
    com = spark.createDataFrame([("C1", "PAC", "H1")], "com_id string, com_name string, cand_id string")
    cyc = gold.explode_cycles(spark.createDataFrame([("H1", "ONE", "S", "2024")],
                                                    "cand_id string, cand_name string, cand_off string, cand_el_yr string"))
    direct = spark.createDataFrame([("C1", "H1", 0.004)], "com_id string, cand_id string, trans_amt double")
    geo = gold.geo_summary(ind, com, cyc)
    assert {r.state: r.total_amount for r in geo.collect()} == {"NY": 2e13, "TX": 30000.004, "CA": 0.0}
    donor = gold.donor_type_summary(ind, com, direct, cyc).first()
    assert (donor.individual_funds, donor.committee_funds) == (20000000030000.004, 0.004)
    # the threshold is exact: 15000.004 is above 15000, 15000 is not
    edges = {r.source_node: r.weight for r in gold.edges_individual(ind, com, cyc, 15000).collect()}
    assert edges == {"A": 2e13, "B": 15000.004}
    # nor does a view lose a total beyond 1e12
    assert views.top_states(views.state_map(geo, "2024", "S")).first().total_amount == 2e13
