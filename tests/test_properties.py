"""Property tests: the date rule against a Python reading of the same
formats, and the two rollup plans against each other on generated facts."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlake.functions import rules
from flowlake.operators import gold

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def py_normalize_date(s):
    if s is None:
        return None
    t = s.strip()
    fmt = None
    if "-" in s:
        fmt = "%Y-%m-%d"
    elif sum(ch.isdigit() for ch in s) == 8:
        fmt = "%m%d%Y"
    if fmt is None:
        return None
    try:
        return dt.datetime.strptime(t, fmt).strftime("%Y-%m-%d")
    except ValueError:
        return None


def _pad(n, width, padded):
    return f"{n:0{width}d}" if padded else str(n)


dash_dates = st.builds(
    lambda y, m, d, pm, pd_, lead: (" " if lead else "") + f"{y:04d}-{_pad(m, 2, pm)}-{_pad(d, 2, pd_)}",
    st.integers(1900, 2100), st.integers(0, 13), st.integers(0, 32), st.booleans(), st.booleans(), st.booleans())
digit_dates = st.builds(lambda m, d, y: f"{m:02d}{d:02d}{y:04d}",
                        st.integers(0, 13), st.integers(0, 32), st.integers(1900, 2100))
junk = st.text(alphabet="abc /.xyz", max_size=8)
date_texts = st.lists(st.one_of(dash_dates, digit_dates, junk, st.none()), min_size=1, max_size=60)


@SETTINGS
@given(date_texts)
def test_normalize_date_matches_strptime(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(rules.normalize_date("v")).collect()]
    assert got == [py_normalize_date(v) for v in values]


fact_rows = st.lists(
    st.tuples(
        st.one_of(st.just("C0"), st.sampled_from(["C1", "C2", "C3", "C4", "C9"])),   # C0 is hot, C9 unknown
        st.sampled_from(["A", "B", "C", "D"]),
        st.sampled_from(["CA", "NY", "", None]),
        st.integers(-500000, 500000).map(lambda c: c / 100),
    ),
    min_size=1, max_size=200)


@SETTINGS
@given(fact_rows)
def test_rollup_plans_agree(spark, rows):
    facts = spark.createDataFrame(rows, "com_id string, contrib_name string, contrib_state string, trans_amt double")
    com = spark.createDataFrame([("C0", "PAC0", "H0"), ("C1", "PAC1", "H1"), ("C1", "PAC1B", "H1"),
                                 ("C2", "PAC2", "H2"), ("C3", "PAC3", ""), ("C4", "PAC4", "H4")],
                                "com_id string, com_name string, cand_id string")
    cand = spark.createDataFrame([("H0", "ZERO", "H", "[2024, 2026]"), ("H1", "ONE", "S", "2024"),
                                  ("H2", "TWO", "P", "2025"), ("H4", "FOUR", "H", "")],
                                 "cand_id string, cand_name string, cand_off string, cand_el_yr string")
    cyc = gold.explode_cycles(cand)

    def same(a, b):
        return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

    assert same(gold.geo_summary(facts, com, cyc, eager=True), gold.geo_summary(facts, com, cyc, eager=False))
    assert same(gold.edges_individual(facts, com, cyc, 1000, eager=True),
                gold.edges_individual(facts, com, cyc, 1000, eager=False))
    # exact cents: the rollup total equals the Python sum of cents
    total = gold.indiv_rollup(facts, com, exact=True).agg(F.sum("individual_funds")).first()[0] or 0
    mult = {"C0": 1, "C1": 2, "C2": 1, "C3": 1, "C4": 1}
    assert total == sum(round(a * 100) * mult.get(c, 0) for c, _, _, a in rows)
