"""Scalar rules: the edge cases of FIXTURES.md section 4."""

from pyspark.sql import functions as F

from flowlake.functions import rules


def _apply(spark, values, rule, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_normalize_date(spark):
    vals = ["03312026", " 03312026", "2026-03-31", "2026-3-1", "13312026", "02302026",
            "01/02/2026", "2026-03-31T00:00:00", "junk", "", None]
    assert _apply(spark, vals, rules.normalize_date) == [
        "2026-03-31", "2026-03-31", "2026-03-31", "2026-03-01",
        None, None, None, "2026-03-31", None, None, None]


def test_normalize_amount(spark):
    vals = ["5", "-20.5", None, "", "None", "nan"]
    assert _apply(spark, vals, rules.normalize_amount) == [5.0, -20.5, 0.0, 0.0, 0.0, 0.0]


def test_normalize_id(spark):
    assert _apply(spark, [" c1 ", None, "h12"], rules.normalize_id) == ["C1", "", "H12"]


def test_normalize_label(spark):
    assert _apply(spark, [None, " acme ", ""], rules.normalize_label) == ["NOT SPECIFIED", "ACME", ""]


def test_normalize_text_and_tokens(spark):
    assert _apply(spark, [None, "x"], rules.normalize_text) == ["", "x"]
    assert _apply(spark, ["nan", "None", "ok", None], rules.null_tokens) == [None, None, "ok", None]


def test_floor_at_zero(spark):
    assert _apply(spark, [None, -3.0, 2.5], rules.floor_at_zero, "double") == [0.0, 0.0, 2.5]


def test_cents_exact(spark):
    vals = [0.1, 0.2, 68423.46, -20.05, None]
    assert _apply(spark, vals, rules.cents, "double") == [10, 20, 6842346, -2005, None]
    # summing in cents is exact: 0.1 + 0.2 == 0.3
    df = spark.createDataFrame([(0.1,), (0.2,)], "x double")
    assert df.select(rules.from_cents(F.sum(rules.cents("x")))).first()[0] == 0.3


def test_state_and_office_lookup(spark):
    assert _apply(spark, ["CA", "DC", "ZZ", None], rules.state_full) == [
        "California", "District of Columbia", "ZZ", None]
    assert _apply(spark, ["P", "H", "S", "Senate"], rules.office_label) == [
        "President", "House", "Senate", "Senate"]


def test_format_currency(spark):
    assert _apply(spark, [1234.5, 0.0, -1234.5], rules.format_currency, "double") == [
        "$1,234.50", "$0.00", "$-1,234.50"]
    assert _apply(spark, [1234], rules.format_count, "bigint") == ["1,234"]


def test_strip_list_text(spark):
    assert _apply(spark, ["[2024, 2026]", "['2024']", '["2024","2026"]'], rules.strip_list_text) == [
        "2024,2026", "2024", "2024,2026"]


def test_bad_values_are_counted_not_fatal(spark):
    data = [("2026-01-05T00:00:00", "inf"), ("2026-1-5 10:11:12.5Z", "-Infinity"), ("junk", "1e30"), ("", "1,000.00"),
            (None, None), ("02302026", "$5"), ("2026-13-01", "NaN"), ("03312026", "0.004"), (" ", " 7 ")]
    df = spark.createDataFrame(data, "d string, a string")
    rows = df.select(rules.normalize_date("d").alias("d"), rules.normalize_amount("a").alias("a")).collect()
    assert [r.d for r in rows] == ["2026-01-05", "2026-01-05", None, None, None, None, None, "2026-03-31", None]
    assert [r.a for r in rows] == [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.004, 7.0]
    counts = df.agg(F.count_if(rules.rejected_date("d")), F.count_if(rules.rejected_amount("a")),
                    F.count_if(rules.sub_cent("a"))).first()
    assert tuple(counts) == (3, 6, 1)
    wild = spark.createDataFrame([(float("inf"),), (1e30,), (float("nan"),), (2.5,)], "x double")
    assert wild.agg(F.sum(rules.cents("x"))).first()[0] == 250
