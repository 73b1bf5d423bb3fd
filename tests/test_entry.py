"""The driver contract of __spark_entry__.py."""

import importlib.util
import os
import re

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark, entry_module):
    df = entry_module.entry(spark)
    assert df.columns == ["cand_id", "cand_name", "office_type", "election_cycle", "state",
                          "total_amount", "total_donations"]
    assert df.count() > 0


def test_every_query_has_oracle_sql(entry_module):
    qs, sql = entry_module.queries(), entry_module.oracle_sql()
    own = {k for k in qs if not re.match(r"op\d+_|pipeline$", k)}
    assert own == set(sql) & own and len(own) == 60
    assert all(callable(f) for f in qs.values()) and set(sql) <= set(qs)


def test_training_data_queries_come_together_or_not_at_all(entry_module):
    more = {k for k in entry_module.queries() if re.match(r"op\d+_|pipeline$", k)}
    assert len(more) == (14 if importlib.util.find_spec("corpus_pipeline") and importlib.util.find_spec("flowlake.llm")
                         else 0)


@pytest.mark.parametrize("name", ["geo_summary", "view_network_metrics", "view_flow_share", "format_currency",
                                  "layer_counts", "normalize_date"])
def test_output_columns_are_plain_aliases(spark, entry_module, name):
    df = entry_module.queries()[name](spark, "/root/testdata/sf0.001")
    assert all(re.fullmatch(r"[a-z_][a-z0-9_]*", c) for c in df.columns), df.columns
