"""Every catalogue query against its DuckDB oracle (row count, columns,
order-insensitive values) on the smallest test tables."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from flowlake.plans import catalog

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def cell(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return repr(v)
    return sorted("|".join(cell(r[i]) for i in order) for r in rows)


def test_catalogue_complete():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert len(catalog.QUERIES) == 60


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_parity(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(catalog.SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)
