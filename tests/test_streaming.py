"""Incremental snapshot ingest equals the batch DISTINCT over all sources."""

import glob
import os

import pytest

from flowlake.operators import silver
from flowlake.plans import bindings as B
from flowlake.sources import snapshots, tables
from flowlake.sources import versions
from flowlake.streaming import compact_increments, ingest_increments, landing, read_with_increments

from conftest import SF_SMALL

DS = "individual_contributions"


def _rows(df):
    return sorted(tuple("NULL" if v is None else v for v in r) for r in df.collect())


def test_incremental_equals_batch(spark, tmp_dir):
    landing, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/_ckpt"
    bulk = B.frame(spark, SF_SMALL, "raw_itcont")
    api = B.frame(spark, SF_SMALL, "raw_itcont_api")
    tables.write_silver(silver.silver_from_sources(DS, bulk, None), tmp_dir, DS)
    old = sorted(glob.glob(f"{tmp_dir}/silver/**/*.parquet", recursive=True))

    snapshots.write_snapshot(api.sample(fraction=0.5, seed=7), landing, "api_raw_individual_contribs", "20260101_000000")
    snapshots.write_snapshot(B.frame(spark, SF_SMALL, "raw_cm_api"), landing, "api_raw_committees", "20260101_000000")
    ingest_increments(spark, landing, DS, tmp_dir, ckpt).awaitTermination()

    # second pull, in a subfolder, overlaps the first one completely and adds the rest
    snapshots.write_snapshot(api, f"{landing}/2026-01", "api_raw_individual_contribs", "20260102_000000")
    ingest_increments(spark, landing, DS, tmp_dir, ckpt).awaitTermination()
    # a replay with nothing new changes nothing
    ingest_increments(spark, landing, DS, tmp_dir, ckpt).awaitTermination()

    want = silver.silver_from_sources(DS, bulk, api)
    assert sorted(glob.glob(f"{tmp_dir}/silver/**/*.parquet", recursive=True)) == old  # batches leave it alone
    assert _rows(read_with_increments(spark, tmp_dir, DS)) == _rows(want)
    assert compact_increments(spark, tmp_dir, DS) == want.count()
    assert _rows(tables.load_silver(spark, tmp_dir, [DS])[DS].select(*want.columns)) == _rows(want)
    assert _rows(read_with_increments(spark, tmp_dir, DS)) == _rows(want)


def _land(spark, root, df, name):
    tables.write_table(df, f"{landing.increments_path(root, DS)}/batch={name}")


@pytest.fixture()
def table(spark, tmp_dir):
    bulk = silver.silver_from_sources(DS, B.frame(spark, SF_SMALL, "raw_itcont"), None).limit(300).cache()
    tables.write_silver(bulk.limit(100), tmp_dir, DS)
    return tmp_dir, bulk


def test_an_increment_that_lands_meanwhile_is_kept(spark, table, monkeypatch):
    root, rows = table
    _land(spark, root, rows.limit(150), "a-0")
    real = versions.commit

    def commit(*a, **k):  # the stream writes while the merged table is about to be published
        _land(spark, root, rows, "a-1")
        return real(*a, **k)

    monkeypatch.setattr(landing.versions, "commit", commit)
    assert compact_increments(spark, root, DS) == 150
    monkeypatch.undo()
    assert os.listdir(landing.increments_path(root, DS)) == ["batch=a-1"]
    assert _rows(read_with_increments(spark, root, DS)) == _rows(rows)
    assert compact_increments(spark, root, DS) == 300 and os.listdir(landing.increments_path(root, DS)) == []
    assert compact_increments(spark, root, DS) == 300  # nothing left to do


@pytest.mark.parametrize("step", ["versions.write_text", "versions.move_new", "landing.delete_path", "tables.write_table"])
def test_a_failure_at_any_step_loses_nothing(spark, table, monkeypatch, step):
    """Whatever step of the compaction fails, readers see all rows, and the next run completes it."""
    root, rows = table
    _land(spark, root, rows.limit(150), "a-0")
    _land(spark, root, rows, "a-1")
    module, name = step.split(".")
    owner = {"versions": versions, "landing": landing, "tables": tables}[module]

    def fails(*a, **k):
        raise OSError("the writer died")

    monkeypatch.setattr(owner, name, fails)
    with pytest.raises(OSError):
        compact_increments(spark, root, DS)
    monkeypatch.undo()
    assert _rows(read_with_increments(spark, root, DS)) == _rows(rows)
    held = tables.load_silver(spark, root, [DS])[DS].count()
    assert held == (300 if step == "landing.delete_path" else 100)
    assert compact_increments(spark, root, DS) == 300
    assert _rows(tables.load_silver(spark, root, [DS])[DS].select(*rows.columns)) == _rows(rows)
    assert os.listdir(landing.increments_path(root, DS)) == []


def test_a_bucketed_table_takes_increments_as_parts(spark, tmp_dir):
    rows = silver.silver_from_sources(DS, B.frame(spark, SF_SMALL, "raw_itcont"), None).limit(300).cache()
    tables.write_silver(rows.limit(100), tmp_dir, DS, buckets=4)
    first = tables.silver_paths(spark, tmp_dir, DS)
    _land(spark, tmp_dir, rows, "a-0")
    assert compact_increments(spark, tmp_dir, DS) == 300
    assert tables.silver_paths(spark, tmp_dir, DS)[:-1] == first  # the old rows were not written again
    assert _rows(tables.load_silver(spark, tmp_dir, [DS])[DS].select(*rows.columns)) == _rows(rows)
