"""What a job leaves on the disks while it runs: shuffles of one piece, no input twice, nothing once it is used."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowlake.operators import gold, silver
from flowlake.plans import catalog, joins
from flowlake.session import sized_for
from flowlake.sources import tables, versions


def _rows(df):
    return sorted(map(repr, df.collect()))


def _shuffles(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for d in dirs for f in Path(d).rglob("shuffle_*")}


@pytest.fixture()
def sliced(monkeypatch):
    monkeypatch.setattr(joins, "SLICE_BYTES", 1 << 10)
    monkeypatch.setattr(joins, "MOST_SLICES", 2)


def _inputs(spark):
    """Null keys, a committee registered twice, names that several committees, candidates and donors share."""
    com = spark.sql("SELECT * FROM VALUES ('C1', 'H0', 'ONE'), ('C2', 'H1', 'TWO'), ('C2', 'H2', 'ONE'), ('C3', NULL, NULL), "
                    "(NULL, 'H0', 'NONE'), ('C4', 'H2', 'FOUR'), ('C5', 'H1', 'TWO') AS t(com_id, cand_id, com_name)")
    cand = spark.sql("SELECT * FROM VALUES ('H0', 'A', 'H', '[2024, 2026]'), ('H1', 'A', 'H', '2024'), ('H1', 'A', 'H', '2024'), "
                     "('H2', NULL, 'S', '2024, 2025') AS t(cand_id, cand_name, cand_off, cand_el_yr)")
    key = lambda p, n, gap: F.when(F.col("id") % gap > 0, F.concat(F.lit(p), (F.col("id") % n).cast("string")))
    paid = spark.range(4000).select(key("C", 7, 11).alias("com_id"), key("H", 4, 17).alias("cand_id"),
                                    key("C", 5, 19).alias("other_com_id"), key("D", 23, 13).alias("contrib_name"),
                                    ((F.col("id") - 1500) * 9.01).alias("trans_amt"))
    return [paid, com, gold.explode_cycles(cand), paid.where("cand_id <> 'H3'"), paid, paid.where("com_id <> 'C6'")]


def test_pieces_make_up_the_network(spark, sliced):
    inputs = _inputs(spark)
    pieces = list(gold.network_pieces(*inputs))
    assert len(pieces) == 4 * joins.MOST_SLICES
    found = _rows(pieces[0].unionByName(pieces[1])) + [r for p in pieces[2:] for r in _rows(p)]
    assert found and sorted(found) == _rows(gold.network_edges(*inputs))


def test_a_large_register_is_not_sliced(spark, sliced):
    """Each slice would shuffle all payments of a register that cannot be broadcast."""
    paid, com, *_ = _inputs(spark)
    spark.conf.set("flowlake.broadcast.maxBytes", "1")
    try:
        assert [p for p, _ in gold._by_source(paid, com)] == [paid]
    finally:
        spark.conf.unset("flowlake.broadcast.maxBytes")


@pytest.mark.parametrize("name", ["sink_roundtrip", "view_top_edges"])
def test_stored_gold_of_pieces(spark, sliced, monkeypatch, name):
    """One piece's shuffles at a time; the joined payments are gone before the committees' branches are written."""
    monkeypatch.setattr(catalog, "_GOLD_ROOTS", {})
    write, left, roots = tables.write_table, [], []

    def watched(df, path, **kw):
        if path.endswith("/gold/_network_metrics"):
            roots.append(path.removesuffix("/gold/_network_metrics"))
            left.append(Path(f"{roots[0].removeprefix('file:')}/_payments").exists())
        return write(df, path, **kw)

    monkeypatch.setattr(tables, "write_table", watched)
    got = catalog.QUERIES[name](spark, SF_SMALL)
    pieces, root = joins.MOST_SLICES, roots[0].removeprefix("file:")
    assert left == [True] * pieces + [False] * 3 * pieces
    assert not Path(f"{root}/_payments").exists() and not Path(f"{root}/_shared").exists()
    assert not Path(f"{root}/gold/_network_metrics").exists()
    network = tables.load_gold(spark, roots[0])["network_metrics"]
    if name == "sink_roundtrip":
        assert _rows(got) == _rows(catalog.QUERIES["network_edges"](spark, SF_SMALL).select(got.columns))
    cycles = {r.election_cycle for r in tables.load_cycles(spark, roots[0], "network_metrics").collect()}
    assert cycles == {r.election_cycle for r in network.select("election_cycle").distinct().collect()}
    assert got.count() > 0


def test_shuffle_files_end_with_their_job(spark, tmp_path):
    rows = spark.range(50_000).withColumn("k", F.col("id") % 7919).groupBy("k").agg(F.sum("id").alias("n"))
    before, end = _shuffles(spark), time.time() + 20
    with sized_for(spark, 0):
        rows.write.parquet(f"{tmp_path}/t")
    while _shuffles(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not _shuffles(spark) - before
    assert spark.read.parquet(f"{tmp_path}/t").count() == 7919
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_no_table_of_some_pieces(spark, tmp_path):
    """A run that fails between two pieces leaves no table, a later one the whole."""
    row = spark.createDataFrame([("a", "2024")], "source_node string, election_cycle string")

    def broken():
        yield row
        raise RuntimeError("lost")

    for partitioned in (True, False):
        with pytest.raises(RuntimeError, match="lost"):
            tables.write_gold({"network_metrics": row}, str(tmp_path), partitioned, pieces={"network_metrics": broken()})
        assert not Path(f"{tmp_path}/gold/network_metrics").exists()
        tables.write_gold({"network_metrics": row}, str(tmp_path), partitioned, pieces={"network_metrics": [row, row]})
        assert spark.read.parquet(f"{tmp_path}/gold/network_metrics").count() == 2


def test_maintained_network_in_pieces(spark, sliced, monkeypatch):
    """Joined payments go once silver holds them, the network is written in pieces from the partial sums."""
    roots, write, pieces = [], tables.write_gold, []
    monkeypatch.setattr(tables, "write_gold", lambda t, root, *a, **kw: (
        roots.append(root.removeprefix("file:")), pieces.extend(kw["pieces"]["network_metrics"]),
        write(t, root, *a, pieces={"network_metrics": pieces}))[-1])
    got = catalog.QUERIES["maintained_network"](spark, SF_SMALL)
    full = catalog.QUERIES["network_edges"](spark, SF_SMALL)
    assert got.columns == full.columns and _rows(got) == _rows(full)
    assert len(pieces) == 4 * joins.MOST_SLICES and any("partials/parts" in f for f in pieces[0].inputFiles())
    assert not list(Path(roots[0]).glob("dealt/_increment=*"))
    sums = list(Path(roots[0]).glob("partials/parts/*/*/*.parquet"))
    assert sums and all(".zstd." in f.name for f in sums)


def _repeated(spark):
    """Equal rows, nulls, two zeros."""
    return spark.range(900).select(F.when(F.col("id") % 7 > 0, (F.col("id") % 40).cast("string")).alias("name"),
                                   F.when(F.col("id") % 3 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("amt"))


@pytest.mark.parametrize("buckets", [None, 6])
def test_distinct_in_pieces(spark, sliced, tmp_path, buckets):
    path = f"{tmp_path}/in"
    _repeated(spark).write.parquet(path)
    rows, parts = spark.read.parquet(path), []
    for i, piece in enumerate(silver.distinct_pieces(rows, f"{tmp_path}/aside", buckets)):
        parts.append(_rows(piece))
        left = {p.name for p in Path(f"{tmp_path}/aside").glob("_piece=*")}
        assert left == {f"_piece={k}" for k in range(i, joins.MOST_SLICES)}
    assert len(parts) == joins.MOST_SLICES and all(parts)
    assert sorted(r for p in parts for r in p) == _rows(silver.dedup(rows)) and sum(map(len, parts)) == 41
    assert not Path(f"{tmp_path}/aside").exists()
    none = list(silver.distinct_pieces(rows.where("name = 'nobody'"), f"{tmp_path}/none", buckets))
    assert [p.count() for p in none] == [0] and none[0].schema == rows.schema


def test_a_bucket_of_pieces_is_one_file(spark, sliced, tmp_path):
    """Pieces hold different buckets, so an increment still meets every bucket where it lies."""
    from flowlake.plans import incremental

    root, path = str(tmp_path), f"{tmp_path}/in"
    _repeated(spark).write.parquet(path)
    rows = spark.read.parquet(path)
    for _ in range(2):  # the second write replaces the first
        tables.write_silver(rows, root, "d", buckets=6, pieces=silver.distinct_pieces(rows, f"{root}/aside", 6))
    state = versions.load(spark, tables.silver_layer(root), "d")
    assert (state.rows, len(state.parts)) == (41, 1)
    names = [f.name for f in Path(versions.paths(tables.silver_layer(root), state)[0]).glob("part-*.parquet")]
    assert len({n.rsplit("_", 1)[1][:5] for n in names}) == len(names) <= 6
    new = spark.createDataFrame([("new", 1.0), (None, 0.0), ("1", 0.0)], rows.schema)
    assert incremental.merge(new, root, "d").new_rows == 1
    assert tables.load_silver(spark, root, ["d"])["d"].count() == 42


@pytest.mark.parametrize("name", ["silver_dataset", "silver_increments"])
def test_silver_queries_in_pieces(spark, monkeypatch, name):
    """Landed text is compressed; whole and sliced runs give the same rows."""
    roots = []
    scratch = catalog.new_scratch
    monkeypatch.setattr(catalog, "new_scratch", lambda *a: (roots.append(scratch(*a)), roots[-1])[1])
    whole = _rows(catalog.QUERIES[name](spark, SF_SMALL))
    monkeypatch.setattr(joins, "SLICE_BYTES", 1 << 10)
    monkeypatch.setattr(joins, "MOST_SLICES", 3)
    pieces, dedup = [], silver.dedup
    monkeypatch.setattr(silver, "dedup", lambda df: (pieces.append(df), dedup(df))[1])
    assert _rows(catalog.QUERIES[name](spark, SF_SMALL)) == whole and whole
    assert len([p for p in pieces if any("/_aside/_piece=" in f for f in p.inputFiles())]) >= 1 and len(pieces) >= 3
    root = Path(roots[-1].removeprefix("file:"))
    assert not (root / "_aside").exists()
    texts = [f for f in root.glob("bronze/itcont.txt/part-*")]
    assert all(f.name.endswith(".gz") for f in texts) and bool(texts) == (name == "silver_dataset")
