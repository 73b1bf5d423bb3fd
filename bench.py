"""Benchmark.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line.

Timed units (best of ``$BENCH_REPEAT`` after a full warm-up pass):

* ``silver_job``  -- all six silver datasets from bronze text files and
  snapshot files (landed once from the test tables, untimed), written as
  Parquet; the reference's silver step.
* ``gold_job``    -- the three gold tables from the written silver tables.
* ``views``       -- the dashboard views over the stored gold tables.
* per-query timings of the headline catalogue queries (geo_summary,
  donor_type_summary, network_edges, silver_dedup), executed in full through
  the ``noop`` sink; ``geo_summary`` sums the facts before the joins,
  ``geo_summary_direct`` joins first; ``*_shuffled``: the same queries with
  no register broadcastable (the plan shape of a run whose registers exceed
  the broadcast limit).

``value`` = silver_job + gold_job + views (the end-to-end workload).

With ``BENCH_EVENT_LOG=1`` Spark's event log is written to a scratch folder
and the slowest stages are summarised on stderr (stdout keeps one line).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["geo_summary", "donor_type_summary", "network_edges", "silver_dedup"]
VIEWS = ["view_top_edges", "view_network_metrics", "view_flow_share", "view_top_sources",
         "view_state_map", "view_top_states", "view_donor_mix", "view_candidate_states"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    from flowlake.operators import gold
    from flowlake.plans import bindings as B
    from flowlake.plans import catalog, pipeline
    from flowlake.plans.scratch import new_scratch
    from flowlake.session import get_session

    conf = {"spark.sql.shuffle.partitions": str(max(8, cpus * 2)), "spark.driver.memory": "16g"}
    event_dir = None
    if os.environ.get("BENCH_EVENT_LOG"):
        event_dir = tempfile.mkdtemp(prefix="flowlake-events-")
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = get_session(f"local[{cpus}]", app="flowlake-bench", conf=conf)

    def geo_direct(spark, sf):
        s = B.silver_inputs(spark, sf)
        return gold.geo_summary(s["individual_contributions"], s["committee_master"],
                                gold.explode_cycles(s["candidate_master"]), eager=False)

    qs = dict(catalog.QUERIES)
    qs["geo_summary_direct"] = geo_direct

    def run_query(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    land = new_scratch(spark, "bench-bronze")
    B.land_bronze(spark, sf_dir, f"{land}/bronze", f"{land}/landing")
    roots = []

    def silver_job() -> float:
        root = new_scratch(spark, "bench-lake")
        roots.append(root)
        t0 = time.perf_counter()
        pipeline.run_silver(spark, f"{land}/bronze", f"{land}/landing", root)
        return time.perf_counter() - t0

    def gold_job() -> float:
        t0 = time.perf_counter()
        pipeline.run_gold(spark, roots[-1])
        return time.perf_counter() - t0

    def views_pass() -> float:
        return sum(run_query(v) for v in VIEWS)

    units = {"silver_job": silver_job, "gold_job": gold_job, "views": views_pass}
    for n in HEADLINE + ["geo_summary_direct"]:
        units[n] = (lambda n=n: run_query(n))

    def shuffled(name: str) -> float:
        keys = ("flowlake.broadcast.maxBytes", "spark.sql.autoBroadcastJoinThreshold",
                "spark.sql.adaptive.autoBroadcastJoinThreshold")
        old = {k: spark.conf.get(k, None) for k in keys}
        for k, v in zip(keys, ("1", "-1", "-1")):
            spark.conf.set(k, v)
        try:
            return run_query(name)
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    for n in ("geo_summary", "network_edges"):
        units[f"{n}_shuffled"] = (lambda n=n: shuffled(n))

    def labelled(name, fn):
        spark.sparkContext.setJobDescription(f"bench {name}")
        return fn()

    for n, fn in units.items():  # warm-up pass: JIT, readers, stored gold for the views
        labelled(n, fn)
    times = {n: round(min(labelled(n, fn) for _ in range(repeat)), 3) for n, fn in units.items()}
    total = round(times["silver_job"] + times["gold_job"] + times["views"], 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "pipeline_silver_gold_views", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()
    if event_dir:
        import subprocess

        subprocess.run([sys.executable, os.path.join(os.path.dirname(os.path.abspath(__file__)),
                                                     "scripts", "stage_times.py"), event_dir, "20"],
                       stdout=sys.stderr, check=False)


if __name__ == "__main__":
    main()
