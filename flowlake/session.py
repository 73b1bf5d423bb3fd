"""Session construction with the settings the engine is tuned for."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimensions are broadcast explicitly after a size check
    # (plans.joins.sized_broadcast); keep the planner from broadcasting a
    # fact-sized side on its own estimate.
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


PARTITION_BYTES = 256 << 20

#: Shuffle files are deleted when the query that wrote them ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scale_conf(input_bytes: int, partition_bytes: int = PARTITION_BYTES, least: int = 200) -> dict:
    """Shuffle sizing for a job over ``input_bytes`` of input: one partition
    per ``partition_bytes`` of it, ``least`` at least. Adaptive execution
    then coalesces small partitions and splits skewed ones, so each task's
    working set stays well inside executor memory. A task that writes a few
    labels keeps a file open for each instead of sorting its rows. Of several
    queries only the running ones have shuffle files on disk."""
    return {"spark.sql.shuffle.partitions": str(int(max(least, -(-input_bytes // partition_bytes)))),
            "spark.sql.maxConcurrentOutputFileWriters": "4", CLEANUP: "true"}


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int):
    """Run a job with shuffles sized for its input; the session's own number
    of partitions is the least, and is set back afterwards."""
    old = {k: spark.conf.get(k, None) for k in scale_conf(0)}
    old["spark.sql.shuffle.partitions"] = spark.conf.get("spark.sql.shuffle.partitions")
    least = int(old["spark.sql.shuffle.partitions"])
    for k, v in scale_conf(input_bytes, least=least).items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def get_session(master: str | None = None, app: str = "flowlake", conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
