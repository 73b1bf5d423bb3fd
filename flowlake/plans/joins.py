"""Size-checked broadcast.

A dimension is broadcast only when the optimizer's size estimate for it,
allowing for decompression, is within a byte limit, and its plan explodes no
lists (the estimate ignores the fan-out). Otherwise the side is left to the
planner (shuffled sort-merge join); with adaptive execution on, Spark can
still turn that join into a broadcast at run time once the real shuffle size
is known.
Nothing whose size grows with the facts is broadcast without this check.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 64 * 1024 * 1024

#: Rows in memory against the bytes of compressed Parquet that the estimate
#: starts from.
DECOMPRESSION = 4
LIMIT_CONF = "flowlake.broadcast.maxBytes"

#: Bytes of the tables, as ``input_bytes`` counts them, that one task of a join by shuffle holds.
TASK_BYTES = 16 << 20

#: Partitions that ``dealt`` asks for at most: beyond 512 GB the tasks grow, not the number of shuffle blocks.
MOST_TASKS = 1 << 15

#: Bytes of the tables, as ``input_bytes`` counts them, that one slice of a job holds in its shuffles, and
#: the most slices: each one reads the tables again.
SLICE_BYTES, MOST_SLICES = 512 << 20, 8
UNKNOWN_BYTES = 1 << 62  # what the optimizer says of a frame whose size it cannot know

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS.get(m.group(2).lower() or "b", 1)


def broadcast_limit(df: DataFrame) -> int:
    try:
        v = df.sparkSession.conf.get(LIMIT_CONF, None)
        return parse_bytes(v) if v else DEFAULT_LIMIT
    except Exception:
        return DEFAULT_LIMIT


def _plan_bytes(plan) -> int:
    size = plan.stats().sizeInBytes()
    return size if isinstance(size, int) else int(str(size.toString()))


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of ``df`` (None when unavailable)."""
    try:
        return _plan_bytes(df._jdf.queryExecution().optimizedPlan())
    except Exception:
        return None


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables that ``df`` reads, allowing for decompression (None when unavailable).

    Unlike the estimate of a joined frame, which multiplies the sizes of its
    sides, this follows the data; a plan that multiplies rows can be larger."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return DECOMPRESSION * sum(_plan_bytes(leaves.apply(i)) for i in range(leaves.size()))
    except Exception:
        return None


def slices_for(*frames: DataFrame) -> int:
    """Slices for a job over ``frames`` whose shuffles would fill the disks: one per ``SLICE_BYTES`` of their tables."""
    sizes = [input_bytes(f) for f in frames]
    if None in sizes or sum(sizes) >= UNKNOWN_BYTES:
        return 1
    return max(1, min(MOST_SLICES, -(-sum(sizes) // SLICE_BYTES)))


def in_slice(column: str, i: int, slices: int) -> Column:
    """Rows whose ``column`` falls into a slice; equal values, nulls too, share one."""
    return F.pmod(F.xxhash64(column), F.lit(slices)) == i


def dealt(left: DataFrame, right: DataFrame, left_keys: list, right_keys: list) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join by shuffle in as many partitions as their tables' bytes ask for, so that a
    task's sort and sums stay the same size however large the tables are; the session's number is the
    least. Sides that make no more tasks than there are cores are left to adaptive execution, which also
    splits skewed partitions; of a dealt join, a heavy key's rows stay in one task, which spills."""
    session = left.sparkSession
    sizes = [input_bytes(side) for side in (left, right)]
    if None in sizes or sum(sizes) >= UNKNOWN_BYTES:
        return left, right
    n = min(-(-sum(sizes) // TASK_BYTES), MOST_TASKS)
    if n <= session.sparkContext.defaultParallelism:
        return left, right
    n = max(n, int(session.conf.get("spark.sql.shuffle.partitions")))
    return left.repartition(n, *left_keys), right.repartition(n, *right_keys)


def multiplies_rows(df: DataFrame) -> bool:
    """Whether the plan explodes lists: the estimate does not know by how
    much, so it proves no bound."""
    try:
        return re.search(r"\bGenerate\b", df._jdf.queryExecution().optimizedPlan().toString()) is not None
    except Exception:
        return True


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    if multiplies_rows(df):
        return False
    size = estimated_bytes(df)
    return size is not None and size * DECOMPRESSION <= (limit if limit is not None else broadcast_limit(df))


def sized_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``broadcast(df)`` if its estimated size is within ``limit``, else
    ``df`` unchanged (shuffle join, or a runtime broadcast decided by AQE)."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df
