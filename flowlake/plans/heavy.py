"""Heavy join keys: found by a sketch, split in proportion to their bytes.

A shuffled join puts all rows of one key into one task. ``key_tasks`` finds
the keys with more rows than a task should hold: a frequent-items sketch
(Spark's ``approx_top_k``), filled in every partition and merged, gives their
counts from one scan of the key column, and a key's share of the input's
bytes gives the number of tasks it needs. ``salted_join`` deals the facts of
such a key over that many tasks and repeats its register rows as often;
every other key keeps one task and one register row.

Sizes: at most one key per task's worth of bytes can be heavy, so the table
of heavy keys has no more rows than the input has tasks and the register
grows by no more rows than that. The sketch tracks ``TRACKED`` keys at most;
it finds every key with more than about 1 / (TRACKED / 4) of the rows. A
smaller one stays in one task; a large join is dealt by the bytes of its tables
(``joins.dealt``), a small one is left to adaptive execution, which splits
skewed partitions by their measured bytes.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import PARTITION_BYTES
from .joins import dealt, input_bytes

TRACKED = 1 << 18
SALT = "_salt"


def row_bytes(df: DataFrame) -> Column:
    """About what a row weighs in a shuffle: 8 bytes a column and the bytes of its texts."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if f.dataType.typeName() == "string"]
    return reduce(lambda a, b: a + b, texts, F.lit(8 * len(df.columns))).cast("long")


def key_tasks(facts: DataFrame, key: str, partition_bytes: int = PARTITION_BYTES,
              total_bytes: int | None = None) -> DataFrame | None:
    """``key`` and ``tasks`` (2 or more) of the heavy keys; None if no key can be heavy.

    Lazy: the sketch is part of the plan that uses it, and measures the bytes
    of the rows unless ``total_bytes`` are given. The bytes of the tables that
    the facts come from only tell when there is nothing to look for."""
    bound = total_bytes if total_bytes is not None else input_bytes(facts)
    most = TRACKED if bound is None else min(TRACKED, bound // partition_bytes)
    if most < 2:
        return None
    tracked = min(TRACKED, 1 << max(10, math.ceil(math.log2(8 * most))))
    size = F.sum(row_bytes(facts)) if total_bytes is None else F.max(F.lit(total_bytes))
    top = facts.agg(F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top"), F.count(key).alias("rows"),
                    size.alias("size"))
    each = top.select(F.explode("top").alias("t"), "rows", (F.col("size") / F.lit(float(partition_bytes))).alias("parts"))
    tasks = F.ceil(F.col("t.count") / F.col("rows") * F.col("parts"))
    return each.select(F.col("t.item").alias(key), F.least(tasks, F.lit(TRACKED)).cast("int").alias("tasks")).where(
        F.col(key).isNotNull() & (F.col("tasks") > 1))


def salted_join(facts: DataFrame, register: DataFrame, key: str, spread: Column,
                partition_bytes: int = PARTITION_BYTES, total_bytes: int | None = None) -> DataFrame:
    """Inner join on ``key`` by shuffle, heavy keys dealt over several tasks by a hash of ``spread``.

    Null keys join nothing and are dropped before the shuffle."""
    facts = facts.where(F.col(key).isNotNull())
    hot = key_tasks(facts, key, partition_bytes, total_bytes)
    if hot is None:
        return facts.join(register, key)
    hot = F.broadcast(hot)  # no more rows than the input has tasks
    salt = F.pmod(F.xxhash64(spread), F.coalesce(F.col("tasks"), F.lit(1))).cast("int")
    salted = facts.join(hot, key, "left").withColumn(SALT, salt).drop("tasks")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("tasks"), F.lit(1)) - 1)
    repeated = register.join(hot, key, "left").withColumn(SALT, F.explode(copies)).drop("tasks")
    salted, repeated = dealt(salted, repeated, [key, SALT], [key, SALT])
    return salted.join(repeated, [key, SALT]).drop(SALT)
