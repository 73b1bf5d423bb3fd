"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints: 64-bit SimHash of the XXH64 hashes of word shingles (numpy over
one text at a time).  Linking within ``radius`` bits: every *distinct*
fingerprint emits its variants within half the radius (65 of them for radius
2).  Two fingerprints are at most ``radius`` bits apart if and only if some
variant within the lower half of one is a variant within the upper half of
the other, so a shuffle on the variant brings all such pairs together.  A
bucket holds at most as many fingerprints as a ball has points (65), whatever
the data.  By the triangle inequality all members are near the bucket's
smallest core member, so one link from it to each other member is enough and
no pairs within a bucket are listed.  Links are deduplicated and their bit
distance is verified before the components are taken.

Exact copies and texts of equal fingerprint are one class from the start: the
search runs over distinct fingerprints only, and documents join their
fingerprint's class at the end, where the rows of a heavy fingerprint are dealt
over several tasks.

Defined results: a null, empty or all-blank text has fingerprint 0 and is
linked like any other.  Null ids take part; ``component_id`` is the smallest
non-null id of the component (null if it has none).  Repeated rows stay.
Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.plans.heavy import salted_join

from . import common
from .components import components

#: Contract of the dealt operator: words per shingle, bits of difference.
SHINGLE, RADIUS = 3, 2
_BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text."""
    import numpy as np
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        spans = [flat]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = [flat[i:j] for i, j in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, 42) for s in spans], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), _BLOCK):
        bits = np.unpackbits(h[k: k + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    def batches(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return F.pandas_udf(batches, "long")(text)


def _masks(bits: int) -> list[int]:
    """Signed 64-bit masks with at most ``bits`` ones, by number of ones."""
    out = []
    for n in range(bits + 1):
        for c in combinations(range(64), n):
            m = sum(1 << i for i in c)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect all distinct ``fp`` at most ``radius`` bits apart."""
    low, high = radius // 2, radius - radius // 2
    masks = _masks(high)
    # few bytes here, 65 times as many below: dealt over all tasks, by another expression than the one that
    # the distinct rows are dealt by, as the planner would take an equal one for done
    distinct = fingerprints.select("fp").distinct().repartition(
        common.shuffle_width(fingerprints), F.xxhash64("fp"))
    ball = distinct.select(
        "fp", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("m"))
    core = F.bit_count("m") <= low
    ball = ball.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("variant"), core.alias("core"))
    buckets = ball.groupBy("variant").agg(
        F.min(F.when(F.col("core"), F.col("fp"))).alias("a"),
        F.collect_list("fp").alias("members"),
    ).filter(F.col("a").isNotNull() & (F.size("members") > 1))
    pairs = buckets.select("a", F.explode("members").alias("b")).filter("a <> b").distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


#: Bytes of rows of one fingerprint that a task joins with their class.
_CLASS_BYTES = 32 << 20


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """One row per document: id, ``fingerprint`` (hex), ``component_id``, ``kept`` (smallest id of its group).

    Ids are gathered by fingerprint first, so what meets by class are distinct
    fingerprints; the rows join their fingerprint's result once, those of a
    heavy one over several tasks.
    """
    rows = common.written(
        df.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text), shingle).alias("fp"),
                  F.monotonically_increasing_id().alias("n")), "fingerprints")
    joined = components(links(rows, radius)).withColumnRenamed("node", "fp")
    each = rows.groupBy("fp").agg(F.min("id").alias("least")).join(joined, "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("class_fp"))
    each = common.written(each, "classes")
    rep = each.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    found = common.written(each.join(rep, "class_fp").select("fp", "component_id"), "class_ids")
    return salted_join(rows, found, "fp", F.col("n"), _CLASS_BYTES).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` with one row of each near-duplicate group left.

    The row with the smallest id stays (null ids last); rows that share it are
    told apart by a hash of all their columns, and of identical rows one stays.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    h = F.xxhash64(*(F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
                     for f in df.schema))  # maps have no hash of their own
    rows = df.select(F.col(id_col).alias("id"), h.alias("h"),
                     fingerprint_column(F.col(text), shingle).alias("fp"))
    marks = common.written(rows, "fingerprints")
    joined = components(links(marks, radius)).withColumnRenamed("node", "fp")
    marks = marks.join(joined, "fp", "left").select(
        F.coalesce("component", "fp").alias("c"), F.struct(F.col("id").isNull().alias("n"), "id", "h").alias("k"))
    best = marks.groupBy("c").agg(F.min("k").alias("k")).select("k.id", "k.h").distinct()
    chosen = df.select(F.col(id_col).alias("id"), h.alias("h"), F.struct(*cols).alias("row"))
    chosen = chosen.join(best.withColumnsRenamed({"id": "id2", "h": "h2"}),
                         F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")), "left_semi")
    return chosen.dropDuplicates(["id", "h"]).select("row.*")
