"""Importance resampling of documents towards a target text collection.

A text's features are its words and pairs of neighbouring words, hashed into
``BUCKETS`` buckets.  Counting the buckets of the corpus and of the target
gives one gain per bucket, the log ratio of its two smoothed shares; the gains
are an array of ``BUCKETS`` numbers, whatever the corpus, and every text is
scored by indexing it.  Adding Gumbel noise, drawn from a hash of the row's
id, to the weights and taking the highest scores draws without replacement.

The highest scores are found by weighted median-of-medians selection.  A pass
over the keys gives each partition's median of its remaining keys; the median
of these, weighted by the sizes that remain, has a quarter of all remaining
keys on either side at least, and the next pass counts the sides.  The side
without the cutoff goes, and the pass has already taken the other side's
medians.  The driver sees one row per partition (``PARTITIONS`` at most), and
what remains is written anew once it is an eighth of what a pass reads.  Only
the winners are sorted.

Texts are read as bytes in pieces of ``PIECE``, so a long one needs no more
memory than its own bytes.  Defined results: a null or empty text has no
words, no features and weight 0; without any feature in corpus and target all
gains are 0.  A null id counts as the empty string in the hash and comes last
among equal scores; ids other than integers are ordered by their hash.  Rows
that repeat an id are separate rows; equal ones get neighbouring ranks, and of
those at the cutoff as many as are due are drawn, in the order of the row's
features and weight.  Empty tables give empty results.  Extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from itertools import chain, repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, written

BUCKETS = 10_000

#: Texts of fewer words are not drawn; this share of the others is.
MIN_WORDS, DRAWN_PERCENT = 20, 25
SEED = 7

#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20

#: Keys a selection task should hold, and the most tasks of a pass.
KEYS, PARTITIONS = 1 << 20, 4096

#: Bytes of a text to word characters (A-Z lower-cased) and blanks.
_READ = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def features(text: bytes | None):
    """(words, bucket numbers of all features) of each piece of a text."""
    data, start, last = (text or b"").translate(_READ), 0, []
    while start < len(data):
        end = data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        words, start = data[start:end].split(), end
        one = list(map(crc32, words))
        # the checksum of "a b" continues that of a; the piece before ends in a word of its own
        before = last + one
        pairs = map(crc32, words[1 - len(last):], map(crc32, repeat(b" "), before))
        n = max(0, len(before) - 1)
        last = before[-1:]
        yield len(words), np.fromiter(chain(one, pairs), np.int64, len(words) + n) % BUCKETS


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features per bucket over all rows: ``BUCKETS`` numbers, summed in Spark."""
    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in _texts(batch, 0):
                for _, at in features(t):
                    total += np.bincount(at, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    part = texts.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for r in part.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: thousandths of the log ratio of its target share to its corpus share."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def gumbel(id_col: str, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw, fixed by the row's id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(named, "utf-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def score(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col``, n_words, n_features, weight and score of every row."""
    kind = docs.schema[id_col].dataType

    def weigh(batches):
        for batch in batches:
            out = []
            for t in _texts(batch, 1):
                words = n = total = 0
                for w, at in features(t):
                    words, n, total = words + w, n + len(at), total + int(gain[at].sum())
                out.append((words, n, total // n if n else 0))
            counts = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts.T.copy())],
                                             [id_col, "n_words", "n_features", "weight"])

    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.LongType())
                                                          for c in ("n_words", "n_features", "weight"))])
    weighed = docs.select(id_col, F.col(text).cast("string")).mapInArrow(weigh, schema)
    return weighed.select("*", (F.col("weight") + gumbel(id_col)).cast("long").alias("score"))


def _tie(df: DataFrame, id_col: str) -> Column:
    """The order of equal scores as a long: the id, null last."""
    whole = isinstance(df.schema[id_col].dataType, T.IntegralType)
    c = F.col(id_col).cast("long") if whole else F.xxhash64(F.col(id_col).cast("string"))
    return F.when(F.col(id_col).isNull(), F.lit((1 << 63) - 1)).otherwise(c)


_SIDES = "n_less long, n_equal long, n_more long, less_a long, less_b long, more_a long, more_b long"


def _median(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    if not len(a):
        return 0, 0
    at = np.lexsort((b, a))[(len(a) - 1) // 2]
    return int(a[at]), int(b[at])


def _sides(pivot: tuple[int, int] | None):
    """For ``mapInArrow``: sizes and medians of a partition's keys below and above the pivot."""
    def look(batches):
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not parts:
            return
        a, b = (np.concatenate(c) for c in zip(*parts))
        if pivot is None:
            less = equal = np.zeros(len(a), bool)
        else:
            less = (a < pivot[0]) | (a == pivot[0]) & (b < pivot[1])
            equal = (a == pivot[0]) & (b == pivot[1])
        more = ~less & ~equal
        row = [less.sum(), equal.sum(), more.sum(), *_median(a[less], b[less]), *_median(a[more], b[more])]
        names = [c.split()[0] for c in _SIDES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in row], names)

    return look


def weighted_median(medians: list[tuple[tuple[int, int], int]]) -> tuple[int, int]:
    """The median of (key, weight) pairs: half the weight is at or below it, half at or above."""
    total, seen = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int) -> tuple[int, int]:
    """The ``k``-th smallest of the keys, pairs of longs ``a`` and ``b``; 1 <= k <= rows."""
    width = keys.sparkSession.sparkContext.defaultParallelism
    low = high = pivot = None
    kept, size = None, None
    try:
        while True:
            left = kept if kept is not None else keys
            for bound, sign in ((low, ">"), (high, "<")):
                if bound is not None:
                    left = left.filter(f"a {sign} {bound[0]} or (a = {bound[0]} and b {sign} {bound[1]})")
            sides = left.mapInArrow(_sides(pivot), _SIDES).collect()  # one row per partition
            less, equal, more = (sum(r[i] for r in sides) for i in range(3))
            if pivot is not None and less < k <= less + equal:
                return pivot
            if pivot is not None and k <= less:
                high, remain = pivot, less
                medians = [((r.less_a, r.less_b), r.n_less) for r in sides if r.n_less]
            else:
                low, k, remain = pivot, k - less - equal, more
                medians = [((r.more_a, r.more_b), r.n_more) for r in sides if r.n_more]
            pivot = weighted_median(medians)
            size = size or remain
            if remain * 8 <= size:  # the interval was narrowed since the last copy
                for bound, sign in ((low, ">"), (high, "<")):
                    if bound is not None:
                        left = left.filter(f"a {sign} {bound[0]} or (a = {bound[0]} and b {sign} {bound[1]})")
                tasks = min(PARTITIONS, max(width, math.ceil(remain / KEYS)))
                old, kept, size = kept, written(left.coalesce(tasks), "keys"), remain
                if old is not None:
                    discard(old)
    finally:
        if kept is not None:
            discard(kept)


def draw(scored: DataFrame, id_col: str = "doc_id", min_words: int = MIN_WORDS,
         percent: int = DRAWN_PERCENT) -> DataFrame:
    """``scored`` and the rank of each drawn row; ``scored`` is read several times, so write it first."""
    spark = scored.sparkSession
    rows = scored.select(F.struct(*(F.col(f"`{c}`") for c in scored.columns)).alias("row"),
                         (-F.col("score")).alias("a"), _tie(scored, id_col).alias("b"),
                         F.coalesce(F.col("n_words") >= min_words, F.lit(False)).alias("long"))
    keys = rows.filter("long").select("a", "b")
    k = percent * keys.count() // 100
    none = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return rows.select("row.*", none)
    tasks = min(PARTITIONS, max(spark.sparkContext.defaultParallelism, math.ceil(k * 100 / percent / KEYS)))
    a, b = cutoff(keys.coalesce(tasks), k)
    won = F.expr(f"long and (a < {a} or (a = {a} and b <= {b}))")

    # a row's position in the sorted partition that it falls in, then the sizes of the partitions before
    first = rows.filter(won).orderBy("a", "b", "row.n_features", "row.weight", F.monotonically_increasing_id())
    first = written(first.select("row", F.monotonically_increasing_id().alias("at")), "winners")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    starts, seen = [], 0
    for r in sorted(first.groupBy(part.alias("p")).count().collect()):  # one row per sorted partition
        starts.append((r.p, seen))
        seen += r["count"]
    starts = F.broadcast(spark.createDataFrame(starts, "p long, start long"))
    ranked = first.join(starts, part == F.col("p")).select("row", (F.col("start") + place + 1).alias("rank"))
    ranked = ranked.select("row.*", F.when(F.col("rank") <= k, F.col("rank")).alias("rank"))
    return ranked.union(rows.filter(~won).select("row.*", none))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, n_words, n_features, weight, score and, if drawn, its rank."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    return draw(written(score(docs, gain, id_col, text), "scored"), id_col)
