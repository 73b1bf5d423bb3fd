"""Embedding near-duplicates by measured projection passes.

Each pass hashes a vector to a string of random hyperplane signs, orders the
vectors by it (equal strings in a fresh order per pass), cuts the order into
sorted partitions and compares every vector with the ``BLOCK`` ones or more on
either side of it in its partition.  Pairs are verified by their cosine in
double precision, the links of all passes are united, and their connected
components are taken.

* Copies: equal vectors are one class from the start, so a group of copies of
  any size is one vector in the passes.
* Shift: the hyperplanes of a round go through the mean of the vectors that
  are in it, so a common direction, usual in text embeddings, does not give
  them all the same signs; a crowd that is left after a round is split about
  its own middle in the next.
* Passes: every pass measures, for each vector, how many signs tell the rows
  it met from the rest, and with which probability a partner at the threshold
  shares them, given the vector's own distances from the hyperplanes.  A
  vector leaves when the chance that all its passes missed such a partner is
  ``MISS`` at most; at a partition's edge or in a crowded place less is gained
  and more passes run.  They run at every size; a table of up to ``BLOCK``
  vectors is done in one.
* Crowds: vectors that the passes planned for the table's size did not finish
  go on, or, once that takes fewer rows than the passes they still need, are
  compared with each other in squares of ``SQUARE`` rows a side: n of them
  are copied n / SQUARE times, n / SQUARE <= COPIES x passes.
* No step returns all its pairs: a group's links are united inside it and only
  a spanning forest, less than one row per vector, leaves it.
* Components are completed exactly: all members of a component are compared
  with each other (many small components to a block of about ``BLOCK`` rows, a
  larger one in squares of ``SQUARE`` rows a side, so that a member is copied
  once per ``SQUARE`` members) and only counts leave a block, one row per
  member and copy, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component; vectors of
different length never link; a null id keeps its row, takes part, and has
``component_id`` null if no other id is in its component; repeated rows are
copies of each other; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

#: Production parameters: cosine, least partners on a side, chance to miss a pair, rows of a block, seed.
THRESHOLD, WINDOW, MISS, BLOCK, SEED = 0.9, 16, 0.002, 2048, 11

#: Rows a side of an exact square, passes of a round, signs of a pass (a double holds them), copies of a row per pass,
#: blocks of a sorted partition, vector lengths that get a mean of their own (the most frequent ones).
SQUARE, ROUND, BITS, COPIES, SPAN, MEANS = 4096, 4, 52, 2, 16, 64

#: Rows of the left side multiplied at a time.
_CHUNK = 512

#: Keys below and above all others.
_BEGIN, _END = -1, 1 << BITS

_KEYED = "pass int, key long, c long, n int, v binary"


def passes(n: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold has met with probability 1 - miss, in evenly spread vectors.

    The estimate decides how to begin; what the passes gained is measured.  Two vectors meet in a pass if they agree on the log2(n / window) signs
    that tell a window apart; they agree on one with probability 1 - angle/pi.
    """
    agree = 1 - math.acos(threshold) / math.pi
    meet = agree ** max(0.0, math.log2(max(n, 2) / window))
    return 1 if meet >= 1 - miss else math.ceil(math.log(miss) / math.log(1 - meet))


def _planes(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, number]).normal(size=(dim, BITS))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _means(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean unit vector of each of the ``MEANS`` most frequent vector lengths."""
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            sizes = b["v"].map(len).to_numpy()
            for dim in np.unique(sizes):
                total = _unit(np.stack(b["v"][sizes == dim].to_numpy())).sum(axis=0)
                sums[int(dim)] = sums.get(int(dim), 0.0) + total
        for dim, total in sums.items():
            yield pd.DataFrame({"n": np.int32(dim), "i": np.arange(dim, dtype=np.int32), "sum": total})

    sizes = vectors.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(MEANS).collect()
    frequent = {r.n: r["count"] for r in sizes}
    parts = vectors.filter(F.size("v").isin(list(frequent))).select("v").mapInPandas(add, "n int, i int, sum double")
    out = {n: np.zeros(n) for n in frequent}
    for r in parts.groupBy("n", "i").agg(F.sum("sum").alias("sum")).collect():  # one number per component
        out[r.n][r.i] = np.float32(r["sum"] / frequent[r.n])
    return out


def _hashed(first: int, count: int, means: dict[int, np.ndarray]):
    def run(batches):
        weight = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        for b in batches:
            sizes = b["v"].map(len).to_numpy()
            for dim in np.unique(sizes):
                part = b[sizes == dim]
                planes = np.concatenate([_planes(int(dim), first + p) for p in range(count)], axis=1)
                shift = means.get(int(dim), np.zeros(int(dim))) @ planes
                for at in range(0, len(part), 2048):
                    rows = part.iloc[at: at + 2048]
                    x = np.stack(rows["v"].to_numpy())
                    keys = (_unit(x) @ planes > shift).reshape(len(rows), count, BITS) @ weight
                    raw = [r.astype(np.float32).tobytes() for r in x]
                    for p in range(count):
                        yield pd.DataFrame({"pass": np.int32(first + p), "key": keys[:, p], "c": rows["c"].to_numpy(),
                                            "n": np.int32(dim), "v": raw})

    return run


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the edges a-b into ``labels``, each row's smallest row of its component."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _forest(x: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) that span the components of all links between the left and the right unit vectors."""
    labels, other = np.arange(len(x)), x[right].T
    for at in range(0, len(left), _CHUNK):
        mine = left[at: at + _CHUNK]
        a, b = np.nonzero(x[mine] @ other >= threshold)
        _unite(labels, mine[a], right[b])
    moved = np.flatnonzero(labels != np.arange(len(x)))
    return labels[moved], moved


#: log of the normal distribution function, by steps of 0.001 from -8 to 8.
_LOG_PHI = np.log([0.5 * math.erfc(-z / 1000 / math.sqrt(2)) for z in range(-8000, 8001)])


def _shared(x: np.ndarray, planes: np.ndarray, shift: np.ndarray, threshold: float) -> np.ndarray:
    """log probability that a partner at the threshold has a unit vector's first 0, 1, .. BITS signs."""
    at = x @ planes
    z = np.where(at > shift, 1, -1) * (threshold * at - shift) / math.sqrt(max(1e-12, 1 - threshold * threshold))
    steps = np.clip(np.rint(z * 1000), -8000, 8000).astype(np.int64) + 8000
    return np.cumsum(np.pad(_LOG_PHI[steps], ((0, 0), (1, 0))), axis=1)


class _Lane:
    """The rows of one pass and vector length in one sorted partition, read in blocks.

    ``take`` returns frames of kind 0, links (a, b) that span what was
    compared, and of kind 1, (vector, pass, chance that a partner at the
    threshold was among the rows it was compared with): the partners that
    share one sign more than the outermost row seen on either side were seen.
    """

    def __init__(self, number: int, dim: int, whole: bool, block: int, threshold: float, shift: np.ndarray):
        self.number, self.block, self.threshold, self.shift = number, block, threshold, shift
        self.planes = _planes(dim, number)
        self.before = None if whole else -1  # key of the first row seen before the block; None: the order begins here
        self.key, self.c, self.x = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, dim))

    def add(self, key: np.ndarray, c: np.ndarray, x: np.ndarray):
        self.key, self.c = np.concatenate([self.key, key]), np.concatenate([self.c, c])
        self.x = np.concatenate([self.x, x])
        while len(self.key) >= 3 * self.block:
            yield from self._compare(self.block, 2 * self.block, False)

    def end(self, whole: bool):
        if len(self.key):
            yield from self._compare(len(self.key), len(self.key), whole)

    def _compare(self, block: int, seen: int, whole: bool):
        if self.before == -1:
            self.before = self.key[0]
        x = self.x[:seen]
        a, b = _forest(x, np.arange(block), np.arange(seen), self.threshold)
        yield pd.DataFrame({"kind": 0, "a": self.c[a], "b": self.c[b], "meet": 0.0})
        told = _shared(x[:block], self.planes, self.shift, self.threshold)
        meet = np.ones(block)
        for key in [self.before] * (self.before is not None) + [self.key[seen - 1]] * (not whole):
            same = BITS - np.frexp((self.key[:block] ^ key).astype(np.float64))[1]
            side = np.where(same < BITS, np.exp(told[np.arange(block), np.minimum(same + 1, BITS)]), 0.0)
            meet = np.minimum(meet, side)
        yield pd.DataFrame({"kind": 1, "a": self.c[:block], "b": np.int64(self.number), "meet": meet})
        self.before = self.key[0]
        self.key, self.c, self.x = self.key[block:], self.c[block:], self.x[block:]


def _met(block: int, threshold: float, means: dict[int, np.ndarray]):
    """The rows of all lanes of a sorted partition; rows of the keys ``_BEGIN`` and ``_END`` tell where an order
    begins and ends, what lies beyond a partition's edge was not seen."""
    def run(batches):
        lane, at = None, None
        for rows in batches:
            number, dim, key = (rows[c].to_numpy() for c in ("pass", "n", "key"))
            both = number.astype(np.int64) << 32 | dim
            cut = np.flatnonzero(np.diff(both, prepend=both[0] - 1))
            for i, j in zip(cut, [*cut[1:], len(rows)]):
                if both[i] != at:
                    if lane is not None:
                        yield from lane.end(False)
                    d, at = int(dim[i]), both[i]
                    shift = means.get(d, np.zeros(d)) @ _planes(d, int(number[i]))
                    lane = _Lane(int(number[i]), d, key[i] == _BEGIN, block, threshold, shift)
                done = key[j - 1] == _END
                i, j = i + (key[i] == _BEGIN), j - done
                if i < j:
                    x = np.frombuffer(b"".join(rows["v"].iloc[i:j]), np.float32).reshape(j - i, -1)
                    yield from lane.add(key[i:j], rows["c"].to_numpy()[i:j], _unit(x))
                if done:
                    yield from lane.end(True)
        if lane is not None:
            yield from lane.end(False)

    return run


def _every(threshold: float):
    """Links that span the components of one square of rows."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, side, c = _unit(np.stack(rows["v"].to_numpy())), rows["side"].to_numpy(), rows["c"].to_numpy()
        a, b = _forest(x, np.flatnonzero(side != 1), np.flatnonzero(side != 0), threshold)
        return pd.DataFrame({"a": c[a], "b": c[b]})

    return run


def _all_links(rows: DataFrame, n: int, threshold: float, square: int) -> DataFrame:
    """(a, b): links that span the components of all n rows, each compared with each."""
    squares = max(1, -(-n // square))
    rows = rows.select("c", "v", F.size("v").alias("n"), F.pmod(F.xxhash64("c"), F.lit(squares)).alias("at"),
                       F.explode(F.sequence(F.lit(0), F.lit(squares - 1))).alias("other"))
    side = F.when(F.col("at") == F.col("other"), 2).when(F.col("at") < F.col("other"), 0).otherwise(1)
    return rows.select("n", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
                       side.alias("side"), "c", "v").groupBy("n", "i", "j").applyInPandas(
        _every(threshold), "a long, b long")


def _pass_links(rows: DataFrame, n: int, first: int, count: int, block: int, threshold: float) -> DataFrame:
    """The rows of ``_met`` for the passes from ``first`` on."""
    order, means = ["pass", "n", "key", "tie", "c"], _means(rows)
    keyed = rows.select("c", "v").mapInPandas(_hashed(first, count, means), _KEYED)
    lanes = rows.select(F.size("v").alias("n")).distinct()
    lanes = lanes.select("n", F.explode(F.sequence(F.lit(first), F.lit(first + count - 1))).alias("pass"))
    edges = lanes.select("pass", F.explode(F.array(F.lit(_BEGIN), F.lit(_END)).cast("array<long>")).alias("key"),
                         F.lit(-1).cast("long").alias("c"), "n", F.lit(bytearray()).alias("v"))
    keyed = keyed.union(edges).withColumn("tie", F.xxhash64("c", "pass"))
    # one shuffle: a partition holds SPAN blocks of the order, or several short lanes
    parts = max(1, -(-n * count // (SPAN * block)))
    keyed = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("tie")
    return keyed.mapInPandas(_met(block, threshold, means), "kind int, a long, b long, meet double")


def _pairs(vectors: DataFrame, n: int, threshold: float, window: int, miss: float, block: int,
           square: int) -> DataFrame:
    """(a, b): links that span the components of all vectors."""
    block, goal = max(window, block), -math.log(miss)
    planned, first, out = passes(n, threshold, block, miss), 0, []
    need = planned
    left = vectors.select("c", "v", F.lit(0.0).alias("got"))
    while n and (first < planned or n > square * COPIES * need):
        count = min(ROUND, math.ceil(need))
        met = common.written(_pass_links(left, n, first, count, block, threshold), "met")
        out.append(met.filter("kind = 0").select("a", "b"))
        gain = met.filter("kind = 1").groupBy("a").agg(
            F.sum(-F.log1p(-F.least("meet", F.lit(1 - 1e-9)))).alias("gain"))
        left = left.select("c", "v", "got").join(gain, F.col("c") == F.col("a")).select(
            "c", "v", (F.col("got") + F.col("gain")).alias("got"), "gain").filter(F.col("got") < goal)
        left = common.written(left, "left")
        n, lacks, gained = left.agg(F.count(F.lit(1)), F.sum(F.lit(goal) - F.col("got")), F.sum("gain")).first()
        need, first = (max(1.0, lacks * count / gained) if gained else math.inf) if n else 1.0, first + count
    if n:
        out.append(_all_links(left, n, threshold, square))
    found = vectors.select(F.col("c").alias("a"), F.col("c").alias("b")).limit(0)
    for more in out:
        found = found.union(more)
    return common.written(found.distinct(), "pairs")


def _block_counts(threshold: float):
    """For the rows of one block pair: how many vectors each row links with in the other side."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in rows.groupby(rows["v"].map(len)):
            x = np.stack(part["v"].to_numpy()).astype(np.float64)
            x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
            side, comp = part["side"].to_numpy(), part["comp"].to_numpy()
            c, copies = part["c"].to_numpy(), part["copies"].to_numpy().astype(np.float64)
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # side 2: a block with itself
            other, back = x[right].T, np.zeros(len(right))
            for at in range(0, len(left), _CHUNK):  # bounds the temporaries
                mine = left[at: at + _CHUNK]
                near = (x[mine] @ other >= threshold) & (comp[mine][:, None] == comp[right][None, :])
                near &= c[mine][:, None] != c[right][None, :]
                out.append(pd.DataFrame({"c": c[mine], "links": (near @ copies[right]).astype(np.int64)}))
                back += copies[mine] @ near
            if (side != 2).any():
                out.append(pd.DataFrame({"c": c[right], "links": back.astype(np.int64)}))
        return pd.concat(out, ignore_index=True)

    return run


def _dealt(vectors: DataFrame, comps: DataFrame, block: int, square: int) -> DataFrame:
    """The members of components, copied to the blocks (large, bin, i, j) in which they are compared."""
    members = vectors.join(comps, F.col("c") == F.col("node")).select("c", "copies", "v", F.col("component").alias("comp"))
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    total = comps.count()
    bins = max(1, -(-total // block))
    members = members.join(sizes, F.col("comp") == F.col("component")).drop("component")
    # a large component has a bin of its own, small ones share bins by hash
    large = F.col("m") > block
    group = F.when(large, F.col("comp")).otherwise(F.pmod(F.xxhash64("comp"), F.lit(bins)))
    members = members.withColumn("large", large).withColumn("bin", group)
    members = members.withColumn("blocks", F.when(large, F.ceil(F.col("m") / square)).otherwise(1).cast("int"))
    members = members.withColumn("at", F.pmod(F.xxhash64("c"), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return members.select(
        "large", "bin", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
        F.when(F.col("at") == F.col("other"), 2).when(F.col("at") < F.col("other"), 0).otherwise(1).alias("side"),
        "comp", "c", "copies", "v")


def _links(vectors: DataFrame, comps: DataFrame, threshold: float, block: int, square: int) -> DataFrame:
    """(c, links): exact number of vectors linked with each member of a component."""
    return _dealt(vectors, comps, block, square).groupBy("large", "bin", "i", "j").applyInPandas(
        _block_counts(threshold), "c long, links long").groupBy("c").agg(F.sum("links").alias("links"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    window: int = WINDOW, miss: float = MISS, block: int = BLOCK,
                    square: int = SQUARE) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = common.written(df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.when(good, v.cast("array<float>")).alias("v")), "vectors")
    classes = common.written(rows.filter("v is not null").groupBy("v").agg(
        F.min("row").alias("c"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")), "classes")
    pairs = _pairs(classes, classes.count(), threshold, window, miss, block, square)
    comps = common.written(components(pairs), "components")
    links = _links(classes, comps, threshold, block, square)
    told = classes.join(comps, F.col("c") == F.col("node"), "left").select(
        "c", "v", "least", "copies", F.coalesce("component", "c").alias("comp"))
    first = told.groupBy("comp").agg(F.min("least").alias("component_id"))
    told = told.join(first, "comp").join(links, "c", "left").select(
        "v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    told = common.written(told.withColumn("h", F.xxhash64("v")), "told")
    out = rows.withColumn("h", F.xxhash64("v")).alias("r").join(
        told.alias("t"), (F.col("r.h") == F.col("t.h")) & (F.col("r.v") == F.col("t.v")), "left")
    component = F.when(F.col("r.v").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
