"""What five filters remove, alone and in every order.

The word counts that two of the filters need come from a sparse document-term
matrix.  Each task cuts its texts into shards of about ``SHARD`` bytes, one row
each, that hold the counts of their documents in compressed rows (``indptr``,
``indices``, ``counts``, as packed numbers).  Neighbouring shards form a group
with one word list of about ``GROUP_WORDS`` words, and the columns are places
in that list; a shard carries the words it adds.  The lists of all groups are
then encoded with one dictionary: words are dealt to hash buckets, and a
word's term number is its rank among the different words of its bucket, times
the number of buckets, plus the bucket.  That needs one shuffle of one row per
group and word, however often the word occurs, and gives the same numbers in
every run.  The numbers return to their group as one array, are sorted before
its shards, and replace the columns while the shards stream by.  A row's sum
is the document's number of words, its number of nonzero entries the number of
different words.

The other flags are taken from the text in the first pass; texts are compared
by their SHA-256.  A document repeats a smaller one if its id is above the
smallest id of its text.  The counts are kept per part and set of failed
filters (32 sets), so the 120 orders are sums over at most 32 numbers a part.

Copies of one text meet only in aggregates that combine before the shuffle,
never in a window or list.  Defined results: a null text is empty, it has 0
words and fails A alone (and E if an empty text has a smaller id); a null id
is no smaller and no larger than any other, so it neither fails E nor makes
others fail, and carries no labels; a null part is the empty string.  Rows
that repeat an id count each; those with the smallest id all pass E.  Several
labels of an id count as good (toxic) if any is 1.  Empty tables give empty
results; a part without failures has zeros.  Extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import islice, permutations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_width, written

#: The filters' thresholds.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 50, 65, 5
SPECIAL = b"#$%&*|"

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]

#: Bytes of text in a shard (a longer text is a shard of its own), different words after which a group
#: ends, and bytes of a text that are split at a time.
SHARD, GROUP_WORDS, PIECE = 2 << 20, 1 << 19, 1 << 20

_CAPITALS = bytes(range(65, 91))
_FOLLOWING = bytes(range(0x80, 0xC0))  # the bytes of a character after its first


class _Places(dict):
    """The place of each word in a list of different words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def _word_places(text: bytes, places: _Places) -> np.ndarray:
    out, start = [], 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        words = text[start:end].split()  # at \x20 and \x09 to \x0D
        out.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
        start = end
    return np.concatenate(out) if out else np.empty(0, np.int32)


def _pack(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.tobytes(), 1)


def _unpack(packed: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), kind)


class _Shard:
    def __init__(self, places: _Places):
        self.places, self.known, self.size = places, len(places), 0
        self.lengths, self.indices, self.counts = [], [], []
        self.flags, self.digests, self.ids, self.parts = [], [], [], []

    def add(self, text: bytes) -> None:
        self.size += len(text)
        terms, counts = np.unique(_word_places(text, self.places), return_counts=True)
        self.lengths.append(len(terms))
        self.indices.append(terms)
        self.counts.append(counts.astype(np.int32))
        capitals = len(text) - len(text.translate(None, _CAPITALS))
        points = len(text.translate(None, _FOLLOWING))
        self.flags.append((100 * capitals > MAX_CAPITAL_PERCENT * points, any(c in text for c in SPECIAL)))
        self.digests.append(hashlib.sha256(text).digest())

    def row(self, group: int, number: int) -> pa.RecordBatch:
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        packed = lambda x: pa.array([_pack(np.concatenate(x) if x else np.empty(0, np.int32))])
        capital, special = np.array(self.flags, bool).reshape(-1, 2).T.copy()
        added = pa.array(islice(self.places, self.known, None), pa.binary()).cast(pa.string())
        columns = {
            "group": pa.array([group], pa.int64()), "number": pa.array([number], pa.int32()),
            "id": one(pa.concat_arrays(self.ids)), "part": one(pa.concat_arrays(self.parts)),
            "capital": one(pa.array(capital)), "special": one(pa.array(special)),
            "digest": one(pa.array(self.digests, pa.binary())),
            "indptr": packed([np.cumsum([0, *self.lengths], dtype=np.int32)]),
            "indices": packed(self.indices), "counts": packed(self.counts),
            "known": pa.array([self.known], pa.int32()), "words": one(added),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def shards(docs: DataFrame, id_col: str = "doc_id", part: str = "source", text: str = "text",
           shard: int = SHARD, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per shard: its documents, the words it adds to its group's list, and counts by place in that list."""
    def cut(batches):
        group, number, places = TaskContext.get().partitionId() << 32, 0, _Places()
        now = _Shard(places)
        for batch in batches:
            texts, first = batch.column(2).cast(pa.binary()).to_pylist(), 0
            for i, t in enumerate(texts, 1):
                now.add(t or b"")
                if now.size >= shard or i == len(texts):
                    now.ids.append(batch.column(0).slice(first, i - first))
                    now.parts.append(batch.column(1).slice(first, i - first))
                    first = i
                if now.size >= shard:
                    yield now.row(group, number)
                    number += 1
                    if len(places) >= group_words:
                        group, number, places = group + 1, 0, _Places()
                    now = _Shard(places)
        if now.ids:
            yield now.row(group, number)

    schema = T.StructType()
    for name, kind in _shard_fields(docs.schema[id_col].dataType):
        schema.add(name, kind)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(part).cast("string"), F.lit("")), F.col(text).cast("string"))
    return rows.mapInArrow(cut, schema)


def _shard_fields(id_kind: T.DataType, packed: str = "binary") -> list[tuple[str, T.DataType]]:
    kinds = {"group": "long", "number": "int", "id": T.ArrayType(id_kind), "part": "array<string>",
             "capital": "array<boolean>", "special": "array<boolean>", "digest": "array<binary>",
             "indptr": packed, "indices": packed, "counts": packed}
    if packed == "binary":
        kinds |= {"known": "int", "words": "array<string>"}
    return [(k, T._parse_datatype_string(v) if isinstance(v, str) else v) for k, v in kinds.items()]


def dictionary(cut: DataFrame) -> DataFrame:
    """group, place, word and the word's term number, the same in all groups."""
    buckets = 8 * max(128, shuffle_width(cut))
    words = cut.select("group", "known", F.posexplode("words").alias("at", "word"))
    words = words.select("group", (F.col("known") + F.col("at")).alias("place"), "word",
                         F.pmod(F.xxhash64("word"), F.lit(buckets)).alias("bucket"))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word")).cast("long")
    return words.select("group", "place", "word", ((rank - 1) * buckets + F.col("bucket")).alias("term"))


def _with_terms(cut: DataFrame) -> DataFrame:
    """The shards sorted by group, each group after a row with the term numbers of its list."""
    lists = dictionary(cut).groupBy("group").agg(  # about GROUP_WORDS and one shard's words
        F.collect_list("place").alias("places"), F.collect_list("term").alias("terms"))
    rows = cut.drop("known", "words")
    lists = lists.select("group", F.lit(-1).alias("number"), "places", "terms")
    both = rows.unionByName(lists, allowMissingColumns=True)
    return both.repartition(shuffle_width(cut), "group").sortWithinPartitions("group", "number")


def _encoded(batches):
    """(the batch's row of a shard, indptr, indices as term numbers, counts) of a sorted stream."""
    at, terms = None, np.empty(0, np.int64)
    for batch in batches:
        group, number, places, numbers, *packed = (
            batch.column(c) for c in ("group", "number", "places", "terms", "indptr", "indices", "counts"))
        for i in range(batch.num_rows):
            if number[i].as_py() < 0:
                at, terms = group[i].as_py(), np.empty(len(places[i].values), np.int64)
                terms[places[i].values.to_numpy()] = numbers[i].values.to_numpy()
                continue
            if group[i].as_py() != at:  # a group without a word has no list
                at, terms = group[i].as_py(), np.empty(0, np.int64)
            indptr, indices, counts = (_unpack(c[i].as_py()) for c in packed)
            yield batch.slice(i, 1), indptr, terms[indices], counts


def term_matrix(cut: DataFrame) -> DataFrame:
    """The shards with term numbers as columns; ``cut`` is read twice, so write it first."""
    fields = _shard_fields(cut.schema["id"].dataType.elementType, "array<long>")
    names = [k for k, _ in fields]

    def encode(batches):
        for row, *matrix in _encoded(batches):
            arrays = [pa.array([x.astype(np.int64)], pa.list_(pa.int64())) for x in matrix]
            yield pa.RecordBatch.from_arrays([row.column(c) for c in names[:-3]] + arrays, names)

    schema = T.StructType()
    for name, kind in fields:
        schema.add(name, kind)
    return _with_terms(cut).mapInArrow(encode, schema)


def row_counts(cut: DataFrame) -> DataFrame:
    """id, part, flags, digest, n_words (row sum) and n_distinct (nonzero entries) of every row of the term matrix.

    ``cut`` is read twice, so write it first.
    """
    plain = ("id", "part", "capital", "special", "digest")

    def count(batches):
        for row, indptr, terms, counts in _encoded(batches):
            upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            filled = np.concatenate([[0], np.cumsum((terms >= 0) & (counts > 0), dtype=np.int64)])
            columns = [row.column(c).flatten() for c in plain]
            columns += [pa.array(np.diff(x[indptr])) for x in (upto, filled)]
            yield pa.RecordBatch.from_arrays(columns, [*plain, "n_words", "n_distinct"])

    schema = T.StructType()
    for name, kind in _shard_fields(cut.schema["id"].dataType.elementType):
        if name in plain:
            schema.add(name, kind.elementType)
    schema.add("n_words", "long").add("n_distinct", "long")
    return _with_terms(cut).mapInArrow(count, schema)


def failed(counts: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """part, failed (bits of A to E), n, good and toxic; ``counts`` is read twice, so write it first."""
    bit = lambda letter, c: F.when(c, 1 << LETTERS.index(letter)).otherwise(0)
    mask = (bit("A", F.col("n_words") < MIN_WORDS)
            + bit("B", 100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"))
            + bit("C", F.col("capital")) + bit("D", F.col("special")))
    rows = counts.select("id", "part", "digest", mask.alias("failed"))
    rows = rows.groupBy("id", "part", "digest", "failed").agg(F.count("*").alias("n"))  # rows that repeat an id

    known = rows.filter("id is not null")
    least = known.groupBy("digest").agg(F.min("id").alias("id"), F.lit(True).alias("least"))
    marks = labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).cast("string").alias("name")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = known.join(least, ["digest", "id"], "left").select(
        F.col("id").cast("string").alias("name"), "part", "n",
        (F.col("failed") + bit("E", F.col("least").isNull())).alias("failed"))
    known = known.join(marks, "name", "left")
    unnamed = rows.filter("id is null").select(
        F.lit(None).cast("string").alias("name"), "part", "n", "failed",
        F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    both = known.select(*unnamed.columns).union(unnamed)
    marked = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    return both.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), marked("good").alias("good"), marked("toxic").alias("toxic"))


def orders(sets: DataFrame) -> DataFrame:
    """The counts of every part, order of filters and step, from the counts of each set of failed filters."""
    parts = sets.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))  # 32 at most
    steps = parts.select("part", "sets", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    places = F.transform(F.split("filter_order", ""), lambda x: F.instr(F.lit(LETTERS), x) - 1)
    bits = F.transform(places, lambda i: F.call_function("shiftleft", F.lit(1), i))
    steps = steps.withColumn("bits", bits)
    before = F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda a, b: a.bitwiseOR(b))
    steps = steps.select("*", F.element_at("bits", F.col("step")).alias("own"), before.alias("before"))

    def total(count, which):
        return F.aggregate("sets", F.lit(0).cast("long"), lambda a, s: a + F.when(which(s["failed"]), count(s)).otherwise(0))

    n = lambda s: s["n"]
    own = lambda f: f.bitwiseAND(F.col("own")) != 0
    earlier = lambda f: f.bitwiseAND(F.col("before")) != 0
    removed = lambda f: own(f) & ~earlier(f)
    # of the orders, those that put a filter before the others that fail a document as well
    share = lambda s: F.expr(f"{len(ORDERS)}L") * s["n"] / F.bit_count(s["failed"])
    return steps.select(
        "part", "filter_order", "step",
        total(n, lambda f: ~own(f) & ~earlier(f)).alias("kept"), total(n, removed).alias("removed"),
        total(n, lambda f: own(f) & earlier(f)).alias("redundant"),
        total(n, lambda f: f == F.col("own")).alias("unique_fails"),
        total(lambda s: s["good"], removed).alias("good_lost"), total(lambda s: s["toxic"], removed).alias("toxic_lost"),
        total(lambda s: share(s).cast("long"), own).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", part: str = "source",
          text: str = "text") -> DataFrame:
    """Counts per part, order of the five filters and step."""
    cut = written(shards(docs, id_col, part, text), "shards")
    return orders(failed(written(row_counts(cut), "filter_flags"), labels))
