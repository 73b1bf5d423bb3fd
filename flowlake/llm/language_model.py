"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A bigram seen c times is stored as the entries (bigram, 1) ... (bigram, q)
with q = 1 + floor(log2 c) in one Bloom filter.  A lookup probes (bigram, 1),
(bigram, 2), ... until a probe fails; the last hit tells the quantised count.
Probabilities are smoothed towards the unigram with a Dirichlet prior:
P(w|h) = (c(h,w) + MU * P(w)) / (c(h) + MU), P(w) = (c(w) + 1) / (N + V + 1).
Unigram counts are exact.

Steps, all bounded per task:

1. Texts are read once into *chunks* of at most ``CHUNK_BYTES``: local word
   codes of all texts (compressed) and the chunk's vocabulary with training
   counts.  A word occurs once in a chunk's vocabulary, whatever its
   frequency, so no word is hot in the shuffle that sums the counts.
2. Chunks send their distinct training bigrams, hashed, by segment of the
   filter (sorted, packed); a segment holds about ``SEGMENT`` bigrams however
   large the corpus is, and one task counts them and sets its bits.
3. Segments are broadcast in groups (shards) of at most ``SHARD_BYTES``, one
   pass over the chunks per shard, so the broadcast is bounded while the
   filter grows with the corpus.  A pass scores the words whose bigram lies in
   its shard; the sums per text are added up.

Defined results: a null text is an empty text: its one token is the end.  A
null id hashes like the empty text and so belongs to training.  Repeated rows
keep one result each; extra columns are ignored; without training rows N = V =
0 and every token has probability 1.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Every HELD_OUT[0]-th remainder HELD_OUT[1] of crc32(id) is not learned from.
HELD_OUT = (7, 2)

#: Strength of the prior, filter bits per entry, hash functions of the filter.
MU, BITS, HASHES = 4.0, 10, 6

#: Text bytes of a chunk, bigrams of a segment, bytes of a broadcast.
CHUNK_BYTES, SEGMENT, SHARD_BYTES = 16 << 20, 1_000_000, 128 << 20

#: The end token; no word holds a newline.
END = b"\n"

_CHUNK = ("chunk long, n_docs long, n_tokens long, ids array<long>, held array<boolean>, sizes array<int>, "
          "codes binary, vocab array<string>, train array<long>")
_U = np.uint64


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1] if doc_id is not None else False


def _pack(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


class _Codes(dict):
    """Words to local codes; a new word gets the next one."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _chunks(batches):
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32

    def row():
        nonlocal number
        number += 1
        all_codes = np.concatenate(codes)
        train = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(all_codes[train], minlength=len(vocab))
        return pd.DataFrame({
            "chunk": [number - 1], "n_docs": [len(ids)], "n_tokens": [len(all_codes)], "ids": [ids], "held": [held],
            "sizes": [sizes], "codes": [_pack(all_codes)], "vocab": [[w.decode() for w in vocab]], "train": [counts]})

    ids, held, sizes, codes, vocab, read = [], [], [], [], _Codes({END: 0}), 0
    for batch in batches:
        for doc_id, text in zip(batch["id"], batch["t"]):
            if ids and read + len(text) > CHUNK_BYTES:
                yield row()
                ids, held, sizes, codes, vocab, read = [], [], [], [], _Codes({END: 0}), 0
            doc_id = None if pd.isna(doc_id) else int(doc_id)
            words = text.encode().lower().split()
            ids.append(doc_id)
            held.append(held_out(doc_id))
            sizes.append(len(words) + 1)
            codes.append(np.fromiter(map(vocab.__getitem__, (*words, END)), np.int32, len(words) + 1))
            read += len(text)
    if ids:
        yield row()


def _word_hashes(vocab: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w, 1) for w in vocab), _U, len(vocab))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _bigrams(codes: np.ndarray, first: int, hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, 32-bit key in the segment) of each token with the one before it (``first`` before the first)."""
    h = hashes[np.concatenate(([first], codes[:-1]))]
    x = _mix(h * _U(0xD6E8FEB86659FD93) + hashes[codes])
    return ((x >> _U(32)) * _U(segments) >> _U(32)).astype(np.int64), (_mix(x) & _U(0xFFFFFFFF))


def _counted(segments: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                codes = _unpack(r["codes"], np.int32)
                train = np.repeat(~np.array(r["held"], bool), r["sizes"])
                hashes = _word_hashes(r["vocab"])
                segment, key = _bigrams(codes, 0, hashes, segments)
                segment, key = segment[train], key[train]
                both, n = np.unique(segment.astype(_U) << _U(32) | key, return_counts=True)
                segment = (both >> _U(32)).astype(np.int64)
                key = (both & _U(0xFFFFFFFF)).astype(np.uint32)
                cut = np.flatnonzero(np.diff(segment, prepend=-1))
                for i, j in zip(cut, [*cut[1:], len(both)]):
                    steps = np.diff(key[i:j], prepend=np.uint32(0)).astype("<u4")
                    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T)  # compresses by byte
                    yield pa.RecordBatch.from_pydict({
                        "segment": pa.array([int(segment[i])], pa.int64()),
                        "keys": pa.array([_pack(planes)], pa.binary()),
                        "counts": pa.array([_pack(n[i:j].astype(np.int32))], pa.binary())})

    return run


def _probes(segment_key: np.ndarray, level: int, i: int) -> np.ndarray:
    a = _mix(segment_key * _U(0xC2B2AE3D27D4EB4F) + _U(level))
    return (a >> _U(32)) + _U(i) * ((a & _U(0xFFFFFFFF)) | _U(1))


def _segment_filter(rows: pd.DataFrame) -> pd.DataFrame:
    keys, counts = [], []
    for k, c in zip(rows["keys"], rows["counts"]):
        planes = _unpack(k, np.uint8).reshape(4, -1)
        steps = np.ascontiguousarray(planes.T).view("<u4").ravel()
        keys.append(np.cumsum(steps, dtype=np.uint32))
        counts.append(_unpack(c, np.int32))
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    distinct, where = np.unique(keys, return_inverse=True)
    total = np.bincount(where, counts)
    levels = 1 + np.floor(np.log2(total)).astype(np.int64)
    n_bits = _U(max(64, -(-int(levels.sum()) * BITS // 64) * 64))
    bits = np.zeros(int(n_bits), bool)
    key = distinct.astype(_U)
    for level in range(1, int(levels.max()) + 1):
        there = key[levels >= level]
        for i in range(HASHES):
            bits[_probes(there, level, i) % n_bits] = True
    return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "n_bits": [int(n_bits)],
                         "n_keys": [len(distinct)], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


class Filter:
    """The segments of one shard, joined into one array."""

    def __init__(self, rows: list[tuple[int, int, bytes]], segments: int):
        self.n_bits, self.offset = np.ones(segments, _U), np.zeros(segments, _U)
        self.there = np.zeros(segments, bool)
        at = 0
        for segment, n_bits, bits in rows:
            self.n_bits[segment], self.offset[segment], self.there[segment] = n_bits, at, True
            at += len(bits) * 8
        self.raw = b"".join(r[2] for r in rows)  # travels as bytes: a worker holds it once

    def level(self, segment: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Quantised counts: how many levels in a row the filter holds."""
        out, bits = np.zeros(len(key), np.int64), np.frombuffer(self.raw, np.uint8)
        left = np.flatnonzero(self.there[segment])
        level = 1
        while len(left):
            n, at = self.n_bits[segment[left]], self.offset[segment[left]]
            k = key[left]
            for i in range(HASHES):
                p = _probes(k, level, i) % n + at
                hit = (bits[(p >> _U(3)).astype(np.int64)] >> (p & _U(7)).astype(np.uint8)) & 1 == 1
                left, k, n, at = left[hit], k[hit], n[hit], at[hit]
                if not len(left):
                    break
            out[left] = level
            level += 1
        return out


def _expected(levels: np.ndarray) -> np.ndarray:
    """A count for each level: 0, 1, then the middle of [2^(q-1), 2^q)."""
    return np.where(levels < 2, levels, 0.75 * 2.0 ** levels)


def _scored(shard, shards: int, number: int, segments: int, n: int, v: int):
    """Rows (chunk, i, id, held, n_tokens, n_known, base, part) of the words whose bigram is in the shard."""

    def run(batches):
        table = shard.value
        for batch in batches:
            for j in range(batch.num_rows):
                col = {c: batch.column(c)[j] for c in batch.schema.names}
                codes = _unpack(col["codes"].as_py(), np.int32)
                sizes = col["sizes"].values.to_numpy()
                at, got = col["pos"].values.to_numpy(), col["total"].values.to_numpy()
                count = np.zeros(len(at), np.int64)
                count[at] = got
                hashes = _word_hashes(col["vocab"].as_py())
                one = (count + 1.0) / (n + v + 1.0)
                log_one = np.log10(one)
                part, base, known = np.empty(len(codes)), log_one[codes], count[codes] > 0
                for s in range(0, len(codes), 1 << 17):  # small steps, small temporaries
                    c = codes[s: s + (1 << 17)]
                    first = int(codes[s - 1]) if s else 0
                    before = np.concatenate(([first], c[:-1]))
                    segment, key = _bigrams(c, first, hashes, segments)
                    here = segment * shards // segments == number
                    seen = np.zeros(len(c))
                    seen[here] = _expected(table.level(segment[here], key[here]))
                    # an estimate may be above, a bigram is not more frequent than its words: p is 1 at most
                    seen = np.minimum(seen, np.minimum(count[before], count[c]))
                    p = (seen + MU * one[c]) / (count[before] + MU)
                    part[s: s + len(c)] = np.where(here, np.log10(p), 0.0)
                start = np.cumsum(sizes) - sizes
                add = lambda x: np.add.reduceat(x, start)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array(np.full(len(sizes), col["chunk"].as_py())),
                    "i": pa.array(np.arange(len(sizes))),
                    "id": pa.array(col["ids"].as_py(), pa.int64()),
                    "held_out": pa.array(col["held"].as_py(), pa.bool_()),
                    "n_tokens": pa.array(sizes.astype(np.int64)),
                    "n_known": pa.array(add(known.astype(np.int64))),
                    "base_score": pa.array(add(base)),
                    "score": pa.array(add(part)),
                })

    return run


def score(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every whole text."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    chunks = common.written(rows.mapInPandas(_chunks, _CHUNK), "chunks")
    n, tokens = chunks.agg(
        F.sum(F.aggregate("train", F.lit(0).cast("long"), lambda a, b: a + b)), F.sum("n_tokens")).first()
    n, tokens = n or 0, tokens or 0

    # exact counts of each chunk's words: one shuffle by word, at most one row of a word per chunk
    words = chunks.select("chunk", F.posexplode(F.arrays_zip("vocab", "train")).alias("pos", "w"))
    words = words.select("chunk", "pos", F.col("w.vocab").alias("word"), F.col("w.train").alias("n"))
    same = Window.partitionBy("word")
    totals = common.written(words.select("chunk", "pos", F.sum("n").over(same).alias("total"),
                                         (F.min("chunk").over(same) == F.col("chunk")).alias("first")), "counts")
    v = totals.filter("first and total > 0").count()
    counted = totals.groupBy("chunk").agg(F.collect_list("pos").alias("pos"), F.collect_list("total").alias("total"))

    segments = max(1, -(-n // SEGMENT))
    packed = chunks.select("held", "sizes", "codes", "vocab").mapInArrow(
        _counted(segments), "segment long, keys binary, counts binary")
    filters = common.written(packed.groupBy("segment").applyInPandas(
        _segment_filter, "segment long, n_bits long, n_keys long, bits binary"), "filter")
    size = filters.agg(F.sum(F.length("bits"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))

    parts = []
    ready = chunks.select("chunk", "ids", "held", "sizes", "codes", "vocab").join(counted, "chunk")
    for number in range(shards):
        mine = filters.filter(F.floor(F.col("segment") * shards / F.lit(segments)) == number)
        held = [(r.segment, r.n_bits, bytes(r.bits)) for r in mine.select("segment", "n_bits", "bits").toLocalIterator()]
        shard = spark.sparkContext.broadcast(Filter(held, segments))
        run = _scored(shard, shards, number, segments, n, v)
        parts.append(common.written(ready.mapInArrow(
            run, "chunk long, i long, id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                 "score double"), "scores"))
        shard.destroy()
    for done in (chunks, totals, filters):
        common.discard(done)
    out = parts[0]
    if shards > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        first = lambda c: F.first(c).alias(c)
        out = out.groupBy("chunk", "i").agg(*(first(c) for c in ("id", "held_out", "n_tokens", "n_known", "base_score")),
                                            F.sum("score").alias("score"))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
