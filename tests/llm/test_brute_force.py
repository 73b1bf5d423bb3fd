"""Queries against brute-force versions and DuckDB on the smallest tables."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import bpe, components, language_id, language_model, licenses, queries, simhash, vectors

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, lang FROM documents").fetchall()


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, con, name):
    def canon(columns, rows):
        at = sorted(range(len(columns)), key=columns.__getitem__)
        return sorted(str([r[i] for i in at]) for r in rows)

    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert canon(got.columns, got.collect()) == canon(columns, want.fetchall())


def union(n, pairs):
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_simhash(spark, docs):
    import xxhash

    def fingerprint(text):
        w = words(text)
        if not w:
            return 0
        hashes = [xxhash.xxh64(" ".join(w[i:i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    ids = [d[0] for d in docs]
    prints = [fingerprint(d[1]) for d in docs]
    comp = union(len(ids), [(i, j) for i, j in combinations(range(len(ids)), 2)
                            if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for i, c in zip(ids, comp):
        least[c] = min(least.get(c, i), i)
    want = {i: (f"{p:016x}", least[c]) for i, p, c in zip(ids, prints, comp)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.simhash_query(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_simhash_links_every_radius(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 62, 12)
    prints = {int(b) for b in base}
    for b in base:
        for _ in range(8):
            bits = rng.choice(62, rng.integers(1, 5), replace=False)
            prints.add(int(b) ^ sum(1 << int(x) for x in bits))
    prints = sorted(prints)
    comp = union(len(prints), [(i, j) for i, j in combinations(range(len(prints)), 2)
                               if (prints[i] ^ prints[j]).bit_count() <= radius])
    want = {p: prints[c] for p, c in zip(prints, comp)}
    links = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), radius)
    got = {r.node: r.component for r in components.components(links).collect()}
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 700)]
    edges = spark.createDataFrame(path + star + [(7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)}


def test_language_model(spark, docs):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in docs}
    tokens = {i: words(t) + ["\n"] for i, t, _ in docs}
    count, pairs = Counter(), Counter()
    for i, t in tokens.items():
        if not held[i]:
            count.update(t)
            pairs.update(zip(["\n"] + t, t))
    n, v, mu = sum(count.values()), len(count), language_model.MU
    off = []
    for r in queries.language_model_query(spark, SF).collect():
        t = tokens[r.doc_id]
        one = {w: (count[w] + 1) / (n + v + 1) for w in t}
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[r.doc_id], len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10(one[w]) for w in t), rel_tol=1e-9)
        exact = sum(math.log10((pairs[h, w] + mu * one[w]) / (count[h] + mu)) for h, w in zip(["\n"] + t, t))
        off.append(abs(r.score - exact) / abs(exact))
    assert len(off) == len(docs) and np.median(off) < 0.05 and max(off) < 0.5


def test_language_model_probabilities_of_a_repeated_passage(spark):
    """A passage read 1,024 times, where quantised counts are above their contexts'."""
    ids = [i for i in range(2000) if not language_model.held_out(i)][:1024]
    passage = " ".join(f"word{i}" for i in range(20))
    df = spark.createDataFrame([(i, passage) for i in ids], "doc_id long, text string")
    got = language_model.score(df).collect()
    assert len(got) == 1024
    # words follow each other always, so every token's probability is (1024 + mu * one) / (1024 + mu)
    one = 1025 / (1024 * 21 + 21 + 1)
    token = math.log10((1024 + language_model.MU * one) / (1024 + language_model.MU))
    assert token < 0 and all(math.isclose(r.score, 21 * token, rel_tol=1e-6) for r in got)


def test_language_model_in_shards_and_chunks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {r.doc_id: r for r in language_model.score(docs).collect()}
    monkeypatch.setattr(language_model, "SHARD_BYTES", 4096)
    monkeypatch.setattr(language_model, "SEGMENT", 4000)
    monkeypatch.setattr(language_model, "CHUNK_BYTES", 50_000)
    off = []
    for r in language_model.score(docs).collect():
        w = whole[r.doc_id]
        off.append(abs(r.score - w.score) / abs(w.score))  # other false positives of the filter
        assert (r.n_tokens, r.n_known, r.train_tokens) == (w.n_tokens, w.n_known, w.train_tokens)
        assert math.isclose(r.base_score, w.base_score, rel_tol=1e-9)
    assert np.median(off) < 0.02 and max(off) < 0.5


def test_bpe_matches_the_library(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_vocabulary()
    library = tokenizers.Tokenizer.from_file(path)
    mine = bpe.tokenizer(path)
    odd = ["a<|endoftext|> b", "  \n\t x", "don't WE'll", "aaaa" * 300, "日本語 é 🎉", "​́x", ""]
    for text in [t for _, t, _ in docs] + odd:
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)
    got = {r.doc_id: r for r in queries.bpe_query(spark, SF).collect()}
    for i, t, _ in docs:
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_automaton_accepts_exactly_the_encodings():
    """Every token string over a small vocabulary, against plain merging."""
    merges = [(b"a", b"b"), (b"a", b"a"), (b"ab", b"a"), (b"b", b"ab"), (b"aa", b"ab"), (b"aba", b"ab")]
    ids = {bytes([b]): b for b in range(256)} | {u + v: 256 + i for i, (u, v) in enumerate(merges)}
    auto = bpe.Automaton(ids, merges)

    def merged(word):
        t = [bytes([b]) for b in word]
        for u, v in merges:
            i = 0
            while i + 1 < len(t):
                if t[i] == u and t[i + 1] == v:
                    t[i:i + 2] = [u + v]
                i += 1
        return [ids[x] for x in t]

    label = {i: t for t, i in ids.items()}
    for n in range(1, 13):
        for k in range(1 << n):
            w = bytes(97 + (k >> i & 1) for i in range(n))
            out = merged(w)
            assert list(auto.word(w)) == out
            assert all(auto.arc(a, b) for a, b in zip(out, out[1:]))
    tokens = [97, 98, *(256 + i for i in range(len(merges)))]
    for a in tokens:
        for b in tokens:
            assert auto.arc(a, b) == (merged(label[a] + label[b]) == [a, b])


def test_language_id_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.language_id_query(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = got.select("doc_id", "held_out", "lang", "lang_pred", "score").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_language_id_gradients():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(0)
    h, k = 3, 2
    p = {"table": rng.normal(0, 0.5, (2, 257, 3 * h)), "rec": rng.normal(0, 0.5, (2, h, 3 * h)),
         "rec_bias": rng.normal(0, 0.5, (2, 1, 3 * h)), "out": rng.normal(0, 0.5, (2, h, k)),
         "out_bias": rng.normal(0, 0.5, k)}
    x = np.array([[1, 2, 3, 1], [4, 1, 256, 256]])
    y = np.array([0, 1])
    model = {"langs": ["a", "b"]}

    def loss():
        m = x != 256
        total = 0.0
        for row in range(2):
            seq, states = x[row], []
            for d in (0, 1):
                s, out = np.zeros(h), []
                for b in (seq if d == 0 else seq[::-1]):
                    i, g = p["table"][d][b], s @ p["rec"][d] + p["rec_bias"][d, 0]
                    r, z = (1 / (1 + np.exp(-(i[j * h:(j + 1) * h] + g[j * h:(j + 1) * h]))) for j in (0, 1))
                    c = np.tanh(i[2 * h:] + r * g[2 * h:])
                    s = (1 - z) * c + z * s
                    out.append(s)
                states.append(out if d == 0 else out[::-1])
            for t in range(4):
                if m[row, t]:
                    e = states[0][t] @ p["out"][0] + states[1][t] @ p["out"][1] + p["out_bias"]
                    total -= e[y[row]] - np.log(np.exp(e).sum())
        return total / m.sum()

    grad = language_id._gradients(p, x, y)
    for name, at in [("table", (0, 1, 2)), ("table", (1, 4, 7)), ("rec", (0, 1, 4)), ("rec", (1, 2, 8)),
                     ("rec_bias", (0, 0, 7)), ("out", (1, 0, 1)), ("out_bias", (0,))]:
        old = p[name][at]
        p[name][at] = old + 1e-5
        up = loss()
        p[name][at] = old - 1e-5
        down = loss()
        p[name][at] = old
        assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-6
    # the reader computes the same probabilities, across windows of a longer text too
    p["table"][:, 256] = 0
    p["table"][:, 256, h:2 * h] = 30
    reader = language_id.Reader(model | p)
    text = bytes(rng.integers(97, 110, 700).astype(np.uint8))
    whole = reader.probabilities([text, b"ab"])
    alone = reader.probabilities([b"ab"])
    assert np.allclose(whole[1], alone[0], atol=1e-5) and np.allclose(whole.sum(1), 1)


@pytest.mark.parametrize("k", [5, 300])
def test_every_language_is_trained(monkeypatch, k):
    seen = Counter()
    monkeypatch.setattr(language_id, "_gradients", lambda p, x, y: seen.update(y.tolist()) or {})
    language_id.train([(f"l{i:03}", "some words") for i in range(k)], steps=5)
    assert len(seen) == k and max(seen.values()) - min(seen.values()) <= 1
    assert min(seen.values()) >= 5 * min(1, language_id.BATCH // k)


def test_languages_of_copies_are_sampled(spark):
    data = [("cc", "ein text der kopiert wird"), ("cc", "noch ein text")] * 1000
    data += [("en", f"a text of its own number {i}") for i in range(1000)]
    data += [(f"l{i:02}", f"one text {i} {j}") for i in range(20) for j in range(4)]
    df = spark.createDataFrame(data, "lang string, text string")
    got = Counter(x for x, _ in language_id.sample(df, per_language=50))
    assert got["cc"] == 2 and 20 < got["en"] < 100 and all(got[f"l{i:02}"] == 4 for i in range(20))
    few = Counter(x for x, _ in language_id.sample(df, per_language=50, max_snippets=44))
    assert len(few) == 22 and set(few.values()) == {2}


def test_licenses_find_every_verbatim_template(spark, docs):
    got = {(r.doc_id, r.template, r.start, r.end) for r in queries.license_query(spark, SF).collect()}
    for i, text, _ in docs:
        for name, template in licenses.TEMPLATES.items():
            body = template.rstrip(".")
            at = text.find(body)
            if at >= 0:
                assert any(g[0] == i and g[2] <= at and g[3] >= at + len(body) - 1 for g in got), (i, name)


def test_licenses_whatever_case_and_white_space(spark):
    """Copies of every template that have the same words."""
    forms = {"upper": str.upper, "lower": str.lower, "wrapped": lambda t: t.replace(" ", "\n"),
             "double": lambda t: t.replace(" ", "  "), "hard": lambda t: t.replace(" ", "\u00a0"),
             "comment": lambda t: t.replace(" ", "\n * ")}
    data = [(f"{name}|{form}|{around}", ("Words before it. {} And words after it." if around else "{}").format(f(t)))
            for name, t in licenses.TEMPLATES.items() for form, f in forms.items() for around in (0, 1)]
    got = licenses.scan_documents(spark.createDataFrame(data, "doc_id string, text string")).collect()
    found = {r.doc_id: (r.template, r.n_missing + r.n_extra) for r in got}
    assert {i: found.get(i) for i, _ in data} == {i: (i.split("|")[0], 0) for i, _ in data}
    assert len(got) == len(data)
    body = dict(data)
    for r in got:
        assert body[r.doc_id][r.start:r.end].lower().split()[0] == licenses.TEMPLATES[r.template].lower().split()[0]


def test_vectors_recall_and_precision(spark):
    """Against brute force: groups of near copies larger than the window, and pairs at the threshold."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 32))
    rows = list(base)
    rows += [base[0] + rng.normal(size=32) * 0.12 for _ in range(80)]  # a group far beyond the window
    for b in base[1:60]:
        o = rng.normal(size=32)
        o -= (o @ b) / (b @ b) * b
        o *= np.linalg.norm(b) / np.linalg.norm(o)
        rows.append(b + np.tan(np.arccos(rng.uniform(0.9005, 0.97))) * o)
    x = np.array(rows, np.float32).astype(np.float64)
    n = np.linalg.norm(x, axis=1)
    near = (x @ x.T / np.outer(n, n) >= vectors.THRESHOLD) & ~np.eye(len(x), dtype=bool)
    comp = union(len(x), np.argwhere(near))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)],
                               "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in vectors.near_duplicates(df, window=4, block=64).collect()}
    links = near.sum(1)
    assert all(got[i].n_links <= links[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.98 * links.sum()
    assert sum(got[i].component_id == comp[i] for i in got) >= 0.98 * len(got)


@pytest.mark.parametrize("small", [False, True])
def test_vectors_in_a_cone(spark, small):
    """A third of the rows share a direction: by exact blocks, and by passes with blocks too small for that."""
    rng = np.random.default_rng(6)
    unit = lambda a: a / np.linalg.norm(a, axis=-1, keepdims=True)
    cone = unit(0.894 * unit(rng.normal(size=64)) + 0.448 * unit(rng.normal(size=(1000, 64))))
    x = unit(rng.normal(size=(2000, 64)))
    at = rng.permutation(1000)[:300]
    off = rng.normal(size=(300, 64))
    off = unit(off - (off * cone[at]).sum(1, keepdims=True) * cone[at])
    cone = np.concatenate([cone, 0.91 * cone[at] + math.sqrt(1 - 0.91 ** 2) * off])
    x = np.concatenate([x, cone]).astype(np.float32).astype(np.float64)
    near = (unit(x) @ unit(x).T >= vectors.THRESHOLD) & ~np.eye(len(x), dtype=bool)
    links, comp = near.sum(1), union(len(x), np.argwhere(near))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)],
                               "vec_id long, embedding array<float>")
    how = {"block": 64, "square": 16} if small else {}  # all in one window, or passes to the end
    got = {r.vec_id: r for r in vectors.near_duplicates(df, **how).collect()}
    wrong = sum(got[i].n_links != links[i] or got[i].component_id != comp[i] for i in got)
    assert len(got) == len(x) and links.sum() >= 600
    assert wrong <= (0.01 * (links > 0).sum() if small else 0)


def test_vectors_with_a_common_direction(spark, monkeypatch):
    """Mean cosine 0.7, as text embeddings have: the passes split the crowd, few rows are left for squares."""
    squares = []
    real = vectors._all_links
    monkeypatch.setattr(vectors, "_all_links", lambda rows, n, *a: squares.append(n) or real(rows, n, *a))
    rng = np.random.default_rng(1)
    g = rng.normal(size=(3000, 64))
    x = 0.836 * np.ones(64) / 8 + 0.548 * g / np.linalg.norm(g, axis=1)[:, None]
    x[1500:1700] = x[:200] + 0.25 * rng.normal(size=(200, 64)) / 8
    x = x.astype(np.float32).astype(np.float64)
    n = x / np.linalg.norm(x, axis=1)[:, None]
    assert 0.65 < (n @ n.T).mean() < 0.75
    near = (n @ n.T >= vectors.THRESHOLD) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, block=64, square=64).collect()}
    assert near.sum() >= 300 and sum(got.values()) >= 0.995 * near.sum()
    assert all(got[i] <= k for i, k in enumerate(near.sum(1))) and sum(squares) <= 150


def test_vectors_by_passes_at_production_sizes(spark, monkeypatch):
    """With the production block and square, no vector reaches the squares and the recall is whole."""
    monkeypatch.setattr(vectors, "_all_links", lambda *a: pytest.fail("all pairs"))
    rng = np.random.default_rng(3)
    x = rng.normal(size=(9000, 32))
    o = rng.normal(size=(1500, 32))
    o -= (o * x[:1500]).sum(1, keepdims=True) / (x[:1500] ** 2).sum(1, keepdims=True) * x[:1500]
    o *= np.linalg.norm(x[:1500], axis=1, keepdims=True) / np.linalg.norm(o, axis=1, keepdims=True)
    x[4000:5500] = x[:1500] + np.tan(np.arccos(rng.uniform(0.9005, 0.99, size=(1500, 1)))) * o
    x = x.astype(np.float32).astype(np.float64)
    n = x / np.linalg.norm(x, axis=1)[:, None]
    near = (n @ n.T >= vectors.THRESHOLD) & ~np.eye(len(x), dtype=bool)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    assert vectors.passes(9000, window=vectors.BLOCK) > 1
    pairs = vectors._pairs(df.select(F.col("vec_id").alias("c"), F.col("embedding").alias("v")), 9000,
                           vectors.THRESHOLD, vectors.WINDOW, vectors.MISS, vectors.BLOCK, 1)
    comp = {r.node: r.component for r in components.components(pairs).collect()}
    want = union(len(x), np.argwhere(near))
    assert near.sum() >= 3000 and sum(comp.get(i, i) == want[i] for i in range(len(x))) >= 0.999 * len(x)


def test_vectors_of_a_large_component_are_copied_per_square(spark):
    rng = np.random.default_rng(8)
    x = (np.ones(8) + 0.2 * rng.normal(size=(300, 8))).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "c long, v array<float>")
    df = df.withColumn("copies", F.lit(1).cast("long"))
    comps = df.select(F.col("c").alias("node"), F.lit(0).cast("long").alias("component"))
    assert vectors._dealt(df, comps, 16, 128).count() == 300 * 3  # blocks of 16 made 300 * 19
    got = {r.c: r.links for r in vectors._links(df, comps, vectors.THRESHOLD, 16, 128).collect()}
    n = x / np.linalg.norm(x, axis=1)[:, None]
    links = (n @ n.T >= vectors.THRESHOLD).sum(1) - 1
    assert links.sum() > 300 and all(got[i] == links[i] for i in range(300))


def test_pipeline_against_brute_force(spark, docs, con):
    """Every stage's decisions, recomputed from its own input."""
    import corpus_pipeline
    from flowlake.llm import mixing, quality
    from flowlake.llm.common import table

    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_rules", "simhash_dedup", "source_mixing", "bpe_encoding"]
    start = table(spark, SF, "documents")
    told = stage["language_id"](spark, start, SF)
    assert told.columns == start.columns
    reader = language_id.Reader(language_id.learn(start))
    sure = {i for i, t, _ in docs if re.search(r"[^\W\d_]", t or "")
            and reader.probabilities([t.encode()]).max() >= 0.4}
    assert {r.doc_id for r in told.collect()} == sure

    good = stage["quality_rules"](spark, told, SF)
    verdict = {r.doc_id for r in quality.apply_rules(told).filter("kept").collect()}
    assert good.columns == start.columns and {r.doc_id for r in good.collect()} == verdict
    # clean texts stay
    clean = {r[0] for r in con.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    long = {i for i, t, _ in docs if len(words(t)) >= 50}
    assert len(clean & long & sure & verdict) >= 0.95 * len(clean & long & sure)

    single = stage["simhash_dedup"](spark, good, SF)
    reps = {r.doc_id for r in simhash.near_duplicates(good).filter("kept").collect()}
    assert single.columns == start.columns and sorted(r.doc_id for r in single.collect()) == sorted(reps)

    mixed = stage["source_mixing"](spark, single, SF)
    plan = mixing.mixture(single)
    assert mixed.columns == start.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in plan.collect())

    out = corpus_pipeline.run(spark, SF)
    t = bpe.tokenizer(bpe.default_vocabulary())
    text = {i: x for i, x, _ in docs}
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in mixed.collect())
    assert all(list(r.ids) == t.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) for r in rows)
    empty = start.limit(0)
    for _, f in corpus_pipeline.STAGES:
        empty = f(spark, empty, SF)
    assert empty.count() == 0


def test_no_python_in_native_plans(spark):
    for name in ("op1_mixing", "op2_url_rules", "op4_quality", "op5_chat"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_nothing_else_imports_the_subpackage():
    root = os.path.join(os.path.dirname(__file__), "..", "..", "flowlake")
    for folder, _, files in os.walk(root):
        if os.path.basename(folder) == "llm" or "__pycache__" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                assert not re.search(r"import.*\bllm\b|from\s+\S*\bllm\b", open(os.path.join(folder, f)).read()), f


def test_repeats_are_exact_under_shuffled_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    b = {r.doc_id: r for r in simhash.near_duplicates(docs.orderBy(F.desc("doc_id"))).collect()}
    assert a == b
