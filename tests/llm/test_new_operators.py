"""Importance resampling, the filter audit and main-text extraction: brute force, planted cases, odd rows."""

import html
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import filter_audit, importance, main_text

SF = "/root/testdata/sf0.001"
CLASHING = ("n_words", "weight", "score", "rank", "row", "a", "b", "long", "at", "part", "digest", "failed", "shard",
            "words", "n", "id", "bucket", "term")


def with_clashes(df):
    for c in CLASHING:
        df = df.withColumn(c, F.lit(1))
    return df.withColumn("m", F.create_map(F.lit("k"), F.lit(1)))


# -- importance ---------------------------------------------------------------------------------------------

def feature_list(text):
    small = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


@pytest.mark.parametrize("piece", [1, 5, 1 << 20])
def test_features_of_pieces(monkeypatch, piece):
    monkeypatch.setattr(importance, "PIECE", piece)
    for text in ("Hello, WORLD été x9 a_b", "a", "", "one two three four five six seven", "  x\ty ", "ÀB İ ß", None):
        w, f = feature_list(text)
        got = list(importance.features(None if text is None else text.encode()))
        assert sum(n for n, _ in got) == len(w)
        assert Counter(x for _, p in got for x in p.tolist()) == Counter(zlib.crc32(x.encode()) % 10000 for x in f)


def test_weighted_median_leaves_a_quarter_on_either_side():
    rng = random.Random(1)
    for _ in range(200):
        parts = [sorted(rng.randrange(50) for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 12))]
        m, _ = importance.weighted_median([((p[(len(p) - 1) // 2], 0), len(p)) for p in parts])
        rows = sorted(x for p in parts for x in p)
        # a lower median has half its partition, rounded up, on either side
        assert 4 * sum(x <= m for x in rows) >= len(rows) and 4 * sum(x >= m for x in rows) >= len(rows)


def test_cutoff_is_exact(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.randrange(-40, 40), rng.randrange(5)) for _ in range(3000)]
    rows += [(7, 3)] * 1500  # a third of all keys is one
    df = spark.createDataFrame(rows, "a long, b long").repartition(7)
    monkeypatch.setattr(importance, "KEYS", 100)
    for k in (1, 2, 1700, 2500, 4499, 4500):
        assert importance.cutoff(df, k) == sorted(rows)[k - 1]


def test_passes_grow_with_the_logarithm(spark, monkeypatch):
    seen = []
    real = importance.weighted_median
    monkeypatch.setattr(importance, "weighted_median", lambda m: seen.append(sum(n for _, n in m)) or real(m))
    importance.cutoff(spark.range(40000).selectExpr("xxhash64(id) a", "id b").repartition(8), 10000)
    assert all(b <= 0.75 * a + 1 for a, b in zip(seen, seen[1:])) and len(seen) <= 40


def test_importance_odd_rows(spark):
    long = "mot " * 200_000
    docs = [(1, "the quick brown fox " * 6), (2, None), (3, ""), (4, long), (None, "tie tie " * 20), (None, "tie tie " * 20),
            (5, "the quick brown fox " * 6), (5, "the quick brown fox " * 6), (6, "?!"), (7, "short")]
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    target = with_clashes(spark.createDataFrame([(1, "quick brown fox"), (2, None)], "item_id long, text string"))
    scored = importance.score(df, importance.gains(importance.bucket_counts(df), importance.bucket_counts(target)))
    got = importance.draw(scored, percent=50).collect()
    assert len(got) == len(docs) and {r["rank"] for r in got} == {None, 1, 2, 3}
    assert sum(r["rank"] is not None for r in got) == 3  # of the six with 20 words
    by = {r.doc_id: r for r in got}
    assert (by[2].n_features, by[2].weight, by[4].n_features, by[6].n_words) == (0, 0, 399_999, 0)
    assert by[1].weight > by[4].weight
    e = sorted((r for r in got if r.n_words >= 20), key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))
    assert [(r.score, r.doc_id) for r in e[:3]] == [(r.score, r.doc_id) for r in sorted(
        (r for r in got if r["rank"]), key=lambda r: r["rank"])]
    none = df.limit(0)
    assert importance.resample(none, target).count() == 0
    assert importance.resample(df, target.limit(0)).filter("rank is not null").count() == 1
    names = spark.createDataFrame([("x", "w " * 30), ("y", "w " * 30), (None, "w " * 30)], "doc_id string, text string")
    assert importance.draw(importance.score(names, np.zeros(10000, int)), percent=67).filter("rank > 0").count() == 2


def test_importance_of_one_hot_id_spreads(spark, monkeypatch):
    """A third of the rows share an id and a score: they are ranked one by one, in several sorted partitions."""
    rows = spark.range(6000).selectExpr("if(id % 3 = 0, 0, id) doc_id", "30L n_words", "1L n_features", "0L weight",
                                        "if(id % 3 = 0, 9L, 1L) score")
    real, sorted_rows = importance.written, {}
    monkeypatch.setattr(importance, "written", lambda df, name: sorted_rows.update({name: real(df, name)}) or sorted_rows[name])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    got = importance.draw(rows, percent=50)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    ranks = sorted(r[0] for r in got.select("rank").filter("rank is not null").collect())
    assert ranks == list(range(1, 3001))
    assert got.filter("rank <= 2000 and doc_id != 0").count() == 0
    hot = sorted_rows["winners"].filter("row.doc_id = 0").groupBy(F.shiftright("at", 33)).count().collect()
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 1000


# -- filter audit --------------------------------------------------------------------------------------------

def audit_by_hand(docs, labels):
    good, toxic = ({i for i, *f in labels if i is not None and f[k] == 1} for k in (0, 1))
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails = []
    for i, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
             "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
             "E": i is not None and i > least[t]}
        fails.append((part or "", i in good, i in toxic, {k for k, v in f.items() if v}))
    out, shapley = {}, Counter()
    for part in {f[0] for f in fails}:
        for order in map("".join, permutations("ABCDE")):
            left = [f for f in fails if f[0] == part]
            for step, c in enumerate(order, 1):
                gone = [f for f in left if c in f[3]]
                left = [f for f in left if c not in f[3]]
                all_c = [f for f in fails if f[0] == part and c in f[3]]
                out[part, order, step] = (len(left), len(gone), len(all_c) - len(gone),
                                          sum(f[3] == {c} for f in all_c), sum(f[1] for f in gone), sum(f[2] for f in gone))
                shapley[part, c] += len(gone)
    return {k: v + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_audit_against_brute_force(spark):
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    labels = con.execute(f"SELECT doc_id, quality, toxic FROM '{SF}/labels.parquet'").fetchall()
    same = "One text, many times. " * 12
    docs += [(None, same, None), (None, same, "src0"), (9, same, "src0"), (9, same, "src0"), (9, same, None),
             (10 ** 6, same, "new"), (10 ** 6, None, "new"), (10 ** 6 + 1, "", "new"), (-5, "A" * 300_000, "long"),
             (10 ** 6 + 2, "mot " * 100_000, "long"), (10 ** 6 + 3, " \n\t\x0b\x0c\r\x1c\x85 ", "odd")]
    labels += [(9, 1, None), (9, 0, 1), (None, 1, 1), (10 ** 6 + 2, 1, 0), (-5, None, None)]
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("name", F.lit(1))
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in filter_audit.audit(df, marks).collect()}
    assert got == audit_by_hand(docs, labels)
    assert filter_audit.audit(df.limit(0), marks).count() == 0
    assert filter_audit.audit(df, marks.limit(0)).agg(F.max("good_lost")).first()[0] == 0


def test_term_matrix(spark):
    """Small shards, one dictionary: the matrix holds every text's words, and a word has one number everywhere."""
    docs = [(i, t) for i, t in enumerate(["a b a", "b c", "", None, "c c c d", "a\tb\nz é", "x" * 50 + " a", "a b a"] * 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("source", F.lit("s")).repartition(3)
    cut = filter_audit.shards(df, shard=16, group_words=3).cache()
    terms = {}
    for r in filter_audit.dictionary(cut).collect():
        assert terms.setdefault(r.word, r.term) == r.term
    assert len(set(terms.values())) == len(terms) == 7
    word = {n: w for w, n in terms.items()}
    matrix = filter_audit.term_matrix(cut).collect()
    assert len(matrix) > 9
    text = dict(docs)
    for m in matrix:
        for k, i in enumerate(m.id):
            a, b = m.indptr[k], m.indptr[k + 1]
            row = {word[t]: n for t, n in zip(m.indices[a:b], m.counts[a:b])}
            assert row == Counter((text[i] or "").split())
    counts = {r.id: (r.n_words, r.n_distinct) for r in filter_audit.row_counts(cut).collect()}
    assert counts == {i: (len((t or "").split()), len(set((t or "").split()))) for i, t in docs}


def test_dictionary_numbers_do_not_depend_on_the_shards(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = ({(r.word, r.term) for r in filter_audit.dictionary(filter_audit.shards(df.repartition(n), shard=size, group_words=3000))
             .select("word", "term").collect()} for n, size in ((2, 1 << 20), (5, 1 << 12)))
    assert a == b


def test_audit_of_one_text_does_not_gather_it(spark):
    """Copies of one text combine before the shuffle: no task of a join or sum sees them all."""
    df = spark.range(4000).selectExpr("id doc_id", "if(id % 3 > 0, 'same text', string(id)) text", "'s' source")
    marks = spark.range(10).selectExpr("id doc_id", "1 quality", "0 toxic")
    plan = filter_audit.failed(
        filter_audit.row_counts(filter_audit.shards(df)), marks
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(id" not in plan
    r = filter_audit.audit(df, marks).filter("filter_order = 'EABCD' and step = 1").first()
    assert (r.removed, r.kept) == (2665, 4000 - 2665)


# -- main text -----------------------------------------------------------------------------------------------

def test_given_pages(spark):
    """On the given pages the article element alone tells the text: a version by patterns."""
    got = {r.page_id: r for r in main_text.extract_pages(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(pages) > 0
    for i, url, page in pages:
        inner = re.sub(r"</?b>", "", re.search(r"<article>([\s\S]*?)</article>", page)[1])
        want = " ".join(html.unescape(re.sub(r"</?(p|h1|br)>", "\n", inner)).split())
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, want, len(want))


WORDS = "lorem dolor, amet & tempor <labore> été “magna” aliqua. quis 3 > 2 ut nostrud".split()


def made_page(rng, article):
    """A page of known blocks and its main text; ``article`` opens and closes the article."""
    def text(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    def inline(t):
        out = html.escape(t)
        if rng.random() < 0.4:
            w = out.split(" ")
            k = rng.randrange(len(w))
            w[k] = rng.choice(["<b>{}</b>", "<em class='x'>{}</em>", "<a href=\"/l\">{}</a>", "<span>{}</span>"]).format(w[k])
            out = rng.choice([" ", "  ", "\n\t"]).join(w)
        return out

    rest = [
        lambda: "<nav><ul>" + "".join(f"<li><a href='/{k}'>{inline(text(2))}</a></li>" for k in range(8)) + "</ul></nav>",
        lambda: f"<div class='ad-slot'><p>{inline(text(40))}</p></div>",
        lambda: f"<div id=cookieNotice>{inline(text(60))}<button>OK</button></div>",
        lambda: f"<aside><h3>More</h3><p>{inline(text(50))}</p></aside>",
        lambda: f"<form action='/s'><label>{text(12)}</label><input name=q><textarea>{text(40)}</textarea></form>",
        lambda: f"<script>var a = '<p>{'x' * 300}</p>';</script><style>p {{ color: red }}</style><!-- <p>{text(50)}</p> -->",
        lambda: f"<div class=\"sidebar right\"><p>{inline(text(70))}</p></div>",
    ]
    blocks, body = [], []
    title = text(5)
    blocks.append(title)
    body.append(f"<h1>{inline(title)}</h1>")
    for _ in range(rng.randrange(3, 9)):
        t = text(rng.choice([1, 3, 30, 80]))
        blocks.append(t)
        body.append(rng.choice(["<p>{}</p>", "<p>{}", "<blockquote>{}</blockquote>"]).format(inline(t)))
        if rng.random() < 0.3:
            body.append(rng.choice(rest)())
    top = "".join(rng.choice(rest)() for _ in range(3))
    end = "".join(rng.choice(rest)() for _ in range(2))
    comments = f"<section id='comments'><h2>2 comments</h2><article><p>{inline(text(60))}</p></article></section>"
    page = (f"<!DOCTYPE html><html><head><title>{text(6)}</title></head><body class='has-sidebar'><header><h2>Site</h2>"
            f"<p>{inline(text(30))}</p></header>{top}{article[0]}{''.join(body)}{article[1]}{end}{comments}"
            f"<footer>&copy; {text(30)}</footer>" + rng.choice(["</body></html>", ""]))
    return page, " ".join(blocks)


@pytest.mark.parametrize("article", [
    ("<article>", "</article>"), ("<main><article class='post'>", "</article></main>"), ("<main id='main'>", "</main>"),
    ("<div class='layout'><div class='entry-content'>", "</div></div>"), ("<div itemprop=articleBody>", "</div>"),
    ("<form id='whole'><div id='content'>", "</div></form>")])
def test_made_pages(article):
    rng = random.Random(str(article))
    for _ in range(60):
        page, want = made_page(rng, article)
        assert " ".join(main_text.main_lines(page)) == want


def test_unmarked_pages_surge_and_dive():
    """Without any mark the distribution alone finds the text."""
    prose = "A long paragraph of text that goes on for quite a while. "
    page = ("<div><a href=/>Home</a></div><div>Menu</div><div>Log in</div><h1>The title</h1><p>" + prose * 3 + "</p><p>Be.</p>"
            "<p>" + prose + "</p><p>The end.</p><h3>More</h3><ul><li><a href=/x>" + prose + "</a></li></ul><div>2024</div>")
    assert main_text.main_lines(page) == ["The title", (prose * 3).strip(), "Be.", prose.strip(), "The end."]
    assert main_text.spans([0, 0, 5, 90, 30, 0, 0, 0, 100, 0, 0]) == [(2, 5), (8, 9)]
    assert main_text.spans([0, 9, 0]) == [(1, 2)] and main_text.spans([]) == [] and main_text.spans([0]) == []


def test_odd_pages(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 50_000 + "</article>"
    pages = [(1, None, None), (2, "u", ""), (3, "u", "just text"), (4, "u", "<p>a<br>b</p><p>&lt;p&gt;&amp;amp;</p>"), (5, "u", long),
             (5, "u", long), (None, "u", "<article>x</article>"), (6, "u", "<nav><li>m<article>t</article>"),
             (7, "u", "<p>one<p>two<a href='x"), (8, "u", "a < b && c &copy d<e"), (9, "u", "<script>x"), (10, "u", "<!-- x")]
    df = with_clashes(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {}
    for r in main_text.extract_pages(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert got == {1: [""], 2: [""], 3: ["just text"], 4: ["a b <p>&amp;"], 5: [" ".join(["word & word"] * 50_000)] * 2,
                   None: ["x"], 6: ["t"], 7: ["one two"], 8: ["a < b && c © d"], 9: [""], 10: [""]}
    assert main_text.extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<b><p>", "<a href='", "<div class=ad>", "<ul><li>", "<!--", '<x y="', "<span class=ad><li>",
                                   "<", "<title>", "</p>", "<td>", "&amp"])
def test_work_grows_with_the_page(piece):
    import time

    def took(n):
        t = time.perf_counter()
        main_text.main_lines(piece * n)
        return time.perf_counter() - t

    assert min(took(40_000) for _ in range(2)) < 16 * min(took(10_000) for _ in range(3)) + 0.2


def test_noise_is_gumbel(spark):
    x = [r[0] / 1000 for r in spark.range(4000).select(importance.gumbel("id")).collect()]
    assert abs(sum(x) / len(x) - 0.5772) < 0.08 and abs(sorted(x)[2000] + math.log(math.log(2))) < 0.08
