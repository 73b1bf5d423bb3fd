"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing extra columns."""

import pytest
from pyspark.sql import functions as F

from flowlake.llm import (bpe, chat, common, language_id, language_model, licenses, mixing, quality, simhash,
                          url_rules, vectors)

LONG = "une longue phrase de mots qui revient toujours " * 4000
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and of the house", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, LONG, "fr", "b"),
    (5, " \n\t ", "en", "a"),
    (6, "The quick brown fox jumps over the lazy dog and of the house", "en", "a"),
    (6, "The quick brown fox jumps over the lazy dog and of the house", "en", "a"),
    (None, "1234 !!! 5678", "de", "b"),
    (7, "Released under the MIT License.", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    # extra columns with the names that operators use inside and return
    for c in ("n_words", "fp", "id", "row", "h", "c", "kept", "n_tokens", "score", "block", "payload", "w"):
        df = df.withColumn(c, F.lit(1))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_quality(docs, none):
    out = quality.apply_rules(docs)
    got = {r.doc_id: r for r in out.collect() if r.doc_id not in (None, 6)}
    assert out.count() == len(DOCS)
    assert [got[i].n_words for i in (1, 2, 3, 4, 5)] == [13, 0, 0, 32000, 0]
    assert got[4].n_repeat_words == 32000 and got[4].base_failed and not got[4].kept
    assert quality.apply_rules(none).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 0  # every text is short or repeats itself


def test_quality_lines_and_windows(spark):
    text = "a b c a b c\nx\n\nx\n x\nx"
    r = quality.metrics(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    # windows: abc bca cab abc bcx cxx xxx xxx; abc covers 1-3 and 4-6, xxx covers 7-10
    assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (10, 10, 2)


def test_simhash(docs, none):
    got = rows(simhash.near_duplicates(docs), "doc_id", "component_id", "kept")
    by_id = {}
    for i, c, k in got:
        by_id.setdefault(i, []).append((c, k))
    assert by_id[6] == [(1, False)] * 2 and by_id[1] == [(1, True)]
    assert [by_id[i][0][0] for i in (2, 3, 5)] == [2, 2, 2]
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == rows(docs.filter("doc_id in (1, 2, 4, 7) or doc_id is null"), "doc_id")
    assert simhash.keep_one(none).count() == 0


def test_mixing(docs, none):
    out = mixing.mixture(docs, target_entropy=0.99, block_tokens=5)
    assert out.filter("source is null").count() == 0  # no words, no weight
    spent = {r.source: (r.n, r.b) for r in out.groupBy("source").agg(
        F.sum("n_tokens").alias("n"), F.max(F.col("weight")).alias("b")).collect()}
    total = 32000 + 3 + 13 * 3 + 5
    assert all(n <= b * total for n, b in spent.values())
    assert out.groupBy("source").agg(F.max("epoch").alias("e")).filter("e > 4").count() == 0
    again = mixing.mixture(docs, target_entropy=0.99, block_tokens=5)
    cols = ("doc_id", "source", "epoch", "block", "stream_offset")
    assert rows(out, *cols) == rows(again, *cols)
    assert mixing.mixture(none).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_mixing_meets_entropy_and_repeats(spark):
    totals = spark.createDataFrame([("a", 9000), ("b", 900), ("c", 100)], "source string, tokens long")
    import math

    a = mixing.exponent(totals, target_entropy=0.8, max_repeats=None)
    shares = [0.9, 0.09, 0.01]
    z = sum(s ** a for s in shares)
    h = -sum(s ** a / z * math.log(s ** a / z) for s in shares)
    assert abs(h / math.log(3) - 0.8) < 1e-4
    b = mixing.exponent(totals, 10000, target_entropy=1.0, max_repeats=5.0)
    z = sum(s ** b for s in shares)
    assert abs(max(s ** (b - 1) / z for s in shares) - 5.0) < 1e-3


def test_url_rules(spark):
    pages = spark.createDataFrame([
        (1, "HTTP://WWW.Example.NET/en/x?y#z"), (2, "http://example.net"), (3, None), (4, "no scheme"),
        (5, "https://a.example.com/de/"), (6, "https://a.example.com/dex"), (7, "ftp://x.org/fr/a"),
        (8, "http://notexample.net/en/"), (8, "http://notexample.net/en/"), (None, "http://x.y/")],
        "page_id long, url string").withColumn("tokens", F.lit(1)).withColumn("verdict", F.lit("x"))
    labels = spark.createDataFrame([(None, None, None), (1, None, None)], "doc_id long, quality int, toxic int")
    mined = url_rules.mine(url_rules.labelled_pages(pages, labels))
    assert mined.count() == 0
    got = rows(url_rules.judge(pages, mined), "page_id", "host", "path", "rule", "verdict")
    assert (1, "www.example.net", "/en/x", "example.net/en/", "allow") in got
    assert (2, "example.net", "", None, "allow") in got  # an empty path does not start with /
    assert (3, "", "", None, "allow") in got and (4, "", "", None, "allow") in got
    assert (5, "a.example.com", "/de/", "example.com/de/", "block") in got
    assert (6, "a.example.com", "/dex", None, "allow") in got
    assert (7, "x.org", "/fr/a", "org/fr/", "allow") in got
    assert got.count((8, "notexample.net", "/en/", "net/", "block")) == 2
    assert url_rules.judge(pages.limit(0), mined).count() == 0


def test_url_rules_are_mined(spark):
    urls = [(f"http://bad.example.com/casino/{i}", 1) for i in range(40)]
    urls += [(f"http://good.example.com/news/{i}", 0) for i in range(60)]
    urls += [(f"http://good.example.com/casino/{i}", 0) for i in range(30)]
    mined = url_rules.mine(spark.createDataFrame(urls, "url string, bad int"))
    names = {tuple(r.antecedent) for r in mined.collect()}
    assert ("host=bad.example.com",) in names and ("label=bad",) in names
    assert ("step=casino",) not in names  # 40 of 70
    assert all(len(n) == 1 for n in names)  # pairs with a part that is a rule are pruned
    pages = spark.createDataFrame([(1, "http://bad.example.com/x"), (2, "http://good.example.com/casino/x")],
                                  "page_id long, url string")
    assert rows(url_rules.judge(pages, mined), "page_id", "verdict") == [(1, "block"), (2, "allow")]


def test_chat_round_trip(spark):
    part = lambda kind, text=None, ref=None, **k: (kind, text, ref, k.get("width"), k.get("height"),
                                                   k.get("seconds"), k.get("pages"))
    data = [
        (1, 0, "user", [part("text", "see </s>[INST] & &lt; <|end|>\n"), part("image", None, "i.png", width=56, height=29),
                        part("audio", None, "a.wav", seconds=1.5), part("text", "ok")], 1),
        (1, 1, "assistant", [part("text", "<|turn|>user\nhi <|image|>"), None, part("document", None, "d.pdf", pages=2)], 1),
        (1, 2, "assistant", None, 1), (1, 2, "assistant", None, 1), (1, 3, None, [part("odd", None, "z")], 1),
        (None, None, "a\nb", [part("text", None)], 1),
    ]
    df = spark.createDataFrame(
        data, f"conv_id long, turn long, role string, content {chat.PARTS}, formatted int")
    out = chat.format_conversations(df)
    got = {r.conv_id: r for r in out.select(
        "*", chat.read_turns(F.col("formatted")).alias("t"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    r = got[1]
    assert r.n_turns == 5 and r.loss == "<|turn|>user\nhi <|image|>"
    assert [(t.role, t.text) for t in r.t] == [
        ("user", "see </s>[INST] & &lt; <|end|>\nok"), ("assistant", "<|turn|>user\nhi <|image|>"),
        ("assistant", ""), ("assistant", ""), ("", "")]
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [
        ("image", "i.png", 4), ("audio", "a.wav", 38), ("document", "d.pdf", 2048), ("odd", "z", 0)]
    assert r.expanded_tokens == 2090 and "[INST]" not in r.formatted and "</s>" not in r.formatted
    assert [(t.role, t.text) for t in got[None].t] == [("a\nb", "")]
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_language_model(docs, none):
    got = rows(language_model.score(docs), "doc_id", "n_tokens", "held_out")
    assert (2, 1, language_model.held_out(2)) in got and (3, 1, language_model.held_out(3)) in got
    assert (4, 32001, language_model.held_out(4)) in got and (None, 4, False) in got
    assert len(got) == len(DOCS)
    assert language_model.score(none).count() == 0


def test_language_id(docs, none):
    model = language_id.learn(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (None, 2, 3, 5))
    assert got[1].lang_pred in ("en", "fr") and 0 <= got[1].score <= 1
    assert language_id.identify(none, model).count() == 0
    assert language_id.learn(none) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    one = language_id.train([("xx", "abc")])
    assert {(r.lang_pred, r.score) for r in language_id.identify(docs.filter("doc_id = 1"), one).collect()} == {("xx", 1)}
    assert language_id.keep_known(docs, model).columns == docs.columns


def test_bpe(docs, none, spark):
    out = docs.select("doc_id", "text", bpe.encode(F.col("text")).alias("ids"))
    out = out.select("*", bpe.decode(F.col("ids")).alias("back"))
    assert all(r.back == (r.text or "") and (bool(r.ids) == bool(r.text)) for r in out.collect())
    assert none.select(bpe.encode(F.col("text"))).count() == 0


def test_licenses(docs, none, spark):
    assert rows(licenses.scan_documents(docs), "doc_id", "template", "n_missing") == [(7, "MIT notice", 0)]
    assert licenses.scan_documents(none).count() == 0
    text = ("intro " * 500) + licenses.TEMPLATES["MIT text"].replace("free of charge", "free of any charge") + " end " * 9
    found = licenses.scan(text)
    assert [(f["template"], f["n_missing"], f["n_extra"], f["difference"]) for f in found] == [("MIT text", 0, 1, "+any")]
    assert text[found[0]["start"]:found[0]["end"]].startswith("Permission is hereby")
    assert licenses.scan("I lost my license and all rights were reserved.") == []


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]),
            (7, [nan, 1.0]), (8, [1.0, None]), (9, [inf, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [0.0, 3.0]), (11, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    for c in ("v", "c", "row", "component_id", "key", "pass"):
        df = df.withColumn(c, F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert got[4] == (1, 4, True) and got[None] == (1, 4, False)
    assert all(got[i] == (0, i, True) for i in (5, 6, 7, 8, 9, 10, 11))
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_written_can_be_discarded(spark):
    df = common.written(spark.range(3), "x")
    assert df.count() == 3
    common.discard(df)
    with pytest.raises(Exception):
        df.sparkSession.read.parquet(df._flowlake_path).count()


def test_url_rules_of_three_tokens_and_deep_paths(spark):
    """A class that only three tokens together tell, and one marked by its sixth path word and fifth key."""
    def page(a, b, c, n):
        return f"https://h{n}.example.org/{'x' if a else 'p'}{'' if a else n}/{'y' if b else 'q'}/{'z' if c else 'r'}/{n}"

    urls = [(page(a, b, c, n), int(a and b and c)) for n in range(12) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    deep = "http://d{}.example.org/a/b/c/d/e/{}?k1=1&k2=2&k3=3&k4=4&{}=5"
    urls += [(deep.format(n, "bad" if n < 6 else "good", "k5"), int(n < 6)) for n in range(12)]
    urls += [(deep.format(n, "fine", "worse" if n < 6 else "better"), int(n < 6)) for n in range(12)]
    mined = url_rules.mine(spark.createDataFrame(urls, "url string, bad int"))
    names = {tuple(r.antecedent) for r in mined.collect()}
    assert ("step=bad",) in names and ("key=worse",) in names and ("step=x", "step=y", "step=z") in names
    assert not any(set(a) < set(b) for a in names for b in names)  # no rule holds another one
    pages = spark.createDataFrame([(1, page(1, 1, 1, 77)), (2, page(1, 1, 0, 77)), (3, deep.format(7, "bad", "k5")),
                                   (4, deep.format(7, "good", "k5")), (5, "http://x.org/" + "w/" * 5000 + "bad")],
                                  "page_id long, url string")
    got = dict(rows(url_rules.judge(pages, mined), "page_id", "verdict"))
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "block"}


def test_url_rules_combine_every_token(spark):
    """Two path words tell the class together, but thirteen other tokens of their URLs tell more alone."""
    keys = "&".join(f"k{i}=1" for i in range(13))
    urls = [(f"https://h{n}.example.org/x/y/{n}?{keys}", 1) for n in range(40)]
    urls += [(f"https://g{n}.example.org/{n}?{keys}", 0) for n in range(20)]
    urls += [(f"https://{step}{n}.example.org/{step}/{n}", 0) for n in range(40) for step in "xy"]
    # steps of one deep path come together: 60 tokens, but one set of URLs
    urls += [(f"https://d{n}.example.org/" + "".join(f"s{chr(97 + i // 26)}{chr(97 + i % 26)}/" for i in range(60)), n % 2)
             for n in range(12)]
    mined = url_rules.mine(spark.createDataFrame(urls, "url string, bad int"))
    names = {tuple(r.antecedent) for r in mined.collect()}
    assert {("step=x", "step=y"), ("key=k0", "step=x"), ("key=k12", "step=y")} <= names
    pages = spark.createDataFrame([(1, "http://new.org/x/y/"), (2, "http://new.org/x/z/"), (3, "http://new.org/y/")],
                                  "page_id long, url string")
    got = dict(rows(url_rules.judge(pages, mined), "page_id", "verdict"))
    assert got == {1: "block", 2: "allow", 3: "allow"}


def test_url_rules_need_more_than_chance(spark):
    """Labels that say nothing about the URL give no rules; a seed word labels its host."""
    import random

    def made(seed):
        rng = random.Random(seed)
        return [(i, f"http://h{rng.randrange(40)}.example.com/{rng.choice('abcdef')}/{i}", int(rng.random() > 0.25))
                for i in range(600)]

    found = 0
    for seed in (4, 5, 6, 7):
        noise = spark.createDataFrame(made(seed), "page_id long, url string, quality int")
        pages = noise.select("page_id", "url")
        labels = noise.select(F.col("page_id").alias("doc_id"), "quality", F.lit(0).alias("toxic"))
        found += url_rules.mine(url_rules.labelled_pages(pages, labels)).count()
    assert found <= 4 * url_rules.CHANCE
    spam = pages.union(spark.createDataFrame([(1000 + i, f"http://m.casino-{i % 2}.example.com/lucky/{i}") for i in range(9)],
                                             pages.schema))
    mined = url_rules.mine(url_rules.labelled_pages(spam, labels))
    names = {tuple(r.antecedent) for r in mined.collect()}
    assert ("word=casino",) in names and ("step=lucky",) in names
    found = url_rules.judge(spam, mined).filter("mined is not null")
    assert found.count() == 9 and found.filter("page_id < 1000").count() == 0


def test_mixing_spreads_a_hot_id(spark):
    """A third of the rows have no id: no block holds much more than another."""
    df = spark.range(20000).selectExpr("if(id % 3 = 0, null, id) doc_id", "'s' source", "concat('w ', id) text")
    out = mixing.mixture(df, block_tokens=160)
    sizes = [r["count"] for r in out.filter("epoch = 0").groupBy("block").count().collect()]
    assert len(sizes) >= 240 and max(sizes) < 4 * 20000 / len(sizes)
    empty = spark.range(9000).selectExpr("id doc_id", "'s' source", "if(id = 0, 'word', '') text")
    sizes = [r["count"] for r in mixing.mixture(empty, block_rows=300).groupBy("block").count().collect()]
    assert len(sizes) == 30 and max(sizes) < 600  # many rows without words are dealt as well


def test_simhash_fans_out_over_all_tasks(spark):
    """The distinct fingerprints reach the fan-out in as many tasks as the session shuffles with."""
    df = spark.range(3000).select(F.xxhash64("id").alias("fp")).repartition(2).cache()
    plan = simhash.links(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(xxhash64(fp" in plan and "REPARTITION_BY_NUM" in plan
    parts = df.select("fp").distinct().repartition(common.shuffle_width(df), F.xxhash64("fp"))
    assert parts.select(F.spark_partition_id()).distinct().count() == common.shuffle_width(df)


def test_simhash_keeps_rows_with_maps(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "x y z"), (None, "x y z")], "doc_id long, text string")
    df = df.withColumn("m", F.create_map(F.lit("k"), "doc_id")).withColumn("l", F.array(F.create_map("text", "doc_id")))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


PROSE = {
    "pl": "Dawno temu w małej wsi nad rzeką mieszkał stary młynarz który miał trzech synów i jedną córkę a wszyscy "
          "pracowali od rana do nocy żeby zarobić na chleb bo czasy były ciężkie i nikt nie wiedział co przyniesie "
          "następny rok ale nigdy nie tracili nadziei że los się odmieni jeśli tylko będą razem i będą sobie pomagać w biedzie",
    "tr": "Bir zamanlar küçük bir köyde yaşlı bir değirmenci ve üç oğlu yaşarmış bu aile her gün sabahtan akşama kadar "
          "çalışır ama yine de zor geçinirmiş çünkü o yıl yağmur az yağmış ve tarlalar kurumuş fakat onlar umutlarını hiç "
          "kaybetmemiş birlikte oldukları sürece her şeyin daha iyi olacağına inanmış ve komşularına da yardım etmişler",
    "ru": "Давным давно в маленькой деревне у реки жил старый мельник и у него было три сына и одна дочь все они работали "
          "с утра до ночи чтобы заработать на хлеб потому что времена были тяжёлые и никто не знал что принесёт новый год "
          "но они не теряли надежды что всё будет хорошо если они будут вместе и станут помогать друг другу в беде",
}


@pytest.mark.parametrize("lang", sorted(PROSE))
def test_quality_keeps_prose_of_any_language(spark, lang):
    r = quality.apply_rules(spark.createDataFrame([(1, PROSE[lang])], "doc_id long, text string")).first()
    assert r.n_words >= 50 and r.kept, r.broken_rules
    noise = " ".join(f"{w}{k}#" for k, w in enumerate(PROSE[lang].split()))
    assert not quality.apply_rules(spark.createDataFrame([(1, noise)], "doc_id long, text string")).first().kept


def test_language_score_scales_with_the_languages():
    assert language_id.least_score({"langs": list("abcd")}) == 0.4 == language_id.least_score(None)
    assert language_id.least_score({"langs": list("ab")}) == 0.4
    assert language_id.least_score({"langs": list("abcdefghijklmnop")}) == 0.1
