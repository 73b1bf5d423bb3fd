"""URL filters: explicit host/path rules, then mined association rules.

Explicit rules (``block net/``, ``allow example.net/en/``) fit a host, all its
subdomains and the paths that start with the rule's; the longest wins.

Mined rules: every labelled URL becomes a transaction of its URL tokens: all
host labels and their words, all path words, all query keys, the whole host,
scheme, file ending and flags.  The token combinations of any length that are
frequent among the bad ones are mined level by level: a combination of k + 1
tokens is tried if all its parts of k tokens are left, an inverted index counts
how many labelled URLs of either class hold it, and it is left out if one of
its parts matches the same URLs (the part then gives the same rule, shorter).
One becomes a block rule if it has enough support and confidence and chance
would not give it: the Chernoff bound of so many bad matches at the share of bad URLs,
times the number of different sets of URLs that the combinations match, stays
below ``CHANCE``.  A rule that contains another rule is pruned.  Matching uses the
same inverted index: each rule is filed under its rarest token, URLs are
exploded into tokens and meet only the rules filed under them.

Labels (``labelled_pages``): a URL whose host has a word of ``SEED_WORDS`` is
bad, any other has the label of the row with its number, if there is one.

Sizes: every frequent token of a URL is combined with every other, whatever
their number.  Tokens that always come together, or one only with another (the
steps of a deep path), give no combination beyond their pairs, so what is
counted follows the number of different sets of URLs that combinations match,
not the 2^k combinations of a URL with k tokens.  Far fewer become rules; the
planner decides by the table's real size whether it is broadcast.

Defined results: a null URL or one without ``://`` has empty host and path,
no rule and the verdict allow.  Verdicts are a function of the URL, so
repeated rows and null ids get one row each; missing or null labels, or none
that is bad, mean no mined rules; URLs of any length and depth are read whole;
extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: The contract's rules: (action, host suffix and path prefix).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Words of host names that mark gambling, adult, pharmacy, loan, advert and link-farm sites.
SEED_WORDS = (
    "adult ads adserver bet bets betting bingo casino casinos cialis doorway dating escort escorts forex gambling "
    "jackpot loan loans lottery payday pharma pharmacy pills poker porn roulette sex slots spam torrent track tracker "
    "tracking viagra warez webcam xxx"
).split()

#: Mining: share of the bad URLs, bad URLs at least, precision, expected rules by chance.
MIN_SUPPORT, MIN_MATCHES, MIN_CONFIDENCE, CHANCE = 0.005, 3, 0.8, 0.5

#: Tokens of a URL that the SQL of the query combines, which tries all 2^k; ``mine`` combines all.
COMBINED = 12


def host(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise("")
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")
    return F.coalesce(rest, F.lit(""))


def explicit_rule(h: Column, p: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct<action, rule>, or null."""
    out = None
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        suffix, _, prefix = rule.partition("/")
        fits = ((h == suffix) | h.endswith("." + suffix)) & p.startswith("/" + prefix)
        value = F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<action:string,rule:string>") if out is None else out


def host_words(h: Column) -> Column:
    """The runs of letters of a host name."""
    return F.array_remove(F.split(h, r"[^\p{L}]+"), "")


def tokens(url: Column) -> Column:
    """The distinct tokens of a whole URL, sorted."""
    h, p = host(url), path(url)
    named = lambda kind, c: F.concat(F.lit(kind), c)
    labels = F.array_remove(F.split(h, r"\."), "")
    steps = F.filter(F.split(p, "/"), lambda x: x.rlike(r"\p{L}"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.array_remove(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), "")
    ending = F.regexp_extract(p, r"\.([A-Za-z0-9]{1,5})$", 1)
    scheme = F.substring_index(F.coalesce(url, F.lit("")), "://", 1)
    flags = F.array(
        F.when(F.instr(url, "://") > 0, named("scheme=", F.lower(scheme))),
        F.when(ending != "", named("ending=", F.lower(ending))),
        F.when(F.instr(url, "#") > 0, F.lit("fragment")),
        F.when(h != "", named("host=", h)),
        F.when(p.endswith("/"), F.lit("folder")),
    )
    every = F.concat(F.transform(labels, lambda x: named("label=", x)),
                     F.transform(host_words(h), lambda x: named("word=", x)),
                     F.transform(steps, lambda x: named("step=", F.regexp_replace(x, "[0-9]+", "0"))),
                     F.transform(keys, lambda x: named("key=", x)), F.array_compact(flags))
    return F.when(F.instr(url, "://") > 0, F.array_sort(F.array_distinct(every))).otherwise(
        F.array().cast("array<string>"))


def _matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(key columns of urls, rule): the rules whose tokens all occur, by the inverted index."""
    keys = [c for c in urls.columns if c != "tokens"]
    posted = urls.select(*keys, "tokens", F.explode("tokens").alias("filed"))
    held = F.forall("antecedent", lambda x: F.array_contains("tokens", x))  # ends at the first that is missing
    return posted.join(rules, "filed").filter(held).drop("tokens", "filed")


def _log_chance(n: Column, b: Column, base: float) -> Column:
    """The logarithm of a bound of the probability of ``b`` bad ones or more among ``n``, above their share ``base``."""
    part = lambda share, of: F.when(share > 0, share * F.log(share / of)).otherwise(0.0)
    return -n * (part(b / n, base) + part(1 - b / n, 1 - base))


def _pairs(urls: DataFrame) -> DataFrame:
    """The pairs of tokens of bad URLs, as sorted antecedents."""
    later = F.transform("tokens", lambda x, i: F.struct(x.alias("t"), F.slice("tokens", i + 2, F.size("tokens")).alias("rest")))
    each = urls.filter("b > 0").select(F.explode(later).alias("x"))
    return each.select("x.t", F.explode("x.rest").alias("u")).distinct().select(F.array("t", "u").alias("antecedent"))


def _longer(sets: DataFrame, size: int) -> DataFrame:
    """The antecedents of ``size + 1`` tokens whose parts of ``size`` tokens are all among ``sets``."""
    head = sets.select(F.slice("antecedent", 1, size - 1).alias("head"), F.element_at("antecedent", -1).alias("last"))
    both = head.join(head.withColumnRenamed("last", "next"), "head").filter("last < next")
    tried = both.select(F.concat("head", F.array("last", "next")).alias("antecedent"))
    parts = tried.select("antecedent", F.explode(_parts(F.col("antecedent"))).alias("part"))
    held = parts.join(sets.select(F.col("antecedent").alias("part")), "part")
    return held.groupBy("antecedent").agg(F.count("*").alias("held")).filter(F.col("held") == size + 1).select("antecedent")


def _parts(antecedent: Column) -> Column:
    """The parts of an antecedent that miss one token."""
    return F.transform(antecedent, lambda x: F.array_remove(antecedent, x))


def _combinations(urls: DataFrame, single: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(antecedent, n_match, n_bad, matched) of the token combinations with ``least`` bad URLs or more of which no
    part matches the same URLs, and (antecedent, filed) with the rarest token of each.

    ``urls``: tokens, n, b, url_hash; ``single``: t, b of the frequent tokens, kept whatever they match."""
    counts = lambda tried: _matches(urls, tried).groupBy("antecedent").agg(
        F.sum("n").alias("n_match"), F.sum("b").alias("n_bad"), F.bit_xor("url_hash").alias("matched"))
    index = single.select(F.array("t").alias("antecedent"), F.col("t").alias("filed"))
    level = common.written(counts(index), "counted")
    levels, indexes = [level], [index]
    while True:
        size = len(levels)
        tried = _pairs(urls) if size == 1 else _longer(level, size)
        rare = tried.select("antecedent", F.explode("antecedent").alias("t")).join(single.select("t", "b"), "t")
        index = common.written(rare.groupBy("antecedent").agg(F.min(F.struct("b", "t")).alias("m"), F.count("*").alias("k")).filter(
            F.col("k") == size + 1).select("antecedent", F.col("m.t").alias("filed")), "itemsets")
        found = counts(index).filter(F.col("n_bad") >= least)
        parts = found.select("antecedent", F.explode(_parts(F.col("antecedent"))).alias("part"), "n_match", "n_bad", "matched")
        parts = parts.join(level.select(F.col("antecedent").alias("part"), F.col("n_match").alias("more")), "part")
        found = parts.groupBy("antecedent", "n_match", "n_bad", "matched").agg(F.min("more").alias("more"))
        level = common.written(found.filter("n_match < more").drop("more"), "counted")
        if level.isEmpty():
            return (reduce(DataFrame.union, levels), reduce(DataFrame.union, indexes))
        levels.append(level)
        indexes.append(index)


def mine(labelled: DataFrame, url: str = "url", bad: str = "bad", min_support: float = MIN_SUPPORT,
         min_matches: int = MIN_MATCHES, min_confidence: float = MIN_CONFIDENCE, chance: float = CHANCE) -> DataFrame:
    """(antecedent, filed, n_match, n_bad, confidence): the block rules mined from labelled URLs.

    Identical transactions are counted once with their numbers of either
    class before any join, so a URL that fills a third of the rows meets the
    rules once.
    """
    rows = labelled.filter(F.col(bad).isNotNull()).select(tokens(F.col(url)).alias("tokens"),
                                                          F.col(bad).cast("int").alias("bad"))
    groups = common.written(rows.filter(F.size("tokens") > 0).groupBy("tokens").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bad").alias("b")), "transactions")
    total, n_bad = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    least = max(1, min_matches, math.ceil(min_support * n_bad))
    single = groups.select(F.explode("tokens").alias("t"), "b").groupBy("t").agg(F.sum("b").alias("b"))
    single = common.written(single.filter(F.col("b") >= least), "tokens")

    # what a URL matches depends on its frequent tokens alone: transactions that share them are one from here on
    each = groups.select("tokens", "n", "b", F.explode("tokens").alias("t")).join(single.select("t"), "t")
    each = each.groupBy("tokens").agg(F.first("n").alias("n"), F.first("b").alias("b"),
                                      F.sort_array(F.collect_list("t")).alias("k"))
    urls = common.written(each.groupBy(F.col("k").alias("tokens")).agg(F.sum("n").alias("n"), F.sum("b").alias("b")).select(
        "*", F.xxhash64("tokens").alias("url_hash")), "frequent")
    counted, index = _combinations(urls, single, least)
    base, tried = n_bad / total if total else 0.0, counted.select("n_match", "n_bad", "matched").distinct().count()
    good = counted.join(index, "antecedent").withColumn("confidence", F.col("n_bad") / F.col("n_match")).filter(
        (F.col("n_bad") >= least) & (F.col("confidence") >= min_confidence))
    if 0 < base < 1:  # else there is nothing to tell apart, or nothing bad
        good = good.filter((F.col("confidence") > base) & (
            _log_chance(F.col("n_match"), F.col("n_bad"), base) < math.log(chance / max(1, tried))))
    good = common.written(good.select("antecedent", "filed", "n_match", "n_bad", "confidence"), "rules")
    # most larger rules hold a rule of one token; those left meet by the same index
    alone = good.filter(F.size("antecedent") == 1).select(F.col("antecedent")[0].alias("t"))
    larger = good.filter(F.size("antecedent") > 1).select(F.col("antecedent").alias("whole"), F.explode("antecedent").alias("t"))
    good = common.written(good.join(larger.join(alone, "t").select("whole").distinct(),
                                    F.col("antecedent") == F.col("whole"), "left_anti"), "rules")
    holds = _matches(good.select(F.col("antecedent").alias("whole"), F.col("antecedent").alias("tokens")),
                     good.select("antecedent", "filed"))
    implied = holds.filter(F.size("antecedent") < F.size("whole")).select("whole").distinct()
    return good.join(implied, F.col("antecedent") == F.col("whole"), "left_anti")


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
          explicit=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (the mined rule that blocks, if any)."""
    u = F.col(url)
    each = pages.select(F.col(page_id).alias("id"), u.alias("u"))
    urls = each.filter(F.instr("u", "://") > 0).select("u").distinct().select("u", tokens(F.col("u")).alias("tokens"))
    hit = _matches(urls, rules).groupBy("u").agg(
        F.max(F.struct("confidence", F.array_join("antecedent", " & ").alias("name"))).alias("best"))
    hit = hit.select(F.col("u").alias("hit"), F.col("best.name").alias("mined"))
    out = each.join(hit, F.col("u") == F.col("hit"), "left")
    out = out.select("id", host(F.col("u")).alias("host"), path(F.col("u")).alias("path"), "mined")
    out = out.select("*", explicit_rule(F.col("host"), F.col("path"), explicit).alias("e"))
    return out.select(
        F.col("id").alias(page_id), "host", "path", F.col("e.rule").alias("rule"),
        F.coalesce(F.col("e.action"), F.when(F.col("mined").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
        F.when(F.col("e").isNull(), F.col("mined")).alias("mined"),
    )


def labelled_pages(pages: DataFrame, labels: DataFrame, seeds=SEED_WORDS) -> DataFrame:
    """Pages with ``bad``: 1 if their host has a seed word, else whether the label of the same number says low
    quality or toxic; pages with neither are left out."""
    mark = ((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).cast("int")
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(mark).alias("bad"))
    each = pages.select("page_id", "url")
    seeded = F.coalesce(F.arrays_overlap(host_words(host(F.col("url"))), F.array(*map(F.lit, seeds))), F.lit(False))
    marked = each.filter(~seeded).join(marks, F.col("page_id") == F.col("doc_id")).select("url", "bad")
    return marked.union(each.filter(seeded).select("url", F.lit(1)))
