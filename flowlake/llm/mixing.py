"""Temperature mixing of sources to target weights, as budgeted block permutations.

Weights: a source's share of all tokens is raised to an exponent and
normalised; 1 keeps the natural shares, 0 makes all sources equal.  The
exponent is bisected: the largest one whose weights reach the target entropy
(a share of the greatest possible), then raised, again by bisection, as far
as needed so that no source repeats more than ``max_repeats`` times.  A pass
over the per-source totals evaluates all midpoints of the next five bisection
steps at once, as sums, so no list of sources reaches the driver.

Realisation: a source's token budget is its weight times the total budget.
Its documents are dealt into blocks of about ``block_tokens`` tokens, or
``BLOCK_ROWS`` rows where texts are short, by a hash of id and content, and
every epoch reads the blocks in a new pseudo-random order.  Whole epochs read
everything; the last one stops before the document that would pass the
budget.  The running token offset of a block comes from two levels of sums
(groups of about sqrt(n) blocks, then blocks), so no window holds more than
about sqrt(n) rows, and a source, a null id or a repeated id with a third of
all rows is spread over blocks (rows with one id and one text share theirs).  ``position`` (share of the source's budget read before the document)
merges the sources: sorted by it, every stretch has the target weights.

Defined results: a null source is a source of its own; a null id hashes like
the text ``null``, a null text like an empty one; a document without words costs nothing and is read with its
block; a source without words has no weight and is left out; repeated rows
are separate documents, ties in order are broken by id; an empty table gives
an empty mixture; extra columns are carried only as the ``payload`` column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Production parameters.
TARGET_ENTROPY, MAX_REPEATS, BLOCK_TOKENS, BLOCK_ROWS, SEED = 0.95, 4.0, 20_000, 1_000, 42
_STEPS, _LEVELS, _DIGITS = 8, 5, 6


def _hash(*parts) -> Column:
    """60 bits of md5 over the parts joined by ':', as a long >= 0."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _evaluate(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(entropy, sum of powers) of the weights at each exponent."""
    grid = F.explode(F.array(*map(F.lit, exponents))).alias("a")
    power = F.pow("share", "a")
    rows = shares.select("share", grid).groupBy("a").agg(
        F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("s")).collect()
    told = {r.a: (math.log(r.z) - r.a * r.s / r.z, r.z) for r in rows}
    return [told[a] for a in exponents]


def _bisect(shares: DataFrame, low: float, high: float, right) -> float:
    """Bisect for the boundary between ``right(exponent, entropy, z)`` false (below) and true (above)."""
    for _ in range(_STEPS):
        n = 1 << _LEVELS
        grid = [low + (high - low) * k / n for k in range(1, n)]
        told = [right(a, *v) for a, v in zip(grid, _evaluate(shares, grid))]
        i, j = 0, n
        while j - i > 1:  # the bisection steps that this pass has answered
            k = (i + j) // 2
            i, j = (i, k) if told[k - 1] else (k, j)
        low, high = low + (high - low) * i / n, low + (high - low) * j / n
    return (low + high) / 2


def exponent(totals: DataFrame, budget: float | None = None, target_entropy: float | None = TARGET_ENTROPY,
             max_repeats: float | None = MAX_REPEATS) -> float:
    """The mixing exponent for per-source ``tokens``, to six digits; 1.0 if there is nothing to mix."""
    totals = totals.filter("tokens > 0")
    n, total, least = totals.agg(F.count(F.lit(1)), F.sum("tokens"), F.min("tokens")).first()
    if not n or n == 1:
        return 1.0
    shares = totals.select((F.col("tokens") / F.lit(float(total))).alias("share"))
    a = 1.0
    if target_entropy is not None:
        goal = target_entropy * math.log(n)
        if _evaluate(shares, [1.0])[0][0] < goal:
            a = _bisect(shares, 0.0, 1.0, lambda _, h, z: h < goal)
    if max_repeats is not None:
        scale, small = (budget or total) / total, least / total
        over = lambda x, z: scale * small ** (x - 1) / z > max_repeats
        if over(a, _evaluate(shares, [a])[0][1]) and scale <= max_repeats:
            a = _bisect(shares, a, 1.0, lambda x, h, z: not over(x, z))
    return round(a, _DIGITS)


def weights(totals: DataFrame, budget: int | None = None, target_entropy: float | None = TARGET_ENTROPY,
            max_repeats: float | None = MAX_REPEATS) -> DataFrame:
    """(source, tokens, weight, budget) of every source with tokens."""
    totals = totals.filter("tokens > 0")
    budget = budget or totals.agg(F.sum("tokens")).first()[0] or 0
    a = exponent(totals, budget, target_entropy, max_repeats)
    n = float(totals.agg(F.sum("tokens")).first()[0] or 1)
    power = F.pow(F.col("tokens") / F.lit(n), F.lit(a))
    z = float(totals.agg(F.sum(power)).first()[0] or 1.0)
    return totals.select("source", "tokens", F.round(power / F.lit(z), 9).alias("weight")).withColumn(
        "budget", F.floor(F.col("weight") * F.lit(float(budget))).cast("long"))


def _offsets(blocks: DataFrame) -> DataFrame:
    """Running token sum before each block in the order of its epoch, by two levels."""
    key = ["source", "epoch"]
    groups = F.ceil(F.sqrt(F.col("n_blocks"))).cast("long")
    b = blocks.withColumn("order", _hash(F.lit(SEED), F.col("epoch"), F.col("source"), F.col("block")))
    b = b.withColumn("part", F.pmod(F.shiftright("order", 20), groups))
    parts = b.groupBy(*key, "part").agg(F.sum("block_tokens").alias("part_tokens"))
    w = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*(F.col(c).alias(f"{c}_p") for c in (*key, "part")),
                         F.coalesce(F.sum("part_tokens").over(w), F.lit(0)).alias("before"))
    inner = Window.partitionBy(*key, "part").orderBy("order", "block").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("within", F.coalesce(F.sum("block_tokens").over(inner), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("source_p")) & (F.col("epoch") == F.col("epoch_p")) & (
        F.col("part") == F.col("part_p"))
    return b.join(parts, same).withColumn("start", F.col("before") + F.col("within"))


def mixture(df: DataFrame, id_col: str = "doc_id", source: str = "source", tokens: Column | None = None,
            payload: Column | None = None, budget: int | None = None, target_entropy: float | None = TARGET_ENTROPY,
            max_repeats: float | None = MAX_REPEATS, block_tokens: int = BLOCK_TOKENS,
            block_rows: int = BLOCK_ROWS, content: Column | None = None) -> DataFrame:
    """The documents to read: id, source, epoch, block, n_tokens, stream_offset, weight, position[, payload].

    ``tokens`` counts a document's tokens (default: words of ``text``);
    ``content`` tells documents with one id apart (default: ``text``, or the
    whole row where there is none); the budget defaults to all tokens.  One
    row per document and epoch that reads it.
    """
    if content is None:
        content = F.col("text") if "text" in df.columns else F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    content = F.md5(F.coalesce(content.cast("string"), F.lit("")))
    tokens = F.size(common.words(F.col("text"))) if tokens is None else tokens
    cols = [F.col(id_col).alias("id"), F.col(source).cast("string").alias("source"),
            F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens"), _hash(F.lit(SEED), F.col(id_col), content).alias("h")]
    docs = df.select(*cols, *([payload.alias("payload")] if payload is not None else []))
    if payload is None:
        docs = common.written(docs, "tokens")
    slim = docs.drop("payload")
    totals = common.written(slim.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "totals")
    sizes = totals.select(F.col("source").alias("sized"), "rows")
    mix = weights(totals, budget, target_entropy, max_repeats)
    mix = mix.join(sizes, F.col("source").eqNullSafe(F.col("sized")))
    mix = common.written(mix.select(
        F.col("source").alias("name"), "tokens", "weight", "budget",
        F.ceil(F.greatest(F.col("tokens") / block_tokens, F.col("rows") / block_rows)).cast("long").alias("n_blocks"),
        F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("full"),
        (F.col("budget") % F.col("tokens")).alias("rest")), "weights")
    dealt = docs.join(mix.select("name", "n_blocks"), F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "block", F.pmod("h", "n_blocks")).drop("name")
    blocks = dealt.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"),
                                                  F.first("n_blocks").alias("n_blocks"))
    blocks = blocks.join(mix.drop("n_blocks"), F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("full"))))
    blocks = _offsets(blocks).withColumn(
        "limit", F.when(F.col("epoch") < F.col("full"), F.col("tokens")).otherwise(F.col("rest")))
    blocks = blocks.filter("start <= limit and limit > 0").select(
        F.col("source").alias("s"), F.col("block").alias("b"), "epoch", "start", "limit", "weight", "budget",
        F.col("tokens").alias("source_tokens"))
    rows = dealt.drop("n_blocks").join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    w = Window.partitionBy("source", "block", "epoch").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("offset", F.col("start") + F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))
    rows = rows.filter(F.col("offset") + F.col("n_tokens") <= F.col("limit"))
    stream = F.col("offset") + F.col("epoch") * F.col("source_tokens")
    return rows.select(
        F.col("id").alias(id_col), "source", "epoch", "block", "n_tokens", stream.alias("stream_offset"), "weight",
        F.round(stream / F.col("budget"), 9).alias("position"), *(["payload"] if payload is not None else []))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The mixture as rows of ``df``, one per reading."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    tokens = F.size(common.words(F.col(text)))
    return mixture(df, id_col, source, tokens, row, content=F.col(text), **how).select("payload.*")
