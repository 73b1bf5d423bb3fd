"""Quality rules: a threshold table compiled into one Spark projection.

``metrics`` builds the counts of a text as plain column expressions,
``THRESHOLDS`` is the rule table (a rule is a metric, a side and a bound), and
``apply_rules`` compiles any such table into one projection.  Nothing but
built-in functions is evaluated.

Stop words: prose of any language written in words has short function words,
so a word of up to three letters counts beside those of the list; a text with
neither is a list, a table or noise.

Defined results: a null, empty or all-blank text has no words, so every count
is 0 and the text fails the base rule; ratios over zero words or lines are
null and a null ratio passes its rule.  Rows are judged one by one, so ties,
repeated rows and null ids keep one result each; an empty table gives an empty
result.  Extra columns are ignored (``apply_rules``) or kept as they are
(``keep_good``), whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Frequent function words of English, German, French, Spanish.
STOP_WORDS = (
    "the of and to a in that is was he for it with as his on be at by i this had not are but from or have an they "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "le la les de du et un une en que qui dans pour par sur pas plus ce se au il sont avec "
    "el los las y del por con una su para no al lo como más o pero sus"
).split()


@dataclass(frozen=True)
class Threshold:
    """A rule: the metric must be at least ``low`` and at most ``high``."""

    metric: str
    low: float | None = None
    high: float | None = None


#: The production table.
THRESHOLDS = (
    Threshold("mean_word_chars", low=2.0, high=16.0),
    Threshold("symbol_ratio", high=0.10),
    Threshold("separator_ratio", high=0.10),
    Threshold("shout_ratio", high=0.10),
    Threshold("stop_ratio", low=0.02),
    Threshold("dup_line_ratio", high=0.50),
    Threshold("repeat_ratio", high=0.30),
)

#: Base rule: at least so many words, at most this share of repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text.

    The windows are sorted with their positions, equal neighbours give the
    repeated positions, and each position adds the words that the next one
    does not cover: O(n log n) for any length.  Texts whose windows are all
    distinct (a hash set tells) skip the sort.
    """
    def of(w: Column) -> Column:
        window = lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i), F.get(w, i + 1))
        return F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(1), F.size(w) - 2), window)).otherwise(
            F.array().cast("array<string>"))

    return _let(words, of)


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once, wherever the optimizer moves the expression."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _positions(pairs: Column) -> Column:
    def of(p: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(p, j)["w"] == x["w"], F.lit(False))
        return F.transform(p, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))

    return F.sort_array(F.array_compact(_let(pairs, of)))


def _covered(at: Column) -> Column:
    def of(a: Column) -> Column:
        return F.transform(a, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(a, k + 1) - p, F.lit(3))))

    return F.aggregate(_let(at, of), F.lit(0).cast("long"), lambda a, b: a + b)


def metrics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and the counts and ratios of every whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    cols = [f"k{i}" for i in range(len(keep))]
    step = df.select(*kept, t.alias("t")).select(*cols, "t", common.words(F.col("t")).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = step.select(
        *cols, "t", "w", _repeat_words(F.col("w")).alias("g"),
        F.when(F.instr("t", "\n") > 0, lines).otherwise(F.array().cast("array<string>")).alias("l"),
    )
    pairs = F.sort_array(F.transform("g", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    none = F.array().cast("array<struct<w:string,i:int>>")
    step = step.select(
        *cols, "t", "w", "l",
        F.when(F.size(F.array_distinct("g")) < F.size("g"), pairs).otherwise(none).alias("p"),
    )
    step = step.select(*cols, "t", "w", "l", _positions(F.col("p")).alias("at"))
    count = lambda c: F.size(c).cast("long")
    step = step.select(
        *cols,
        count("w").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (count("l") - count(F.array_distinct("l"))).alias("n_dup_lines"),
        _covered(F.col("at")).alias("n_repeat_words"),
        F.greatest(count("l"), F.when(F.size("w") > 0, 1).otherwise(0)).cast("long").alias("n_lines"),
        count(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS) | (F.length(x) <= 3) & x.rlike(r"^\p{L}+$"))).alias(
            "n_stop_words"),
        F.length(F.regexp_replace("t", r"[^|]+", "")).cast("long").alias("n_separators"),
        F.regexp_count("t", F.lit("!!")).cast("long").alias("n_shouts"),
    )
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return step.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("n_separators", "n_words").alias("separator_ratio"),
        ratio("n_shouts", "n_words").alias("shout_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)


def compile_rules(rules: tuple[Threshold, ...] = THRESHOLDS) -> list[Column]:
    """One boolean column per rule, true where the rule is broken."""
    out = []
    for r in rules:
        m, broken = F.col(r.metric), F.lit(False)
        if r.low is not None:
            broken = broken | (m < r.low)
        if r.high is not None:
            broken = broken | (m > r.high)
        out.append(F.coalesce(broken, F.lit(False)).alias(f"{r.metric}_broken"))
    return out


def apply_rules(df: DataFrame, id_col: str = "doc_id", text: str = "text",
                rules: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """id, counts, ratios, the names of the broken rules, ``base_failed``, ``kept``."""
    m = metrics(df, text, (id_col,))
    broken = F.array_compact(F.array(*(F.when(c, F.lit(r.metric)) for r, c in zip(rules, compile_rules(rules)))))
    step = m.select("*", base_failed().alias("base_failed"), broken.alias("broken_rules"))
    return step.select("*", (~F.col("base_failed") & (F.size("broken_rules") == 0)).alias("kept"))


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """The rows of ``df`` that pass, with the columns of ``df``."""
    m = metrics(df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
                          F.col(text).alias("text")), "text", ("row",))
    bad = base_failed()
    for c in compile_rules(rules):
        bad = bad | c
    # a filter is moved below deterministic projections, which would compute every metric once
    # more per use; the row number keeps it here
    judged = m.select("row", (~bad).alias("good"), F.monotonically_increasing_id().alias("n"))
    return judged.filter("good and n >= 0").select("row.*")
