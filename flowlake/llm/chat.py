"""Chat formatting: turns of typed content parts to one training string.

A turn's content is a list of parts (``PARTS``): text, image, audio, document.
A visitor flattens them in order: text is escaped, every other part becomes
the placeholder ``<|kind|>``, and its reference and expanded token count are
recorded in ``attachments``.  A turn is then
``<|turn|>`` role newline body ``<|end|>`` newline.

Escaping makes control strings impossible inside texts and is reversible:
``&`` -> ``&amp;``, ``<`` -> ``&lt;``, ``[`` -> ``&#91;`` and, in roles only,
newline -> ``&#10;``.  Every control string of this and of common templates
starts with ``<`` or ``[``, so none survives in a text.

The plan is one shuffle by conversation: escape and measure map-side, a
running window gives each turn its offset, one aggregation concatenates.  A
conversation is one output row, so its size is that of its own string.

Defined results: null text and null role are empty; null parts are skipped;
an unknown kind becomes ``<|file|>`` with no tokens; rows with a null
conversation id form one conversation with a null id; turns with equal number
are ordered by role, then body, and null turns come first; repeated rows are
repeated turns; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = ("array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>")

TURN, END = "<|turn|>", "<|end|>\n"
PLACEHOLDER = r"<\|(?:image|audio|document|file)\|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))

#: Expanded tokens: one per image patch of this side, per second of audio, per document page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 1024


def escape(c: Column, pairs=ESCAPES) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape(c: Column, pairs=ESCAPES) -> Column:
    for a, b in reversed(pairs):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def _placeholder(kind: Column) -> Column:
    known = F.when(kind.isin("image", "audio", "document"), kind).otherwise("file")
    return F.concat(F.lit("<|"), known, F.lit("|>"))


def _tokens(p: Column) -> Column:
    whole = lambda c: F.ceil(F.coalesce(c, F.lit(0))).cast("long")
    return (F.when(p["kind"] == "image", whole(p["width"] / PATCH) * whole(p["height"] / PATCH))
            .when(p["kind"] == "audio", whole(p["seconds"] * PER_SECOND))
            .when(p["kind"] == "document", F.coalesce(p["pages"], F.lit(0)).cast("long") * PER_PAGE)
            .otherwise(F.lit(0).cast("long")))


def visit(part: Column) -> Column:
    """The string of one part: escaped text or the placeholder."""
    return F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(
        _placeholder(F.coalesce(part["kind"], F.lit("file"))))


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         content: str = "content", learn: str = "assistant") -> DataFrame:
    """conv, n_turns, formatted, loss_spans, attachments, expanded_tokens.

    ``content`` is a column of type ``PARTS``; ``loss_spans`` are the code
    point ranges (start from 0, length) of the bodies of ``learn`` turns in
    ``formatted``; ``attachments`` lists the placeholders in order with kind,
    ref and tokens.
    """
    parts = F.filter(F.coalesce(F.col(content), F.array().cast(PARTS)), lambda p: p.isNotNull())
    rows = df.select(F.col(conv).alias("c"), F.col(turn).alias("n"),
                     F.coalesce(F.col(role), F.lit("")).alias("r"), parts.alias("p"))
    rows = rows.select(
        "c", "n", "r",
        F.concat(F.lit(TURN), escape(F.col("r"), ROLE_ESCAPES), F.lit("\n")).alias("head"),
        F.array_join(F.transform("p", visit), "").alias("body"),
        F.transform(F.filter("p", lambda p: ~F.coalesce(p["kind"] == "text", F.lit(False))),
                    lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), _tokens(p).alias("tokens"))
                    ).alias("a"),
    )
    size = F.length("head") + F.length("body") + len(END)
    order = Window.partitionBy("c").orderBy("n", "r", "body", "a")
    before = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size
    rows = rows.select("c", "r", "head", "body", "a", F.row_number().over(order).alias("i"), before.alias("at"))
    g = rows.groupBy("c").agg(F.sort_array(F.collect_list(F.struct(
        "i", F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(F.col("r") == learn, F.struct((F.col("at") + F.length("head")).cast("long").alias("start"),
                                             F.length("body").cast("long").alias("length"))).alias("span"),
        "a"))).alias("t"))
    return g.select(
        F.col("c").alias(conv),
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.col("t.piece"), "").alias("formatted"),
        F.array_compact(F.col("t.span")).alias("loss_spans"),
        F.flatten(F.col("t.a")).alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>> read back from a formatted string (texts without their placeholders)."""
    pieces = F.split(formatted, F.lit(END.replace("|", r"\|")), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        body = F.substr(p, F.length(head) + 2)
        return F.struct(unescape(F.substr(head, F.lit(len(TURN) + 1)), ROLE_ESCAPES).alias("role"),
                        unescape(F.regexp_replace(body, PLACEHOLDER, "")).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, cut from the formatted string."""
    cut = F.transform(spans, lambda s: unescape(F.regexp_replace(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")), PLACEHOLDER, "")))
    return F.array_join(cut, "")
