"""Chat formatting (operator 1): collected turn structs, sorted, merged and joined with Spark
expressions only.

Template: a block of adjacent turns of one role is ``<s>ROLE\\n`` + its texts
joined by ``<sep>`` + ``</s>``.  In roles and texts ``&`` becomes ``&amp;`` and
``<`` becomes ``&lt;`` (in roles a line feed becomes ``&#10;``), so no control
string can occur inside them, whatever the text holds, and unescaping gives
back the exact text.

Defined results: a null role or text is empty; a null conversation id is one
conversation; turns sort by (turn, role, text), null first, repeated rows stay;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, SEP, END = "<s>", "<sep>", "</s>"
LEARNED_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def format_chats(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length of every
    learned text in ``formatted``, code points, in order)."""
    rows = turns.select(
        "conv_id", F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # a block starts where the role changes; its texts are one slice of the sorted turns
    n = F.size("ts")
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (
        F.element_at("ts", i)["role"] != F.element_at("ts", F.greatest(i - 1, F.lit(1)))["role"]))
    convs = convs.withColumn("starts", starts)
    convs = convs.withColumn("blocks", F.transform("starts", lambda s, k: F.struct(
        F.element_at("ts", s)["role"].alias("role"),
        F.transform(F.slice("ts", s, F.coalesce(F.get("starts", k + 1), n + 1) - s),
                    lambda t: escape(t["text"])).alias("texts"))))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(BEGIN), _escape_role(b["role"]), F.lit("\n"), F.array_join(b["texts"], SEP), F.lit(END))), "")
    # spans: running position over the blocks, and over the texts inside a learned block
    span = "array<struct<start:int,length:int>>"
    empty = F.array().cast(span)

    def texts_of(b: Column, at: Column, known: Column) -> Column:
        return F.aggregate(
            b["texts"], F.struct(at.alias("at"), known.alias("spans")),
            lambda acc, t: F.struct((acc["at"] + F.length(t) + len(SEP)).alias("at"),
                                    F.concat(acc["spans"], F.array(F.struct(
                                        acc["at"].alias("start"), F.length(t).alias("length")))).alias("spans")),
            lambda acc: acc["spans"])

    def step(acc: Column, b: Column) -> Column:
        head = acc["at"] + F.length(_escape_role(b["role"])) + len(BEGIN) + 1
        body = F.aggregate(b["texts"], F.lit(-len(SEP)), lambda a, t: a + F.length(t) + len(SEP))
        return F.struct((head + body + len(END)).alias("at"),
                        F.when(b["role"] == learned_role, texts_of(b, head, acc["spans"]))
                        .otherwise(acc["spans"]).alias("spans"))

    loss = F.aggregate("blocks", F.struct(F.lit(0).alias("at"), empty.alias("spans")), step,
                       lambda acc: acc["spans"])
    return convs.select("conv_id", formatted.alias("formatted"), loss.alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (array of role and text, parsed from ``formatted``) and loss_text (what
    lies under the loss spans, unescaped)."""
    blocks = F.filter(F.split("formatted", END, -1), lambda b: b != "")
    turns = F.flatten(F.transform(blocks, lambda b: _turns_of(b)))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return chats.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_text"))


def _turns_of(block: Column) -> Column:
    head = F.substring_index(block, "\n", 1)
    role = _unescape_role(F.substring(head, F.lit(len(BEGIN) + 1), F.length(head)))
    body = F.substring(block, F.length(head) + 2, F.length(block))
    return F.transform(F.split(body, SEP, -1),
                       lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))
