"""Chat formatting of typed content parts.

A turn's content is an array of parts (``PART``). A visitor goes through the
parts in order: text is escaped and stands as it is, an image, an audio clip or
a document becomes one placeholder and is recorded as an attachment with its
reference, its place and the number of tokens it expands to (image: patches,
audio: frames, document: pages). The turns of a conversation are then laid out
in order between control strings, and the loss mask covers what assistants say.

Escaping is reversible: the characters that control strings begin with, and the
escape character itself, are each followed by a backslash in texts, so no
control string can arise from a text and removing those backslashes restores it.
All steps are DataFrame expressions and one shuffle by conversation. A formatted
conversation is one value, so its size is bounded by what a string can hold
(2 GB); that bound is the format's, not a cap.

Defined results: null texts and roles count as empty; null parts are skipped;
turns that tie are ordered by role and text; repeated rows are turns of their
own. A null conversation id is a conversation like others. An empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import pick

# the template's control strings; each begins with "<"
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "array<struct<turn:int,ordinal:int,type:string,ref:string,tokens:long,offset:long>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def text_part(text: Column) -> Column:
    """Content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def expanded_tokens(part: Column, patch: int, frames_per_second: float, tokens_per_page: int) -> Column:
    """Tokens that an attachment's placeholder expands to; at least 1, unknown measures count as 0."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    image = F.ceil(zero(part["width"]) / patch) * F.ceil(zero(part["height"]) / patch)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * frames_per_second)
    pages = zero(part["pages"]).cast("long") * tokens_per_page
    return F.greatest(F.lit(1).cast("long"), F.when(part["type"] == "image", image).when(part["type"] == "audio", audio).otherwise(pages).cast("long"))


def visit(parts: Column, patch: int = 14, frames_per_second: float = 25.0, tokens_per_page: int = 1024) -> Column:
    """Struct (text, attachments) of one turn's content; offsets count code points in ``text``."""
    item = "struct<ordinal:int,type:string,ref:string,tokens:long,offset:long>"
    start = F.struct(F.array().cast("array<string>").alias("pieces"), F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{item}>").alias("found"))

    def step(acc, p):
        mark = F.lit(None).cast("string")
        for kind, sign in PLACEHOLDERS.items():
            mark = F.when(p["type"] == kind, F.lit(sign)).otherwise(mark)
        piece = F.coalesce(mark, escape(p["text"]))
        one = F.struct(F.size(acc["found"]).alias("ordinal"), p["type"].alias("type"), p["ref"].alias("ref"),
                       expanded_tokens(p, patch, frames_per_second, tokens_per_page).alias("tokens"), acc["at"].alias("offset"))
        return F.struct(F.concat(acc["pieces"], F.array(piece)).alias("pieces"), (acc["at"] + F.length(piece)).alias("at"),
                        F.when(mark.isNotNull(), F.concat(acc["found"], F.array(one))).otherwise(acc["found"]).alias("found"))

    clean = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    return F.aggregate(clean, start, step, lambda acc: F.struct(F.array_join(acc["pieces"], "").alias("text"), acc["found"].alias("attachments")))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "content", *,
                 learn_role: str = "assistant", **measures) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens.

    ``content`` is a string or an array of parts. ``loss_spans`` are (start, end) in code points of
    ``formatted`` of what ``learn_role`` says; attachments carry their turn's index and such offsets.
    """
    rows = pick(turns, conv_id=conv, turn=turn, role=role, content=content)
    if dict(rows.dtypes)["content"] == "string":
        rows = rows.withColumn("content", text_part(F.col("content")))
    rows = rows.withColumn("role", F.coalesce("role", F.lit(""))).withColumn("v", visit(F.col("content"), **measures))
    packed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("v.text").alias("text"), F.col("v.attachments").alias("found")))).alias("turns"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("i"), F.array().cast("array<struct<start:long,end:long>>").alias("loss"),
                     F.array().cast(ATTACHMENT).alias("found"))

    def step(acc, t):
        begin = acc["at"] + len(TURN) + F.length(escape(t["role"])) + len(SAYS)
        end = begin + F.length(t["text"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        here = F.transform(t["found"], lambda a: F.struct(acc["i"].alias("turn"), a["ordinal"].alias("ordinal"), a["type"].alias("type"),
                                                          a["ref"].alias("ref"), a["tokens"].alias("tokens"), (a["offset"] + begin).alias("offset")))
        return F.struct((end + len(END)).alias("at"), (acc["i"] + 1).alias("i"),
                        F.when(t["role"] == learn_role, F.concat(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"),
                        F.concat(acc["found"], here).alias("found"))

    text = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS), t["text"], F.lit(END))), "")
    placed = packed.select("conv_id", text.alias("formatted"), F.aggregate("turns", start, step).alias("acc"))
    return placed.select("conv_id", "formatted", F.col("acc.loss").alias("loss_spans"), F.col("acc.found").alias("attachments"),
                         F.aggregate("acc.found", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation, unescaped."""
    pieces = F.split(formatted, r"<\|turn\|>", -1)
    body = F.slice(pieces, 2, F.greatest(F.lit(0), F.size(pieces) - 1))

    def turn(piece):
        pair = F.split(piece, r"<\|says\|>", 2)
        text = F.get(pair, 1)
        return F.struct(unescape(F.get(pair, 0)).alias("role"), unescape(F.substring(text, F.lit(1), F.length(text) - len(END))).alias("text"))

    return F.transform(body, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
