"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all preceding turns are context, and only that reply carries
loss. What follows the last reply (or a conversation without reply) becomes one example without target, so that
the output holds every turn. The template writes a turn as ``### role: text</turn>`` and a line feed. Inside
roles and texts a backslash is written as backslash b, ``<`` as backslash l, ``#`` as backslash h, and in roles also ``:``
as backslash c; no control string can then occur in them, and undoing the codes gives the text back.

Null texts and null roles count as empty. Turns are ordered by (turn, role, text), null turns first; repeated
rows are turns of their own. Rows with null conversation id form one conversation. A conversation is one example's
unit, so its turns meet in one row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import col

OPEN, CLOSE = "### ", "</turn>\n"
TARGET_ROLE = "assistant"


def _replace(c: Column, what: str, by: str) -> Column:
    return F.replace(c, F.lit(what), F.lit(by))


def escape(c: Column) -> Column:
    return _replace(_replace(_replace(c, "\\", "\\b"), "<", "\\l"), "#", "\\h")


def unescape(c: Column) -> Column:
    return _replace(_replace(_replace(_replace(c, "\\l", "<"), "\\h", "#"), "\\c", ":"), "\\b", "\\")


def chat_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", target_role: str = TARGET_ROLE) -> DataFrame:
    """conv_id, example (from 1), text, loss_start and loss_end (code points; null without target), last (the longest example)."""
    empty = F.lit("")
    rows = turns.select(col(conv_col).alias("conv_id"), F.struct(
        col(turn_col).alias("turn"), F.coalesce(col(role_col), empty).alias("role"),
        F.coalesce(col(text_col), empty).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    head = lambda t: F.concat(F.lit(OPEN), _replace(escape(t["role"]), ":", "\\c"), F.lit(": "))
    convs = convs.withColumn("parts", F.transform("ts", lambda t: F.struct(
        (t["role"] == target_role).alias("target"), head(t).alias("head"), escape(t["text"]).alias("body"))))
    convs = convs.withColumn("whole", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), ""))
    # (start of the body, end of the body) of every turn, by running lengths.
    spans = F.aggregate(
        "parts", F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<target:boolean,start:int,end:int>>)").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).alias("at"),
            F.array_append(acc["spans"], F.struct(
                p["target"].alias("target"), (acc["at"] + F.length(p["head"])).alias("start"),
                (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end"))).alias("spans")),
        lambda acc: acc["spans"])
    convs = convs.select("conv_id", "whole", spans.alias("spans"))
    targets = F.filter("spans", lambda s: s["target"])
    rest = F.when(F.element_at("spans", -1)["target"], F.expr("array()")).otherwise(
        F.array(F.struct(F.lit(False).alias("target"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))))
    convs = convs.withColumn("cuts", F.concat(targets, rest.cast("array<struct<target:boolean,start:int,end:int>>")))
    out = convs.select("conv_id", "whole", F.size("cuts").alias("n"), F.posexplode("cuts").alias("example", "cut"))
    text = F.when(F.col("cut.target"), F.substring(F.col("whole"), F.lit(1), F.col("cut.end") + len(CLOSE))).otherwise(F.col("whole"))
    return out.select("conv_id", (F.col("example") + 1).alias("example"), text.alias("text"),
                      F.col("cut.start").alias("loss_start"), F.col("cut.end").alias("loss_end"),
                      (F.col("example") + 1 == F.col("n")).alias("last"))


def read_turns(text: Column) -> Column:
    """Array of (role, text) read back from a formatted example."""
    parts = F.split(text, CLOSE)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    role_end = lambda p: F.instr(p, ":")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring(p, F.lit(len(OPEN) + 1), role_end(p) - len(OPEN) - 1)).alias("role"),
        unescape(F.substring(p, role_end(p) + 2, F.length(p))).alias("text")))


def chat_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: turns and their digest, the text under loss, and sizes."""
    turns = F.when(F.col("last"), read_turns(F.col("text")))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    rows = examples.withColumn("turns", turns).select(
        "conv_id", "example", F.size("turns").cast("long").alias("n"), F.sha2(joined, 256).alias("sha"), loss.alias("loss"),
        F.length("text").cast("long").alias("chars"), "last")
    # The last example alone holds all turns; the others only add their reply.
    out = rows.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("n"))).alias("n_turns"), F.max(F.when(F.col("last"), F.col("sha"))).alias("turns_sha256"),
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
    text = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return out.select("conv_id", "n_turns", "turns_sha256", F.length(text).cast("long").alias("loss_chars"),
                      F.sha2(text, 256).alias("loss_sha256"), "formatted_chars", "n_examples")
