"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role merge into a block
by array aggregation; blocks are concatenated to one string:

    <|turn|>ROLE<|text|>TEXT[<|more|>TEXT]...<|end|>

``<|more|>`` parts the texts that were merged, so that every turn can be read back. Inside roles and texts a
backslash is doubled, and a backslash is put after the first character of each control string, which leaves no
control string there; ``unescape`` undoes both.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>"
#: Control strings of this template and of common others; none may stand in an escaped text.
CONTROLS = [TURN, TEXT, MORE, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>"]


def escape(text: Column, controls: list[str] = CONTROLS) -> Column:
    inside = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in controls)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), inside, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: the id, formatted.

    Turns go by (turn, role, text), null turns first, so ties and repeated rows have one order and all stay.
    Null roles and texts are empty. Rows of a null id form one conversation. A conversation is one string, so
    it has to fit in one row; the number of conversations is not bounded.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    chats = turns.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    escaped = F.transform("turns", lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    chats = chats.select("id", escaped.alias("turns"))
    # A turn opens a block, or goes on with that of the turn before it.
    opens = F.transform("turns", lambda t, i: F.when((i > 0) & (F.get("turns", i - 1)["role"] == t["role"]),
        F.concat(F.lit(MORE), t["text"])).otherwise(F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(TURN), t["role"], F.lit(TEXT), t["text"])))
    return chats.select(F.col("id").alias(id_col), F.concat(F.array_join(opens, ""), F.lit(END)).alias("formatted"))


def read_back(chats: DataFrame, id_col: str = "conv_id", loss_role: str = "assistant") -> DataFrame:
    """Parse ``formatted``: turns (role, text), and the loss mask as spans of code points over ``formatted``.

    Each loss span covers one escaped text of ``loss_role``.
    """
    blocks = F.filter(F.split("formatted", re.escape(TURN), -1), lambda b: b != "")
    parsed = F.transform(blocks, lambda b: F.struct(F.split_part(b, F.lit(TEXT), F.lit(1)).alias("role"),
        F.split(F.regexp_replace(F.substring_index(b, TEXT, -1), re.escape(END) + "$", ""), re.escape(MORE), -1).alias("texts")))
    chats = chats.select(id_col, "formatted", parsed.alias("blocks"))
    turns = F.flatten(F.transform("blocks",
        lambda b: F.transform(b["texts"], lambda t: F.struct(unescape(b["role"]).alias("role"), unescape(t).alias("text")))))
    width = F.lit(len(TURN) + len(TEXT) + len(END))
    size = lambda b: width + F.length(b["role"]) + F.aggregate(b["texts"], F.lit(0),
        lambda n, t: n + F.length(t)) + F.lit(len(MORE)) * (F.size(b["texts"]) - 1)
    start = F.aggregate("blocks", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<role:string,start:int,texts:array<string>>>").alias("out")),
        lambda acc, b: F.struct((acc["at"] + size(b)).alias("at"),
        F.concat(acc["out"], F.array(F.struct(b["role"].alias("role"), (acc["at"] + len(TURN) + F.length(b["role"]) + len(TEXT)).alias("start"), b["texts"].alias("texts")))).alias("out")))
    chats = chats.select(id_col, "formatted", turns.alias("turns"), F.filter(start["out"], lambda b: unescape(b["role"]) == loss_role).alias("masked"))
    spans = F.flatten(F.transform("masked",
        lambda b: F.transform(b["texts"],
        lambda t, i: F.struct((b["start"] + F.aggregate(F.slice(b["texts"], F.lit(1), i), F.lit(0), lambda n, x: n + F.length(x) + len(MORE))).alias("start"),
        F.length(t).alias("n")))))
    return chats.select(id_col, "formatted", "turns",
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (s["start"] + s["n"]).alias("end"))).alias("loss_spans"))
