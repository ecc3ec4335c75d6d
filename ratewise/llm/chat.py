"""Chat formatting with Spark expressions only.

A conversation becomes one string. Adjacent turns of one role share a block, in which the turns stay
apart, so that formatting can be undone exactly:

    <|im_start|>user<|im_sep|>first text<|im_next|>second text<|im_end|>\\n

Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``; no control string can then
arise within a text or across its ends, and one pass that drops the escaping backslashes undoes it.

Defined results: rows sort by (turn, role, text), nulls first, and repeated rows all stay; a null role
or text is the empty string; a null conv_id is a conversation of its own; an empty table gives no
rows; other columns are ignored. Memory: one conversation at a time, as its text is one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _quoted(control: str) -> str:
    return rf"\Q{control}\E"


def format_chat(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans) per conversation.

    ``loss_spans``: array of (start, chars), 0-based code points of ``formatted`` that carry loss:
    the texts of ``loss_role``, without any control string."""
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    t = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))

    def piece(x, i):
        turns = F.col("t")
        first = (i == 0) | (F.get(turns, i - 1)["role"] != x["role"])
        last = (i == F.size(turns) - 1) | (F.get(turns, i + 1)["role"] != x["role"])
        return F.struct(
            F.when(first, F.concat(F.lit(START), escape(x["role"]), F.lit(SEP))).otherwise(NEXT).alias("head"),
            escape(x["text"]).alias("body"), F.when(last, END).otherwise("").alias("tail"),
            (x["role"] == loss_role).alias("loss"))

    t = t.select("conv_id", F.transform("t", piece).alias("p"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,chars:int>>").alias("spans"))

    def add(acc, p):
        at, chars = acc["at"] + F.length(p["head"]), F.length(p["body"])
        span = F.array(F.struct(at.alias("start"), chars.alias("chars")))
        return F.struct((at + chars + F.length(p["tail"])).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return t.select(
        "conv_id",
        F.array_join(F.transform("p", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.aggregate("p", start, add, lambda acc: acc["spans"]).alias("loss_spans"))


def parse_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text, block), block counted from 0."""
    def turns(block, i):
        parts = F.split(F.substr(block, F.lit(len(START) + 1)), _quoted(SEP), -1)
        texts = F.split(F.get(parts, F.lit(1)), _quoted(NEXT), -1)
        return F.transform(texts, lambda x: F.struct(unescape(F.get(parts, F.lit(0))).alias("role"),
                                                     unescape(x).alias("text"), i.alias("block")))

    blocks = F.filter(F.split(formatted, _quoted(END), -1), lambda b: b.startswith(START))
    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["chars"]))), "")


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Digest columns, read back from ``format_chat``'s output alone."""
    d = formatted.select("conv_id", "formatted", parse_chat(F.col("formatted")).alias("t"),
                         loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return d.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.coalesce(F.array_max(F.transform("t", lambda x: x["block"])) + 1, F.lit(0)).cast("long").alias("n_blocks"))
