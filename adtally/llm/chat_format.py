"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role
become one block, and the blocks are concatenated:

    <|im_start|>ROLE newline TEXT [<|im_sep|>TEXT ...]<|im_end|> newline

Texts and roles are escaped reversibly: a backslash more goes between ``<`` and ``|`` wherever
they stand together or with backslashes between, so no text can hold a control string; a
newline in a role becomes ``<|nl|>``. ``<|im_sep|>`` keeps merged turns apart, so the output
can be read back turn by turn. The loss mask is a list of spans (start, length; code points)
over the formatted string, one for each text of an assistant turn.

Defined results: null role, null text: empty; turns of equal number are ordered by role and
text; repeated rows are turns of their own; a null turn sorts first; rows with null conv_id form
one conversation. One conversation is one output string, so its rows meet in one task; groups
are never larger than a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from rows (conv_id, turn, role, text)."""
    role = F.replace(escape(F.coalesce(F.col("role").cast("string"), F.lit(""))), F.lit("\n"), F.lit(NEWLINE))
    text = escape(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # where a run of turns with one role begins; the next begin (or the end) closes it
    runs = sorted_turns.withColumn("begins", F.filter(
        F.sequence(F.lit(0), F.size("ts") - 1),
        lambda i: (i == 0) | (F.get(F.col("ts"), i)["role"] != F.get(F.col("ts"), i - 1)["role"])))
    blocks = runs.withColumn("blocks", F.transform("begins", lambda b, k: F.struct(
        F.get(F.col("ts"), b)["role"].alias("role"),
        F.transform(F.slice(F.col("ts"), b + 1, F.coalesce(F.get(F.col("begins"), k + 1), F.size("ts")) - b),
                    lambda t: t["text"]).alias("texts"))))
    strings = blocks.select("conv_id", "blocks", F.transform("blocks", lambda b: F.concat(
        F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], SEP), F.lit(END + "\n"))).alias("strings"))
    # running start of each block, then of each text inside the blocks of the learned role
    empty = F.array().cast("array<long>")
    ends = F.aggregate("strings", F.struct(F.lit(0).cast("long").alias("at"), empty.alias("starts")),
                       lambda acc, s: F.struct((acc["at"] + F.length(s)).alias("at"),
                                               F.array_append(acc["starts"], acc["at"]).alias("starts")),
                       lambda acc: acc["starts"])
    placed = strings.select("conv_id", "blocks", F.array_join("strings", "").alias("formatted"), ends.alias("starts"))

    def spans(block: Column, start: Column) -> Column:
        first = start + F.lit(len(START) + 1) + F.length(block["role"])
        return F.aggregate(
            block["texts"],
            F.struct(first.cast("long").alias("at"), F.array().cast("array<struct<start:long,len:long>>").alias("out")),
            lambda acc, t: F.struct(
                (acc["at"] + F.length(t) + len(SEP)).alias("at"),
                F.array_append(acc["out"], F.struct(acc["at"].alias("start"), F.length(t).cast("long").alias("len"))).alias("out")),
            lambda acc: acc["out"])

    none = F.array().cast("array<struct<start:long,len:long>>")
    return placed.select("conv_id", "formatted", F.flatten(F.zip_with(
        "blocks", "starts", lambda b, s: F.when(b["role"] == LEARNED_ROLE, spans(b, s)).otherwise(none))).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text), one for each turn, parsed from a formatted string."""
    def turns(segment: Column) -> Column:
        role = F.substring_index(segment, "\n", 1)
        body = F.substring(F.substring_index(segment, END, 1), F.length(role) + 2, F.length(segment))
        return F.transform(F.split(body, r"<\|im_sep\|>", -1), lambda t: F.struct(
            unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n"))).alias("role"), unescape(t).alias("text")))

    segments = F.split(formatted, r"<\|im_start\|>", -1)
    return F.flatten(F.transform(F.slice(segments, F.lit(2), F.size(segments) - 1), turns))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["len"].cast("int")))), "")
