"""Chat formatting by Spark expressions alone: turns in order, adjacent turns of a role merged, texts escaped, a loss mask.

A conversation is ``<s>`` and its blocks. A block holds adjacent turns of one role, with ``[NEXT]`` between their texts:

* ``[SYS] text [/SYS]``, ``[INST] text [/INST]`` and `` text</s>`` for system, user and assistant,
* ``[ROLE]name[TEXT]text[/ROLE]`` for any other role.

In a text each of these marks gets a backslash behind its bracket, and one that already has some there gets one more;
so no text holds a mark, and taking one backslash away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, NEXT = "<s>", "[NEXT]"
#: What opens and closes a block.
BLOCKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
ROLE, TEXT, END = "[ROLE]", "[TEXT]", "[/ROLE]"
#: The role whose texts the loss is taken of.
TAUGHT = "assistant"
#: The marks: a bracket, backslashes if it is escaped, the rest.
MARKS = r"([<\[])(\\*)(/?s>|/?SYS\]|/?INST\]|/?ROLE\]|TEXT\]|NEXT\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?SYS\]|/?INST\]|/?ROLE\]|TEXT\]|NEXT\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, MARKS, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _opening(role: Column) -> Column:
    out = F.concat(F.lit(ROLE), escaped(role), F.lit(TEXT))
    for name, (opening, _) in BLOCKS.items():
        out = F.when(role == name, opening).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit(END)
    for name, (_, closing) in BLOCKS.items():
        out = F.when(role == name, closing).otherwise(out)
    return out


def merged_turns(conversations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``conv_id, blocks array<struct<role, texts array<string>>>``: turns by their number, adjacent ones of a role together.

    Null roles and texts are empty; a null turn is the first; equal turns go by role, then text; repeated rows are
    turns of their own; rows with a null conv_id are one conversation.
    """
    keys = keys or ["conv_id"]
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = conversations.groupBy(*keys).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    role = lambda i: F.col("turns")[i]["role"]
    begun = ordered.withColumn("begins", F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (role(i) != role(F.greatest(i - 1, F.lit(0))))))

    def block(first: Column, k: Column) -> Column:
        after = F.coalesce(F.try_element_at("begins", k + 2), F.size("turns"))
        return F.struct(role(first).alias("role"), F.slice("turns", first + 1, after - first)["text"].alias("texts"))

    return begun.select(*keys, F.transform("begins", block).alias("blocks"))


def format_chats(conversations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``conv_id, formatted, segments array<struct<piece, loss>>`` of every conversation.

    The pieces, one after the other, are the formatted text; ``loss`` marks those that are learned, each the escaped
    text of one turn of the assistant. No conversations, no rows. What it reads is ``conv_id, turn, role, text``.
    """
    keys = keys or ["conv_id"]

    def segment(piece: Column, loss: Column) -> Column:
        return F.struct(piece.alias("piece"), loss.alias("loss"))

    no = F.lit(False)

    def of_block(block: Column) -> Column:
        learned = block["role"] == TAUGHT
        texts = F.transform(block["texts"], lambda text, i: F.when(i == 0, F.array(segment(escaped(text), learned))).otherwise(F.array(segment(F.lit(NEXT), no), segment(escaped(text), learned))))
        return F.concat(F.array(segment(_opening(block["role"]), no)), F.flatten(texts), F.array(segment(_closing(block["role"]), no)))

    pieces = merged_turns(conversations, keys).select(*keys, F.concat(F.array(segment(F.lit(BEGIN), no)), F.flatten(F.transform("blocks", of_block))).alias("segments"))
    return pieces.select(*keys, F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"), "segments")


def turns_of(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted conversation, as its rows had them."""
    ends = [closing.strip() for _, closing in BLOCKS.values()] + [END]
    quoted = "|".join(e.replace("[", r"\[").replace("]", r"\]") for e in ends)
    blocks = F.filter(F.split(F.substr(formatted, F.lit(len(BEGIN) + 1)), f"(?<={quoted})", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        head = F.substr(block, F.lit(len(ROLE) + 1), F.instr(block, TEXT) - len(ROLE) - 1)
        role, inner = unescaped(head), F.substr(block, F.instr(block, TEXT) + len(TEXT), F.char_length(block) - F.instr(block, TEXT) - len(TEXT) + 1 - len(END))
        for name, (opening, closing) in BLOCKS.items():
            its = F.endswith(block, F.lit(closing))
            role = F.when(its, name).otherwise(role)
            inner = F.when(its, F.substr(block, F.lit(len(opening) + 1), F.char_length(block) - len(opening) - len(closing))).otherwise(inner)
        return F.transform(F.split(inner, r"\[NEXT\]", -1), lambda text: F.struct(role.alias("role"), unescaped(text).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learned_text(segments: Column) -> Column:
    """All that is under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["piece"])), "")


def summary(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` read back from what :func:`format_chats` returns."""
    read = formatted.select("conv_id", "formatted", turns_of(F.col("formatted")).alias("turns"), learned_text(F.col("segments")).alias("learned"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
