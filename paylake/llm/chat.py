"""Chat formatting.

Method: relational formatting with Spark expressions only. The turns of a
conversation are collected as structs and sorted, adjacent turns of the same role
are merged with array expressions, and the result is concatenated.

Template: ``<|role:R|>`` opens a block of turns of one role, ``<|sep|>`` stands between
the merged turns of a block, and ``<|end|>`` closes it. All control strings begin with
``<|``; inside texts and roles ``\\`` is written ``\\\\`` and ``<|`` is written ``\\l|``, so that
no escaped text holds ``<|`` (in roles ``|>`` is written ``|\\g`` as well). Reading back
splits at ``<|`` and undoes the escapes from left to right, so any text survives.

Scale: one shuffle, by conversation; every expression is linear in the turns.
A conversation is one output row and has to fit into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(out, F.lit("<|"), F.lit("\\l|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("|>"), F.lit("|\\g"))


def unescape(text: Column) -> Column:
    """Undoes :func:`escape` and :func:`escape_role`."""
    # Splitting at the pair of backslashes first makes what is left unambiguous.
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))
    return F.array_join(plain, "\\")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Rows ``(<conv_col>, formatted)``, one for each conversation.

    - turns are ordered by turn number (null last), then role, then text, so ties and
      repeated rows have one order; repeated rows all stay;
    - a null text or role is empty; a null conversation id is one conversation;
    - other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).isNull().alias("late"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    sorted_turns = rows.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("late", "turn", "role", "body"))).alias("turns"))
    # A block opens where the role differs from the turn before.
    first = F.filter(F.sequence(F.lit(1), F.size("turns")),
                     lambda i: (i == 1) | (F.element_at("turns", i)["role"]
                                           != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    blocks = sorted_turns.withColumn("first", first)
    merged = F.transform("first", lambda i, k: F.struct(
        F.element_at("turns", i)["role"].alias("role"),
        F.transform(F.slice("turns", i, F.coalesce(F.get("first", k + 1), F.size("turns") + 1) - i),
                    lambda t: t["body"]).alias("texts")))
    blocks = blocks.select("conv", merged.alias("blocks"))
    shown = F.transform("blocks", lambda b: F.concat(
        F.lit("<|role:"), escape_role(b["role"]), F.lit("|>"),
        F.array_join(F.transform(b["texts"], escape), "<|sep|>"), F.lit("<|end|>")))
    return blocks.select(F.col("conv").alias(conv_col), F.array_join(shown, "").alias("formatted"))


def read_back(formatted: DataFrame, column: str = "formatted") -> DataFrame:
    """Adds ``turns`` (an array of role and text structs, one for each original turn)
    read from the formatted text alone. Null text: no turns."""
    blocks = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), r"<\|end\|>", -1), lambda b: b != "")
    cut = F.transform(blocks, lambda b: F.struct(
        unescape(F.substring_index(F.substring_index(b, "|>", 1), "<|role:", -1)).alias("role"),
        F.split(F.substr(b, F.instr(b, F.lit("|>")) + 2), r"<\|sep\|>", -1).alias("texts")))
    turns = F.flatten(F.transform(cut, lambda b: F.transform(
        b["texts"], lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text")))))
    return formatted.withColumn("turns", turns)


def loss_text(turns: Column, role: str = ASSISTANT) -> Column:
    """All text under the loss mask: the texts of the trained role, in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == role), lambda t: t["text"]), "")
