"""Chat formatting by prefix-target expansion: one example for each assistant turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's marks, the role whose turns are targets, and the escapes. Every control
# string of this template and of other common ones holds "<" or "[", so no text holds one after escaping.
OPEN = "<|turn|>"
CLOSE = "<|end|>\n"
TARGET_ROLE = "assistant"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))


def escaped(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes: tuple = ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def chat_examples(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, example, text, loss_start, loss_length, is_last``: one row per assistant turn.

    An example's text is all turns up to and with its reply, formatted; only the reply's own text,
    ``loss_length`` code points from 0-based ``loss_start``, is trainable. A conversation that ends
    otherwise has one more example, without trainable text, so that each one's last example holds
    it whole. Turns are ordered by number, role and text (null first), so repeated rows and ties are
    kept in a defined order; null roles and texts count as empty; a null conversation id is a
    conversation; an empty table gives no rows; other columns are ignored.

    One shuffle brings the turns of a conversation together. The example number is exploded, not
    the texts: each context is cut from the conversation's turns in the row that needs it, so a very
    long conversation is never held once for each of its replies.
    """
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("n"),
            F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    formatted = F.transform(
        F.col("turns"),
        lambda t: F.concat(
            F.lit(OPEN), escaped(t["role"], ROLE_ESCAPES), F.lit("\n"), escaped(t["text"]), F.lit(CLOSE)
        ),
    )
    count = F.size("turns")
    ends = F.filter(
        F.sequence(F.lit(1), count),
        lambda i: (F.element_at("turns", i)["role"] == TARGET_ROLE) | (i == count),
    )
    grouped = (
        rows.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select("conv_id", formatted.alias("parts"), F.transform("turns", lambda t: t["role"]).alias("roles"),
                ends.alias("ends"), count.alias("count"))
    )
    each = grouped.select("conv_id", "parts", "roles", "count", F.posexplode("ends").alias("example", "end"))
    reply = F.element_at("parts", F.col("end"))
    trainable = F.element_at("roles", F.col("end")) == TARGET_ROLE
    head = len(OPEN) + len(TARGET_ROLE) + 1
    whole = F.array_join(F.slice("parts", F.lit(1), F.col("end")), "")
    return each.select(
        "conv_id",
        "example",
        whole.alias("text"),
        F.when(trainable, F.length(whole) - F.length(reply) + head).otherwise(F.length(whole)).alias("loss_start"),
        F.when(trainable, F.length(reply) - head - len(CLOSE)).otherwise(0).alias("loss_length"),
        (F.col("end") == F.col("count")).alias("is_last"),
    )


def loss_text(text: Column, start: Column, length: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescaped(F.substring(text, start + 1, length))


def parsed_turns(text: Column) -> Column:
    """Array of ``role, text`` read back from a formatted text."""
    parts = F.slice(F.split(text, F.lit(r"<\|end\|>\n")), F.lit(1), F.size(F.split(text, F.lit(r"<\|end\|>\n"))) - 1)

    def turn(part: Column) -> Column:
        body = F.substring(part, len(OPEN) + 1, F.length(part))
        at = F.instr(body, "\n")
        return F.struct(
            unescaped(F.substring(body, F.lit(1), at - 1), ROLE_ESCAPES).alias("role"),
            unescaped(F.substring(body, at + 1, F.length(body))).alias("text"),
        )

    return F.transform(parts, turn)


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars``. Every example is reduced to its reply before the shuffle."""
    turns = parsed_turns(F.col("text"))
    plain = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    reduced = examples.select(
        "conv_id",
        "example",
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("reply"),
        F.length("text").cast("bigint").alias("chars"),
        F.when(F.col("is_last"), F.size(turns).cast("bigint")).alias("n"),
        F.when(F.col("is_last"), F.sha2(plain.cast("binary"), 256)).alias("sha"),
    )
    replies = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), ""
    )
    return (
        reduced.groupBy("conv_id")
        .agg(
            F.max("n").alias("n_turns"),
            F.max("sha").alias("turns_sha256"),
            replies.alias("loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("loss").cast("bigint").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
