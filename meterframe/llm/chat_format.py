r"""Conversations rendered as chat text, checked by reading them back.

A turn is ``<|im_start|>role\ntext<|im_end|>\n``.  The reader knows one grammar:
cut at each end mark, expect a start mark in front and nowhere else, take the
role up to the first line end, then undo the escapes.  A turn is first written
as it is; if the reader does not give back the same turn, it is written with
escapes, and the same holds once more for the whole conversation.

Escapes put one more backslash between ``<`` and ``|``, behind those that are
there, and the reader takes one away, so any text survives and an escaped text
holds no mark.  In a role, ``%`` and line ends are written ``%25`` and ``%0A``.

Only built-in expressions are used.  Null roles and texts count as empty, rows
with a null ``conv_id`` are one conversation, and turns with the same number
follow each other by role and text; a repeated row is a turn of its own.  A
conversation is one sample and therefore one row: its rows meet in one task.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def as_it_is(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def with_escapes(role: Column, text: Column) -> Column:
    return as_it_is(escaped_role(role), escaped(text))


def rendered_turns(formatted: Column) -> Column:
    """The turns as they stand in the text, without their end marks."""
    return F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p != "")


def read_turn(piece: Column) -> Column:
    """struct(role, text), or null if the piece is no turn of the grammar."""
    body = F.substr(piece, F.lit(len(START) + 1))
    role = F.substring_index(body, "\n", 1)
    good = piece.startswith(START) & ~body.contains(START) & ~body.contains("<|im_end|>") & body.contains("\n")
    turn = F.struct(
        unescaped_role(role).alias("role"),
        unescaped(F.substr(body, F.length(role) + 2)).alias("text"),
    )
    return F.when(good, turn)


def read(formatted: Column) -> Column:
    """The turns of a formatted conversation; null where they do not parse."""
    return F.transform(rendered_turns(formatted), read_turn)


def turn_that_reads_back(role: Column, text: Column) -> Column:
    plain = as_it_is(role, text)
    same = F.array(F.struct(role.alias("role"), text.alias("text")))
    return F.when(read(plain) == same, plain).otherwise(with_escapes(role, text))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id``, ``formatted`` and ``loss``, the places of
    assistant texts: turn (from 0), start and length within the rendered turn,
    in code points."""
    turns = rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("rendered", turn_that_reads_back(F.col("role"), F.col("text")))
    talks = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("t"))
    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = F.array_join("t.rendered", "")
    return (
        talks.withColumns({"source": source, "first": first})
        .withColumn(
            "formatted",
            F.when(read(F.col("first")) == F.col("source"), F.col("first")).otherwise(
                F.array_join(F.transform("t", lambda t: with_escapes(t["role"], t["text"])), "")
            ),
        )
        .select("conv_id", "formatted", loss_places(F.col("formatted")).alias("loss"))
    )


def loss_places(formatted: Column) -> Column:
    """Assistant texts, as (turn, start, length)."""

    def place(piece: Column, turn: Column) -> Column:
        start = F.length(F.substring_index(piece, "\n", 1)) + 1
        mine = unescaped_role(F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)) == ASSISTANT
        return F.struct(turn.alias("turn"), start.alias("start"), (F.length(piece) - start).alias("length"), mine.alias("mine"))

    marked = F.filter(F.transform(rendered_turns(formatted), place), lambda p: p["mine"])
    return F.transform(marked, lambda p: p.dropFields("mine"))


def digest(talks: DataFrame) -> DataFrame:
    """What the formatted texts give when read back."""
    said = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under_mask = F.transform(
        "loss", lambda p: unescaped(F.substr(F.get(F.col("pieces"), p["turn"]), p["start"] + 1, p["length"]))
    )
    return (
        talks.withColumns({"turns": read(F.col("formatted")), "pieces": rendered_turns(F.col("formatted"))})
        .withColumn("lost", F.array_join(under_mask, ""))
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("lost").cast("bigint").alias("loss_chars"),
            F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
        )
    )
