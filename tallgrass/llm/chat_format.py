"""Chat formatting: a finite-state machine over roles, and a declarative template with loss flags.

All of it is DataFrame operations. A template names, for every turn, what is written around the role
and the text, which roles are trained on, and which role may follow which.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Control strings around a turn; ``moves`` are the state machine's ``(state, role, next state)``.

    Every control string starts with a letter of ``escapes``; in texts those letters are written as
    their escapes, so no control string, of this or a similar template, is left in a text.
    """

    begin: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    escapes: tuple[tuple[str, str], ...] = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "told"), ("start", "user", "asked"), ("told", "user", "asked"),
        ("asked", "assistant", "answered"), ("answered", "user", "asked"),
    )
    final: tuple[str, ...] = field(default=("answered",))


def escape(text: Column, template: Template) -> Column:
    for letter, code in template.escapes:
        text = F.replace(text, F.lit(letter), F.lit(code))
    return text


def unescape(text: Column, template: Template) -> Column:
    for letter, code in reversed(template.escapes):
        text = F.replace(text, F.lit(code), F.lit(letter))
    return text


def _role(text: Column, template: Template) -> Column:
    """A role may hold anything too; a line break in it would end the role."""
    return F.replace(escape(text, template), F.lit("\n"), F.lit("&NewLine;"))


def _role_back(text: Column, template: Template) -> Column:
    return unescape(F.replace(text, F.lit("&NewLine;"), F.lit("\n")), template)


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``(conv_id, formatted, segments, valid, stopped_at)``: one row per conversation.

    ``turns`` has ``conv_id, turn, role, text`` and may have other columns. ``segments`` is an array of
    ``(text, loss)``, and ``formatted`` their texts one after another. ``valid`` says whether the state
    machine accepts the roles in turn order; ``stopped_at`` is the index of the first turn it refuses
    (null without one). A refused conversation is formatted all the same, with its flag.

    Turns are ordered by ``turn``, then role and text; null turns first. A null text or role is empty;
    repeated turns all stay; null ``conv_id`` is a conversation of its own; no turns, no rows. The turns
    of a conversation come together in one row, as its output does; text is escaped before that, turn by
    turn.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    row = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("plain"),
            F.concat(F.lit(template.begin), _role(role, template), F.lit(template.after_role)).alias("head"),
            escape(text, template).alias("body"),
        ).alias("t"),
    )
    chats = row.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    moves = F.create_map(*[F.lit(x) for state, role_, nxt in template.moves for x in (f"{state}|{role_}", nxt)])
    start = F.struct(F.lit("start").alias("state"), F.lit(None).cast("int").alias("stopped"), F.lit(0).alias("n"))

    def step(s: Column, t: Column) -> Column:
        nxt = F.coalesce(F.try_element_at(moves, F.concat(s["state"], F.lit("|"), t["role"])), F.lit("refused"))
        stopped = F.when(s["stopped"].isNull() & (nxt == "refused"), s["n"]).otherwise(s["stopped"])
        return F.struct(nxt.alias("state"), stopped.alias("stopped"), (s["n"] + 1).alias("n"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    parts = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(t["head"], F.lit(False)),
                segment(t["body"], t["role"].isin(*template.trained)),
                segment(F.lit(template.end), F.lit(False)),
            ),
        )
    )
    done = chats.select("conv_id", parts.alias("segments"), F.aggregate("turns", start, step).alias("machine"))
    return done.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments",
        (F.col("machine.stopped").isNull() & F.col("machine.state").isin(*template.final)).alias("valid"),
        F.col("machine.stopped").alias("stopped_at"),
    )


def read_back(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """The turns ``(role, text)`` and the trained text, from the output of ``format_chats`` alone."""
    ended = F.split("formatted", _literal(template.end))
    pieces = F.slice(ended, 1, F.size(ended) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(len(template.begin) + 1))
        at = F.locate(template.after_role, inner)
        return F.struct(
            _role_back(F.substr(inner, F.lit(1), at - 1), template).alias("role"),
            unescape(F.substr(inner, at + len(template.after_role)), template).alias("text"),
        )

    trained = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    return chats.withColumn("turns", F.transform(pieces, turn)).withColumn("trained", F.array_join(trained, ""))


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"
