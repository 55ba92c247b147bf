"""Chat formatting with SQL functions only: a state machine checks roles, a template emits segments.

A conversation is its rows by ``turn`` (ties by role, then text). A declarative template gives
each role its opening and closing mark and says whether its text is trained on. Every turn
becomes three segments: mark, escaped text, mark; each with a loss flag. Control strings inside
a text get a backslash after their first character, and backslashes are doubled, so no text can
open or close a turn and ``unescape`` restores it exactly.

Defined cases: a null text is empty; a null role is the empty role; roles that the template
does not name are written out between marks of their own and make the order invalid; null
conversation ids form one conversation; repeated rows are turns of their own; an empty table
gives no rows; other columns are ignored. A conversation is one value of the result (its digest
runs over all of it in order), so it has to fit into a task; nothing else is held together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RoleMarks:
    role: str
    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """``moves`` maps (state, role) to the next state; anything else is an error at that turn."""

    marks: tuple[RoleMarks, ...]
    moves: dict[tuple[str, str], str]
    start: str
    final: tuple[str, ...]
    other: RoleMarks = RoleMarks("", "<|turn|>", "<|end|>")
    between: str = "<|text|>"
    foreign: tuple[str, ...] = field(default=())

    def control_strings(self) -> list[str]:
        own = [mark for m in (*self.marks, self.other) for mark in (m.opens, m.closes)]
        return list(dict.fromkeys([*own, self.between, *self.foreign]))


TEMPLATE = ChatTemplate(
    marks=(
        RoleMarks("system", "<<SYS>>", "<</SYS>>"),
        RoleMarks("user", "[INST]", "[/INST]"),
        RoleMarks("assistant", "<s>", "</s>", loss=True),
    ),
    moves={
        ("start", "system"): "briefed",
        ("start", "user"): "asked",
        ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    start="start",
    final=("answered",),
    foreign=("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>"),
)


def escape(text: Column, template: ChatTemplate) -> Column:
    breaks = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.control_strings())
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), breaks, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _by_role(role: Column, template: ChatTemplate, pick) -> Column:
    chosen = F.lit(pick(template.other))
    for marks in template.marks:
        chosen = F.when(role == marks.role, F.lit(pick(marks))).otherwise(chosen)
    return chosen


def _segments(turn: Column, template: ChatTemplate) -> Column:
    """Opening mark, escaped text, closing mark of one turn."""
    role = turn["role"]
    known = role.isin([marks.role for marks in template.marks])
    opens = F.concat(
        _by_role(role, template, lambda m: m.opens),
        F.when(known, F.lit("")).otherwise(F.concat(escape(role, template), F.lit(template.between))),
    )
    return F.array(
        F.struct(opens.alias("text"), F.lit(False).alias("loss")),
        F.struct(escape(turn["text"], template).alias("text"), _by_role(role, template, lambda m: m.loss).alias("loss")),
        F.struct(_by_role(role, template, lambda m: m.closes).alias("text"), F.lit(False).alias("loss")),
    )


def _walk(turns: Column, template: ChatTemplate) -> Column:
    """State after all turns and number of the first turn that has no move (null if none)."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}>{role}", to)])
    first = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(s: Column, turn: Column) -> Column:
        to = F.when(s["bad"].isNull(), F.try_element_at(moves, F.concat(s["state"], F.lit(">"), turn["role"])))
        return F.struct(
            F.coalesce(to, F.lit("error")).alias("state"),
            (s["at"] + 1).alias("at"),
            F.coalesce(s["bad"], F.when(to.isNull(), s["at"])).alias("bad"),
        )

    return F.aggregate(turns, first, step, lambda s: F.struct(s["state"].alias("state"), s["bad"].alias("bad")))


def format_conversations(rows: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """``conv_id, formatted, segments array<struct<text, loss>>, valid, bad_turn``.

    ``bad_turn`` counts from 0; it is the number of turns if the conversation just ends early.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = rows.select(F.col("conv_id"), turn.alias("turn")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("turn")).alias("turns")
    )
    walked = turns.select(
        "conv_id",
        F.size("turns").alias("n"),
        F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        _walk(F.col("turns"), template).alias("walk"),
    )
    ended = F.col("walk.state").isin(list(template.final))
    return walked.select(
        "conv_id",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        "segments",
        ended.alias("valid"),
        F.when(~ended, F.coalesce("walk.bad", "n")).alias("bad_turn"),
    )


def read_turns(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """``array<struct<role, text>>`` read back from formatted text alone."""
    every = (*template.marks, template.other)
    opens = "|".join(re.escape(m.opens) for m in every)
    closes = "|".join(re.escape(m.closes) for m in every)
    pattern = F.lit(f"(?s)({opens})(.*?)(?:{closes})")
    pairs = F.arrays_zip(
        F.regexp_extract_all(formatted, pattern, F.lit(1)).alias("mark"),
        F.regexp_extract_all(formatted, pattern, F.lit(2)).alias("body"),
    )

    def turn(pair: Column) -> Column:
        role = F.lit(None).cast("string")
        for marks in template.marks:
            role = F.when(pair["mark"] == marks.opens, F.lit(marks.role)).otherwise(role)
        other = pair["mark"] == template.other.opens
        named = F.split(pair["body"], re.escape(template.between), 2)
        return F.struct(
            F.when(other, unescape(F.get(named, F.lit(0)))).otherwise(role).alias("role"),
            unescape(F.when(other, F.get(named, F.lit(1))).otherwise(pair["body"])).alias("text"),
        )

    return F.transform(pairs, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def chat_digest(formatted: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    read = formatted.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted"), template).alias("turns"),
        loss_text(F.col("segments")).alias("loss"),
        "valid",
        "bad_turn",
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
        "bad_turn",
    )
