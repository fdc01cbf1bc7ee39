"""Chat formatting: a finite-state machine checks turn order, a declarative template writes text and loss segments.

DataFrame functions only. A conversation becomes one training example, so its turns are gathered in one row; that row is as
large as the example itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """What is written around turns, what is learned from, and which role may follow which.

    ``marks`` are the characters that the markup is made of, each with the letter that stands for it after ``escape``
    inside roles and texts. So markup never occurs in an escaped text, and :func:`unescape` restores it exactly.
    """

    before_role: str = "<turn:"
    after_role: str = ">"
    after_text: str = "</turn>\n"
    escape: str = "\\"
    marks: dict[str, str] = field(default_factory=lambda: {"\\": "b", "<": "l", ">": "g"})
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    # state -> {role: next state}
    transitions: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "instructed", "user": "asked"},
        "instructed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })


CHAT = ChatTemplate()


def escape(text: Column, template: ChatTemplate = CHAT) -> Column:
    """``text`` without any mark; the escape character itself goes first."""
    for mark in sorted(template.marks, key=lambda m: m != template.escape):
        text = F.replace(text, F.lit(mark), F.lit(template.escape + template.marks[mark]))
    return text


def unescape(text: Column, template: ChatTemplate = CHAT) -> Column:
    """The inverse of :func:`escape`: the escape character comes back last."""
    for mark in sorted(template.marks, key=lambda m: m == template.escape):
        text = F.replace(text, F.lit(template.escape + template.marks[mark]), F.lit(mark))
    return text


def first_fault(roles: Column, template: ChatTemplate = CHAT) -> Column:
    """Run the machine over an array of roles: the number (from 0) of the first turn that may not stand there, or NULL."""
    arrows = [
        x for state, by_role in template.transitions.items() for role, then in by_role.items()
        for x in (F.lit(f"{state}\n{role}"), F.lit(then))
    ]
    move = F.create_map(*arrows)
    begin = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("turn"), F.lit(None).cast("int").alias("fault")
    )

    def step(acc: Column, role: Column) -> Column:
        then = F.when(acc["fault"].isNull(), F.try_element_at(move, F.concat(acc["state"], F.lit("\n"), role)))
        return F.struct(
            F.coalesce(then, acc["state"]).alias("state"),
            (acc["turn"] + 1).alias("turn"),
            F.when(acc["fault"].isNotNull(), acc["fault"]).when(then.isNull(), acc["turn"]).alias("fault"),
        )

    return F.aggregate(roles, begin, step, lambda acc: acc["fault"])


def format_conversations(turns: DataFrame, template: ChatTemplate = CHAT) -> DataFrame:
    """``conv_id, segments(text, loss), valid, fault`` from ``conv_id, turn, role, text``.

    The segments of a conversation, one after the other, are the example; ``loss`` marks what is learned from. Turns are
    ordered by ``turn``, ties by role and text, a null turn first; repeated rows stay. A null role or text counts as
    empty, rows with a null ``conv_id`` form one conversation. Conversations that the machine refuses are formatted all
    the same and marked: ``valid`` is false, ``fault`` the first turn out of order. Other columns are ignored.
    """
    empty = F.lit("")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def written(t: Column) -> Column:
        head = F.concat(F.lit(template.before_role), escape(t["role"], template), F.lit(template.after_role))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(t["text"], template), t["role"].isin(*template.loss_roles)),
            segment(F.lit(template.after_text), F.lit(False)),
        )

    fault = first_fault(F.transform("turns", lambda t: t["role"]), template)
    return whole.select(
        "conv_id", F.flatten(F.transform("turns", written)).alias("segments"), fault.alias("fault")
    ).select("conv_id", "segments", F.col("fault").isNull().alias("valid"), "fault")


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column, template: ChatTemplate = CHAT) -> Column:
    """The turns ``role, text`` read back from a formatted text."""
    pieces = F.split(text, _quoted(template.after_text), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        both = F.split(F.substr(piece, F.lit(len(template.before_role) + 1)), _quoted(template.after_role), -1)
        return F.struct(
            unescape(F.element_at(both, 1), template).alias("role"), unescape(F.element_at(both, 2), template).alias("text")
        )

    return F.transform(pieces, parse)


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def loss_text(segments: Column, template: ChatTemplate = CHAT) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescape(s["text"], template)), "")


def digest(formatted: DataFrame, template: ChatTemplate = CHAT) -> DataFrame:
    """What a reader of the formatted conversations gets back, as counts and hashes."""
    newline = F.lit("\n")
    read = formatted.select(
        "conv_id", "valid", formatted_text(F.col("segments")).alias("whole"),
        loss_text(F.col("segments"), template).alias("learned"),
    ).select("conv_id", "valid", "whole", "learned", read_turns(F.col("whole"), template).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], newline, t["text"], newline)), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("whole").cast("long").alias("formatted_chars"),
        "valid",
    )
