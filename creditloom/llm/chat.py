"""Chat formatting: a state machine over roles and a declarative template.

A conversation's rows, ordered by turn, become one text of segments. The template gives for each
role the control string before and after the text and whether the text counts for the loss; control
strings never do. Texts are escaped, so that no control string can appear in one: each of the
characters that begin a control string, and the escape sign itself, gets the escape sign behind it.
A machine with one state per role steps through the turns and reports the first turn that is out of
order.

``read_back`` turns a formatted text into its turns again: as no text holds a control string, the
text is split after the closing strings and the roles are told by the opening ones.

A null text is empty, a null role is an empty role. Roles the template does not know have markers that
carry the role's name, escaped, and are out of order. Turns that share a number are ordered by role
and text; a null turn comes first. Rows without a conv_id are one conversation. A conversation is one
value of the result, so it has to fit in a row; conversations of a hot id are not split.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    """How one role is written."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Parts by role, the order of roles, and the marks of any other role."""

    parts: Mapping[str, Part]
    # The roles that may follow each state; "" is the beginning.
    follows: Mapping[str, tuple[str, ...]]
    other: tuple[str, str, str] = ("[ROLE] ", " [/ROLE] ", " [/TURN]")
    escape: str = "\\"
    # The characters with which control strings begin.
    openers: str = "<["

    def __post_init__(self):
        marks = [mark for part in self.parts.values() for mark in (part.before, part.after)]
        for mark in [*marks, *self.other]:
            if not mark.strip() or mark.strip()[0] not in self.openers:
                raise ValueError(f"a control string begins with one of {self.openers!r}: {mark!r}")
            if self.escape in mark:
                raise ValueError(f"a control string holds no {self.escape!r}: {mark!r}")


# The usual form with instruction marks; a system turn comes first, then user and assistant in turn.
INSTRUCT = Template(
    parts={
        "system": Part("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Part("<s>[INST] ", " [/INST]"),
        "assistant": Part("[ANS] ", " </s>", loss=True),
    },
    follows={
        "": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
)

SEGMENTS = "array<struct<text:string,loss:boolean>>"


def escaped(text: Column, template: Template = INSTRUCT) -> Column:
    signs = "".join("\\" + sign for sign in template.openers + template.escape)
    return F.regexp_replace(text, f"([{signs}])", "$1\\" + template.escape)


def unescaped(text: Column, template: Template = INSTRUCT) -> Column:
    signs = "".join("\\" + sign for sign in template.openers + template.escape)
    return F.regexp_replace(text, f"([{signs}])\\{template.escape}", "$1")


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def _turn_segments(turn: Column, template: Template) -> Column:
    """Opening string, escaped text and closing string of one turn."""
    text = escaped(turn["text"], template)
    before, between, after = template.other
    written = F.array(
        _segment(F.concat(F.lit(before), escaped(turn["role"], template), F.lit(between)), False),
        _segment(text, False),
        _segment(F.lit(after), False),
    )
    for role, part in template.parts.items():
        known = F.array(
            _segment(F.lit(part.before), False),
            _segment(text, part.loss),
            _segment(F.lit(part.after), False),
        )
        written = F.when(turn["role"] == role, known).otherwise(written)
    return written


def _first_fault(turns: Column, template: Template) -> Column:
    """The place, from 0, of the first turn that may not follow the one before; null if none."""

    def step(at: Column, turn: Column) -> Column:
        allowed = F.lit(False)
        for state, roles in template.follows.items():
            allowed = allowed | ((at["state"] == state) & turn["role"].isin(*roles))
        fault = F.when(at["fault"].isNull() & ~allowed, at["place"]).otherwise(at["fault"])
        return F.struct(
            turn["role"].alias("state"), (at["place"] + 1).alias("place"), fault.alias("fault")
        )

    start = F.struct(
        F.lit("").alias("state"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("fault")
    )
    return F.aggregate(turns, start, step, lambda at: at["fault"])


def format_conversations(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``(conv_id, segments, formatted, first_fault)``, one row per conversation.

    ``segments`` are ``(text, loss)`` in order, and ``formatted`` is their texts joined.
    """
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    made = turns.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: _turn_segments(t, template)))
        .cast(SEGMENTS)
        .alias("segments"),
        _first_fault(F.col("turns"), template).alias("first_fault"),
    )
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return made.select("conv_id", "segments", text.alias("formatted"), "first_fault")


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns ``array<struct<role,text>>`` of a formatted text."""
    before, between, after = template.other
    ends = {part.after for part in template.parts.values()} | {after}
    quoted = ["\\Q" + end + "\\E" for end in sorted(ends)]
    # Split behind a closing string: an empty text leaves none.
    behind = "|".join(f"(?<={end})" for end in quoted)
    pieces = F.filter(F.split(formatted, behind), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        def middle(opening: str, closing: str) -> Column:
            length = F.length(piece) - len(opening) - len(closing)
            return F.substring(piece, len(opening) + 1, length)

        named = middle(before, after)
        role = F.substring_index(named, between, 1)
        text = F.substring(named, F.length(role) + 1 + len(between), F.length(named))
        found = F.struct(
            unescaped(role, template).alias("role"), unescaped(text, template).alias("text")
        )
        for name, part in template.parts.items():
            known = F.struct(
                F.lit(name).alias("role"),
                unescaped(middle(part.before, part.after), template).alias("text"),
            )
            found = F.when(piece.startswith(part.before), known).otherwise(found)
        return found

    return F.transform(pieces, turn)


def digests(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """What the formatted texts say, read back from them.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, first_fault)``
    """
    turns = read_back(F.col("formatted"), template)
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under_loss = F.filter("segments", lambda s: s["loss"])
    loss = F.array_join(F.transform(under_loss, lambda s: unescaped(s["text"], template)), "")
    read = formatted.select(
        "conv_id", turns.alias("turns"), loss.alias("loss"), "formatted", "first_fault"
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(each, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "first_fault",
    )
