"""Chat formatting by a declarative template, and reading the formatted text back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles bear loss, and which role may follow which.

    ``opening`` starts every mark. Inside texts a backslash before it, and a doubled
    backslash, make sure that a mark in the output is always one that the template wrote.
    """

    begin: str = "<|im_start|>"
    middle: str = "\n"
    end: str = "<|im_end|>"
    after: str = "\n"
    opening: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    final: tuple[str, ...] = ("assistant",)


CHAT = Template()


def escape(text: Column, template: Template = CHAT) -> Column:
    """Text without any mark of the template; :func:`unescape` undoes it.

    A line feed ends a role, so in roles a backslash stands before it, too.
    """
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(template.opening), F.lit(template.opening[0] + "\\" + template.opening[1:]))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    """A role as written: on one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def segments(turns: Column, template: Template = CHAT) -> Column:
    """Array of (text, loss) segments of an array of (role, text) turns; their concatenation is the output."""
    def of(turn: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(template.begin), _role(turn["role"]), F.lit(template.middle)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"], template).alias("text"), turn["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.end + template.after).alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, of))


def final_state(roles: Column, template: Template = CHAT) -> Column:
    """State after all turns; a turn that may not follow leads to ``invalid`` for good."""
    allowed = F.array(*[F.lit(f"{a}\n{b}") for a, following in template.follows.items() for b in following])
    return F.aggregate(roles, F.lit(template.start), lambda state, role: F.when(
        F.array_contains(allowed, F.concat_ws("\n", state, role)), role).otherwise(F.lit("invalid")))


def format_chats(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``segments`` (text, loss), ``state``, ``valid``.

    ``rows`` has conv_id, turn, role, text; NULL role or text counts as empty, further columns
    are ignored. Turns are ordered by number, NULL first, ties by role and text; repeated rows
    are turns of their own. Rows without conv_id form one conversation. A conversation has
    to be assembled in one row, as its output is one text.
    """
    turn = F.struct(
        "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    made = chats.select("conv_id", segments(F.col("turns"), template).alias("segments"), state.alias("state"))
    return made.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments", "state",
        F.col("state").isin(*template.final).alias("valid"))


def parse_chats(formatted: Column, template: Template = CHAT) -> Column:
    """Array of (role, text) turns read back from a formatted text."""
    blocks = F.filter(F.split(formatted, _quoted(template.begin), -1), lambda b: b != "")
    head, tail = r"(?s)^((?:[^\\\n]|\\.)*+)\n", _quoted(template.end + template.after) + r"\z"

    def turn(block: Column) -> Column:
        text = F.regexp_replace(F.regexp_replace(block, head, ""), tail, "")
        return F.struct(unescape(F.regexp_extract(block, head, 1)).alias("role"), unescape(text).alias("text"))

    return F.transform(blocks, turn)


def _quoted(mark: str) -> str:
    return "".join("\\" + c if c in "<|>[](){}.*+?^$\\" else c for c in mark)
