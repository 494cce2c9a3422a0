"""Conversations formatted by a declarative template, with loss flags.

A finite-state machine over roles checks the order of turns: its transitions
are data of the template, and a conversation is valid if no turn leads out of
them. Each turn gives three segments (head, text, end); whether a segment
counts in the loss is a property of the role and the kind of segment.

Texts may hold the template's own control strings. They are escaped: every
backslash is doubled, then a backslash is put after the first character of
each control string. A single backslash there can only come from the second step, so
:func:`unescape` restores every text; no control string survives in an escaped
text because none holds a backslash, none holds another and no two overlap.

DataFrame functions only; a conversation is one group, as its formatted
text is one value.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``start role newline text end`` per turn, and what is checked and learnt."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    #: Strings that must not appear in a text: the template's own marks, and
    #: those of other templates that a tokenizer may hold as special tokens.
    control: tuple[str, ...] = (
        "<|im_start|>",
        "<|im_end|>",
        "<s>",
        "</s>",
        "[INST]",
        "[/INST]",
        "<<SYS>>",
        "<</SYS>>",
        "<|endoftext|>",
    )
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> roles that may follow; a state is the last role, "" the start.
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )


TEMPLATE = Template()
_OUT = "!"  # the state after a wrong turn


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in template.control:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    out = text
    for c in template.control:
        out = F.replace(out, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def format_conversations(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation of ``turns (conv_id, turn, role, text)``.

    Returns ``conv_id``, ``n_turns``, ``valid``, ``segments`` (array of
    ``text``, ``loss``) and ``formatted`` (all segments joined). Turns are
    ordered by ``turn`` (null first), ties by role and text; repeated rows are
    turns of their own. A null text or role is an empty one; a null
    ``conv_id`` is a conversation like any other. Roles are percent-encoded in
    the head, so any role can be read back. Other columns are ignored; an
    empty table gives an empty result.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    arrows = F.create_map(
        *(
            F.lit(x)
            for state, follow in template.transitions.items()
            for role in follow
            for x in (f"{state}\n{role}", role)
        )
    )
    state = F.aggregate(
        "ts",
        F.lit(""),
        lambda s, t: F.coalesce(F.element_at(arrows, F.concat(s, F.lit("\n"), t["role"])), F.lit(_OUT)),
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    off = F.lit(False)
    segments = F.flatten(
        F.transform(
            "ts",
            lambda t: F.array(
                segment(F.concat(F.lit(template.start), F.url_encode(t["role"]), F.lit("\n")), off),
                segment(escape(t["text"], template), t["role"].isin(*template.loss_roles)),
                segment(F.lit(template.end), off),
            ),
        )
    )
    return (
        ordered.select(
            "conv_id",
            F.size("ts").cast("long").alias("n_turns"),
            (state != _OUT).alias("valid"),
            segments.alias("segments"),
        )
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns (array of ``role``, ``text``) that a formatted text holds."""
    parts = F.filter(_split(formatted, template.start), lambda p, i: i > 0)
    bodies = F.transform(parts, lambda p: F.substring(p, F.lit(1), F.length(p) - len(template.end)))

    def turn(b: Column) -> Column:
        at = F.instr(b, "\n")
        return F.struct(
            F.url_decode(F.substring(b, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(b, at + 1, F.length(b)), template).alias("text"),
        )

    return F.transform(bodies, turn)


def _split(text: Column, mark: str) -> Column:
    return F.split(text, r"\Q" + mark + r"\E")


def read_loss_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, unescaped, in order."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"], template)), "")
