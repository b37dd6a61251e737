"""Chat formatting: a state machine over roles and a declarative template, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"
BROKEN = "broken"


@dataclass(frozen=True)
class Template:
    """Marks around a turn, the roles that carry loss, and the turn orders that are valid.

    ``escapes`` maps strings that must not occur inside a text to codes after the
    escape character; the escape character itself is doubled. Roles have
    ``role_escapes`` besides, so that the mark after a role is the first one.
    """

    before_role: str = "### "
    after_role: str = ": "
    after_text: str = "</turn>\n"
    escape: str = "\\"
    escapes: tuple[tuple[str, str], ...] = (("###", "h"), ("</turn>", "e"))
    role_escapes: tuple[tuple[str, str], ...] = ((": ", "c"),)
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: tuple[tuple[str, str], ...] = (
        (START, "system"),
        (START, "user"),
        ("system", "user"),
        ("user", "assistant"),
        ("assistant", "user"),
    )
    final: tuple[str, ...] = ("assistant",)


def escaped(text: Column, template: Template, more: tuple[tuple[str, str], ...] = ()) -> Column:
    e = template.escape
    out = F.replace(text, F.lit(e), F.lit(e + e))
    for string, code in template.escapes + more:
        out = F.replace(out, F.lit(string), F.lit(e + code))
    return out


def unescaped(text: Column, template: Template) -> Column:
    """Undoes :func:`escaped`: between doubled escape characters every single one begins a code."""
    e = template.escape

    def codes(part: Column) -> Column:
        for string, code in template.escapes + template.role_escapes:
            part = F.replace(part, F.lit(e + code), F.lit(string))
        return part

    return F.array_join(F.transform(F.split(text, f"\\Q{e}{e}\\E", -1), codes), e)


def _final_state(turns: Column, template: Template) -> Column:
    """The state after all roles; a move that the template lacks leads to ``broken`` for good."""
    moves = F.create_map(*[F.lit(x) for a, b in template.moves for x in (f"{a}>{b}", b)])
    return F.aggregate(
        turns,
        F.lit(START),
        lambda state, turn: F.coalesce(F.element_at(moves, F.concat(state, F.lit(">"), turn["role"])), F.lit(BROKEN)),
    )


def format_conversations(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, valid, segments (array of text, loss), formatted.

    ``rows`` has conv_id, turn, role, text; other columns are ignored. Turns go by
    turn (nulls first), then role and text; null roles and texts are empty. Rows
    with a null conv_id form one conversation. A conversation is valid if the
    template's moves allow its order of roles and its last state is final; invalid
    ones are formatted as well, and the flag tells them apart. The formatted text
    is the segments in order; it reads back without loss whatever texts contain.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def segments(one: Column) -> Column:
        head = F.concat(F.lit(template.before_role), escaped(one["role"], template, template.role_escapes), F.lit(template.after_role))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(one["text"], template).alias("text"), one["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.after_text).alias("text"), F.lit(False).alias("loss")),
        )

    state = _final_state(F.col("turns"), template)
    out = turns.select("conv_id", state.isin(*template.final).alias("valid"), F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (array of role, text) of a formatted conversation."""
    blocks = F.split(formatted, f"\\Q{template.after_text}\\E", -1)
    # the text after the last mark is empty
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        at = F.locate(template.after_role, block)
        role = F.substring(block, F.lit(len(template.before_role) + 1), at - len(template.before_role) - 1)
        text = F.substring(block, at + len(template.after_role), F.length(block))
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    return F.transform(blocks, turn)


def loss_texts(segments: Column, template: Template = Template()) -> Column:
    """Unescaped texts of the segments under the loss mask, in order."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template))
