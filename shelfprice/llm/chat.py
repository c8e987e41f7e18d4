"""Conversations formatted by a declarative template.

A template names, per role, what stands before and after a text and whether the text is trained on, and
which role may follow which. Each conversation becomes one text plus segments with a loss flag; a
finite-state machine over the roles says whether the turns are in a valid order and which turn breaks it.

Inside texts and roles the control sequence ``<|`` is written ``<\\|`` and ``\\`` is written ``\\\\`` (in
roles a line feed is written ``\\n`` too), so a marker in the formatted text is always the template's own
and every text can be read back exactly.

Defined results: NULL texts and roles are empty; turns that share a number are ordered by role, then text,
repeated rows stay; NULL turns come first; NULL is a conversation of its own; a role the template does
not name is formatted with the template's default, is not trained on, and makes the order invalid; an
empty table gives an empty result. A conversation is one row of output, so its turns meet in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Template:
    """What a formatted conversation looks like and which turn orders are valid."""

    open: str = OPEN
    close: str = CLOSE
    after: str = "\n"
    trained: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    # From a state, a role leads to a state; a pair that is not listed is not allowed.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    ends: frozenset[str] = frozenset({"assistant"})


TEMPLATE = Template()


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    parts = F.split(text, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\|"), F.lit("|"))), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")
    plain = F.transform(
        parts, lambda p: F.replace(F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n"))
    )
    return F.array_join(plain, "\\")


def _walk(roles: Column, template: Template) -> Column:
    """State after all turns ('' from the first turn that is not allowed) and how many turns were allowed."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)])
    start = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("ok"))

    def step(acc: Column, role: Column) -> Column:
        to = F.coalesce(F.element_at(moves, F.concat(acc["state"], F.lit("\n"), role)), F.lit(""))
        return F.struct(to.alias("state"), (acc["ok"] + F.when(to == "", 0).otherwise(1)).alias("ok"))

    return F.aggregate(roles, start, step)


def format_conversations(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, segments, valid, first_bad_turn``.

    ``segments`` is an array of ``(text, loss)`` whose texts, joined, are ``formatted``.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    trained = F.lit(False)
    parts = F.transform(
        "turns",
        lambda t: F.array(
            segment(F.concat(F.lit(template.open), escape_role(t["role"]), F.lit("\n")), F.lit(False)),
            segment(escape(t["text"]), t["role"].isin(*template.trained) if template.trained else trained),
            segment(F.lit(template.close + template.after), F.lit(False)),
        ),
    )
    segments = F.filter(F.flatten(parts), lambda s: s["text"] != "")
    walked = grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        segments.alias("segments"),
        _walk(F.transform("turns", lambda t: t["role"]), template).alias("end"),
    )
    valid = (F.col("end.ok") == F.col("n_turns")) & F.col("end.state").isin(*template.ends)
    return walked.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.coalesce(valid, F.lit(False)).alias("valid"),
        F.when(F.col("end.ok") < F.col("n_turns"), F.col("end.ok")).cast("long").alias("first_bad_turn"),
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns, as an array of ``(role, text)``, read back from a formatted text."""
    ends = F.split(formatted, _literal(template.close + template.after))
    blocks = F.slice(ends, 1, F.size(ends) - 1)

    def read(block: Column) -> Column:
        body = F.substring(block, len(template.open) + 1, F.length(block))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(blocks, read)


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, read back."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"
