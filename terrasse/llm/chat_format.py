"""Conversations as training text: segments with loss flags by a declarative template, turn order checked by a state machine.

A `Template` names the strings that open and close a turn, the roles whose texts are learned, and
the moves of a finite-state machine over roles.  Every turn gives three segments: what marks it, its text, what closes it.
Control strings all begin with ``<|``.  In texts and roles a backslash goes between ``<`` and ``|``, after those that
stand there already, so ``<|`` occurs in control strings alone and one backslash less gives the text again.

The machine runs over parts of ``PART`` turns.  A part does not know in which state it starts, so it says for every state
where it ends; parts are then passed through in order.  So neither formatting nor checking needs a whole conversation in one place;
only `conversations`, which returns one row for each, does.

SQL functions only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasse.operators.ordered import over_order

PART = 512
MARK = "<|"
LINE_IN_ROLE = "<|newline|>"  # a role ends at the first line feed, so one inside is a control string


@dataclass(frozen=True)
class Template:
    """Strings around role and text, roles that are learned, and ``{state: {role: next state}}``."""

    opening: str
    between: str
    closing: str
    learned: tuple[str, ...]
    moves: Mapping[str, Mapping[str, str]]
    start: str
    final: tuple[str, ...]

    def __post_init__(self) -> None:
        if not (self.opening.startswith(MARK) and self.closing.startswith(MARK)) or self.between != "\n":
            raise ValueError(f"opening and closing must begin with {MARK}, and a line feed end the role")
        reached = {self.start, *self.final}.union(*[m.values() for m in self.moves.values()])
        if reached - set(self.moves):
            raise ValueError(f"states without moves: {sorted(reached - set(self.moves))}")

    @property
    def states(self) -> list[str]:
        return list(self.moves)


CHATML = Template(
    opening="<|im_start|>", between="\n", closing="<|im_end|>\n", learned=("assistant",),
    moves={
        "start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"},
        "assistant": {"user": "user", "tool": "tool"}, "tool": {"assistant": "assistant"},
    },
    start="start", final=("assistant",),
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _turn_segments(turn: Column, template: Template) -> Column:
    role = F.replace(escaped(turn["role"]), F.lit("\n"), F.lit(LINE_IN_ROLE))
    return F.array(
        _segment(F.concat(F.lit(template.opening), role, F.lit(template.between)), F.lit(False)),
        _segment(escaped(turn["text"]), turn["role"].isin(*template.learned)),
        _segment(F.lit(template.closing), F.lit(False)))


def _run(turns: Column, template: Template, state: str) -> Column:
    """State after the turns, and the first turn that has no move (null: none)."""
    moves = F.create_map(*[F.lit(x) for s, m in template.moves.items() for r, to in m.items() for x in (f"{s}>{r}", to)])
    begin = F.struct(F.lit(state).alias("state"), F.lit(None).cast("long").alias("bad"))

    def step(seen: Column, turn: Column) -> Column:
        to = F.try_element_at(moves, F.concat(seen["state"], F.lit(">"), turn["role"]))
        moved = F.struct(F.coalesce(to, seen["state"]).alias("state"), F.when(to.isNull(), turn["n"]).alias("bad"))
        return F.when(seen["bad"].isNotNull(), seen).otherwise(moved)

    return F.aggregate(turns, begin, step)


def parts(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id, part, segments, ends``: up to ``PART`` turns each, and for every state of the machine where it ends.

    ``rows`` are ``conv_id, turn, role, text`` and further columns, which are not read.  Turns go by ``turn``
    (null first), rows of one turn by role and text; repeated rows are repeated turns.  A null role or text is an empty one, a null
    conv_id is a conversation like any other.  No rows give none.
    """
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    numbered = over_order(rows, ["conv_id"], ["turn", "role", "text"], index="n")
    turns = F.array_sort(F.collect_list(F.struct("n", "role", "text")))
    found = numbered.groupBy("conv_id", F.floor((F.col("n") - 1) / PART).alias("part")).agg(turns.alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: _turn_segments(t, template)))
    return found.select("conv_id", "part", segments.alias("segments"), F.array(*[_run(F.col("turns"), template, s) for s in template.states]).alias("ends"))


def _verdict(ends: Column, template: Template) -> Column:
    """The machine over all parts: ``state`` and ``bad``."""
    states = F.array(*[F.lit(s) for s in template.states])
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(None).cast("long").alias("bad"))

    def step(seen: Column, of_part: Column) -> Column:
        return F.when(seen["bad"].isNotNull(), seen).otherwise(F.element_at(of_part, F.array_position(states, seen["state"]).cast("int")))

    return F.aggregate(ends, begin, step)


def verdicts(found: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation of `parts` ``conv_id, verdict, bad_turn``: ``ok``, ``order`` (with the number of the first turn out of order, from 1) or ``open``."""
    ends = F.array_sort(F.collect_list(F.struct("part", "ends")))
    return found.groupBy("conv_id").agg(ends.alias("all")).select("conv_id", *_named(_verdict(F.col("all.ends"), template), template))


def _named(end: Column, template: Template) -> list[Column]:
    word = F.when(end["bad"].isNotNull(), "order").when(end["state"].isin(*template.final), "ok").otherwise("open")
    return [word.alias("verdict"), end["bad"].alias("bad_turn")]


def conversations(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: ``conv_id, segments, verdict, bad_turn``; a conversation must fit one value (2 GB)."""
    whole = parts(rows, template).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "segments", "ends"))).alias("all"))
    return whole.select("conv_id", F.flatten("all.segments").alias("segments"), *_named(_verdict(F.col("all.ends"), template), template))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_turns(text: Column, template: Template = CHATML) -> Column:
    """The turns ``role, text`` of a formatted conversation."""
    pieces = F.split(text, rf"\Q{template.opening}\E", -1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(1), F.length(piece) - len(template.closing))
        role = F.substring_index(body, template.between, 1)
        said = F.substring(body, F.length(role) + len(template.between) + 1, F.length(body))
        return F.struct(unescaped(F.replace(role, F.lit(LINE_IN_ROLE), F.lit("\n"))).alias("role"), unescaped(said).alias("text"))

    return F.transform(F.slice(pieces, 2, F.size(pieces)), turn)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, as it was said."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
