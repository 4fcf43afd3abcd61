"""Chat formatting [native].

A declarative :class:`Template` gives, for each role, the marks around a
turn and whether its text is trained on, and a finite-state machine over
roles.  ``format_chats`` walks that machine over the ordered turns and emits
text segments with a loss flag each; ``read_back`` recovers the turns from
the formatted string alone.  Everything is DataFrame functions.

Defined cases: a null text or role is empty; a null ``turn`` sorts first;
rows with the same turn keep a fixed order (role, then text) and repeated
rows are turns of their own; a null ``conv_id`` is a conversation; an empty
table gives no rows; roles the template does not name use its ``other``
marks; other columns are ignored, whatever their names.

A conversation becomes one row, as the training sample it is, so its text
must fit in one row; ``format_turns`` needs no grouping at all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Marks:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict = field(default_factory=lambda: {
        "system": Marks("<<SYS>> ", " <</SYS>>"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks("<s> ", " </s>", loss=True),
    })
    other: Marks = Marks("[ROLE] ", " [END]")  # around role + other_sep + text
    other_sep: str = " [/ROLE] "
    # state -> {role: next state}; any other role leads to the error state
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })
    accept: tuple = ("assistant",)

    def controls(self) -> list[str]:
        marks = [m for r in (*self.roles.values(), self.other) for m in (r.open, r.close)] + [self.other_sep]
        return sorted({m.strip() for m in marks})


DEFAULT = Template()


def escape(text: Column, t: Template = DEFAULT) -> Column:
    """Double every backslash, then put one behind the first character of
    each control string: no control string is left in the result."""
    text = F.regexp_replace(text, r"\\", r"\\\\")
    heads = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in t.controls())
    return F.regexp_replace(text, f"({heads})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _by_role(role: Column, t: Template, pick, other) -> Column:
    out = None
    for name, marks in t.roles.items():
        hit = role == name
        out = F.when(hit, pick(marks)) if out is None else out.when(hit, pick(marks))
    return out.otherwise(other)


def _segments(role: Column, text: Column, t: Template) -> Column:
    """Opening mark, text and closing mark of one turn, with loss flags."""
    head = _by_role(role, t, lambda m: F.lit(m.open),
                    F.concat(F.lit(t.other.open), escape(role, t), F.lit(t.other_sep)))
    seg = lambda s, loss: F.struct(s.alias("text"), loss.alias("loss"))
    return F.array(seg(head, F.lit(False)),
                   seg(escape(text, t), _by_role(role, t, lambda m: F.lit(m.loss), F.lit(t.other.loss))),
                   seg(_by_role(role, t, lambda m: F.lit(m.close), F.lit(t.other.close)), F.lit(False)))


def _clean(df: DataFrame) -> DataFrame:
    return df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))


def format_turns(df: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """One row per segment, without grouping: (conv_id, turn, role, part,
    text, loss)."""
    segs = _clean(df).select("conv_id", "turn", "role", F.posexplode(_segments(F.col("role"), F.col("text"), t)))
    return segs.select("conv_id", "turn", "role", F.col("pos").alias("part"), "col.text", "col.loss")


def _walk(turns: Column, t: Template) -> Column:
    """Run the machine: (state, turns seen, position of the first bad turn)."""
    table = F.create_map(*[F.lit(x) for s, m in t.moves.items() for r, to in m.items() for x in (f"{s}\n{r}", to)])
    step = lambda acc, x: F.struct(
        F.coalesce(F.try_element_at(table, F.concat(acc["state"], F.lit("\n"), x["role"])), F.lit("error")).alias("state"),
        (acc["seen"] + 1).alias("seen"),
        F.when((acc["bad"] < 0) & F.try_element_at(table, F.concat(acc["state"], F.lit("\n"), x["role"])).isNull(),
               acc["seen"]).otherwise(acc["bad"]).alias("bad"))
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("seen"), F.lit(-1).alias("bad"))
    return F.aggregate(turns, start, step)


def format_chats(df: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), formatted,
    status (ok, bad_turn or unfinished) and bad_turn (its position or -1).
    Ill-formed conversations are formatted too; callers filter on status."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    g = _clean(df).groupBy("conv_id").agg(turns.alias("turns"))
    g = g.withColumn("end", _walk(F.col("turns"), t))
    g = g.withColumn("segments", F.flatten(F.transform("turns", lambda x: _segments(x["role"], x["text"], t))))
    status = (F.when(F.col("end.bad") >= 0, "bad_turn").when(F.col("end.state").isin(*t.accept), "ok")
              .otherwise("unfinished"))
    return g.select("conv_id", "segments",
                    F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    status.alias("status"), F.col("end.bad").cast("long").alias("bad_turn"))


def read_back(formatted: Column, t: Template = DEFAULT) -> Column:
    """The turns (role, text) of a formatted string, by its marks alone."""
    both = (*t.roles.values(), t.other)
    turn = "|".join(f"{re.escape(m.open)}.*?{re.escape(m.close)}" for m in both)
    pieces = F.regexp_extract_all(formatted, F.lit(f"(?s)({turn})"), F.lit(0))

    def parse(p: Column) -> Column:
        inner = lambda m: p.substr(F.lit(len(m.open) + 1), F.length(p) - len(m.open) - len(m.close))
        rest = inner(t.other)
        # a role may hold no control string, so the first separator is the mark
        cut = F.instr(rest, t.other_sep)
        role, text = rest.substr(F.lit(1), cut - 1), rest.substr(cut + len(t.other_sep), F.length(rest))
        for name, m in t.roles.items():
            hit = p.startswith(m.open)
            role, text = F.when(hit, name).otherwise(role), F.when(hit, inner(m)).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, parse)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
