"""Chat formatting (operator 1).

A declarative template gives each role a head, a tail and a loss flag; a
finite-state machine over roles checks the turn order. Every turn becomes three
segments (head, text, tail), each with its own loss flag. Control strings inside
a text are escaped so that the marks of the template occur nowhere else, and
`read_back` restores roles and texts from the formatted segments alone.

Turns are dealt out by conversation and stream in order through each task; the
machine's state is one word, so a conversation of any length needs no memory.

Cases: a null text is empty; a null role is the empty role; an unknown role is
written with the general head and breaks the order; turns are ordered by (turn,
role, text), a null turn first, and repeated turns are all kept; turns with a
null conv_id form one conversation; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "start"
ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Marks of each role, whether its text counts in the loss, and the role order.

    `order` maps a state (the last role, or "start") to the roles that may
    follow; `final` are the states a conversation may end in."""

    heads: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: ", "tool": "### Tool: "})
    other_head: str = "### Role "   # followed by the escaped role and `other_mark`
    other_mark: str = " <says> "
    tail: str = " </turn>\n"
    loss: frozenset = frozenset({"assistant"})
    control: tuple[str, ...] = ("### ", "</turn>", "<says>")
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant", "tool")})
    final: frozenset = frozenset({"assistant"})

    def __post_init__(self):
        for c in self.control:
            if not c or ESCAPE in c or c[0].isdigit():
                raise ValueError("a control string is not empty, holds no escape character and starts with no digit")

    def escaper(self) -> re.Pattern:
        # the first character of a control string, wherever one starts, or an escape character
        return re.compile("|".join([re.escape(ESCAPE)] + [f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.control]))

    def escape(self, text: str) -> str:
        firsts = {c[0]: i for i, c in reversed(list(enumerate(self.control)))}
        return self.escaper().sub(lambda m: ESCAPE + (ESCAPE if m[0] == ESCAPE else str(firsts[m[0]]) + ";"), text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\|(\d+);)", lambda m: ESCAPE if m[1] == ESCAPE else self.control[int(m[2])][0], text)

    def head(self, role: str) -> str:
        return self.heads.get(role) or f"{self.other_head}{self.escape(role)}{self.other_mark}"

    def role_of(self, head: str) -> str:
        for role, h in self.heads.items():
            if h == head:
                return role
        if not (head.startswith(self.other_head) and head.endswith(self.other_mark)):
            raise ValueError(f"not a head: {head!r}")
        return self.unescape(head[len(self.other_head):-len(self.other_mark)])


SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("segment_no", pa.int64()), ("kind", pa.string()),
                      ("loss", pa.bool_()), ("segment", pa.string()), ("violation", pa.string())])
SEGMENTS_SQL = "conv_id long, turn_no long, segment_no long, kind string, loss boolean, segment string, violation string"


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments (conv_id, turn_no, segment_no, kind, loss, segment, violation) of
    every conversation; `violation` names a turn that breaks the order, and an
    `end` row of no text names a conversation that ends in a wrong state."""
    def go(batches):
        conv, state, n, known = None, START, 0, False
        for b in batches:
            out = []

            def end():
                if state not in template.final:
                    out.append((conv, n, 3 * n, "end", False, "", f"ends after {state}"))

            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                role = role or ""
                if not known or c != conv:
                    if known:
                        end()
                    conv, state, n, known = c, START, 0, True
                wrong = None if role in template.order.get(state, ()) else f"{role or 'no role'} after {state}"
                out.append((c, n, 3 * n, "head", False, template.head(role), wrong))
                out.append((c, n, 3 * n + 1, "text", role in template.loss, template.escape(text or ""), None))
                out.append((c, n, 3 * n + 2, "tail", False, template.tail, None))
                state, n = role, n + 1
            if out:
                yield _batch(out)
        if known:
            out = []
            end()
            if out:
                yield _batch(out)

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SEGMENTS.types)], schema=SEGMENTS)

    rows = (turns.select(F.col("conv_id").cast("long").alias("c"), F.col("role").cast("string").alias("r"),
                         F.col("text").cast("string").alias("t"), F.col("turn").cast("long").alias("n"))
            .repartition("c").sortWithinPartitions("c", "n", "r", "t").select("c", "r", "t"))
    return rows.mapInArrow(go, SEGMENTS_SQL)


DIGESTS_SQL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long, n_violations long")


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, from the formatted segments alone: roles from
    the heads, texts by undoing the escapes, loss text by the flags."""
    def go(batches):
        conv, known, s = None, False, None
        for b in batches:
            out = []
            for c, kind, loss, text, wrong in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if not known or c != conv:
                    if known:
                        out.append(done(conv, s))
                    conv, known = c, True
                    s = {"n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0, "wrong": 0}
                s["chars"] += len(text)
                s["wrong"] += wrong is not None
                if kind == "head":
                    s["n"] += 1
                    s["turns"].update(f"{template.role_of(text)}\n".encode())
                elif kind == "text":
                    plain = template.unescape(text)
                    s["turns"].update(f"{plain}\n".encode())
                    if loss:
                        s["loss_chars"] += len(plain)
                        s["loss"].update(plain.encode())
            if out:
                yield batch(out)
        if known:
            yield batch([done(conv, s)])

    def done(c, s):
        return (c, s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"], s["wrong"])

    def batch(rows):
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_violations"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    rows = (segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment_no")
            .select("conv_id", "kind", "loss", "segment", "violation"))
    return rows.mapInArrow(go, DIGESTS_SQL)
