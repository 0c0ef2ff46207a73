"""Chat formatting that provably reads back.

Grammar of the formatted text::

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

A backslash in role or text makes the next character literal. Rendering starts
with texts as they are. A deterministic parser reads each turn back; while the
recovered turn differs, conflicting content is escaped further: first backslashes
and control strings (also those of other common templates, which a tokenizer
might take for control tokens), then every character. A turn ends where it ends
whatever follows, so the turns of a conversation read back together.

Conversations are streamed: rows are dealt by conversation and sorted by turn,
and a task holds one part (a run of turns of about PART_CHARS) at a time, so one
conversation may exceed memory. Each part is parsed again as a whole, and the
digests come from the parsed output.

Null texts and roles are empty; null conversation ids form one conversation;
equal turn numbers are ordered by role, then text; repeated rows are repeated
turns; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<s>", "</s>", "[INST]", "[/INST]")
PART_CHARS = 1 << 20

_CONFLICT = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.|<(?!\|im_end\|>))*)<\|im_end\|>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def _escape_conflicts(text: str) -> str:
    """A backslash before each backslash and after the first character of each
    control string, which no longer occurs then."""
    return _CONFLICT.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def _escape_all(text: str) -> str:
    return "".join("\\" + c for c in text)


LEVELS = (str, _escape_conflicts, _escape_all)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


class ParseError(ValueError):
    pass


def parse(formatted: str) -> list[tuple[str, int, int]]:
    """(role, start, end of the escaped text) of each turn; fails on anything
    that the grammar does not give."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ParseError(f"no turn at {at}")
        turns.append((unescape(m[1]), m.start(2), m.end(2)))
        at = m.end()
    return turns


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(role, unescape(formatted[a:b])) for role, a, b in parse(formatted)]


def render_turn(role: str, text: str) -> str:
    """The turn at the lowest escape level that reads back identically. Texts
    with a control string are escaped even where they would read back."""
    for level in LEVELS if not any(c in text or c in role for c in CONTROL) else LEVELS[1:]:
        head = _escape_all(role) if level is _escape_all or "\n" in role else level(role)
        out = f"{START}{head}\n{level(text)}{END}\n"
        try:
            if read_back(out) == [(role, text)]:
                return out
        except ParseError:
            pass
    raise AssertionError("escaping every character reads back by construction")


class _Conversation:
    """Digests of one conversation, fed part by part."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.parts = 0
        self.rendered, self.source, self.size = [], [], 0

    def add(self, role, text):
        self.source.append((role, text))
        self.rendered.append(render_turn(role, text))
        self.size += len(self.rendered[-1])

    def part(self):
        """Format the turns held, read them back, and take the digests."""
        formatted = "".join(self.rendered)
        found = parse(formatted)
        spans = [(a, b) for role, a, b in found if role == "assistant"]
        turns = [(role, unescape(formatted[a:b])) for role, a, b in found]
        if turns != self.source:
            raise AssertionError("turns that read back alone must read back together")
        for role, text in turns:
            self.turns.update(f"{role}\n{text}\n".encode())
        for a, b in spans:
            loss = unescape(formatted[a:b])
            self.loss.update(loss.encode())
            self.loss_chars += len(loss)
        self.n, self.chars, self.parts = self.n + len(turns), self.chars + len(formatted), self.parts + 1
        self.rendered, self.source, self.size = [], [], 0
        return formatted, spans


SCHEMA = ("conv_id {}, part bigint, last boolean, formatted string, loss_spans array<bigint>, n_turns bigint, turns_sha256 string, "
          "loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _format(batches):
    current, state = None, None
    out: list[tuple] = []
    held = 0

    def flush(last):
        nonlocal held
        formatted, spans = state.part()
        held += len(formatted)
        out.append((current, state.parts, last, formatted, [x for s in spans for x in s], state.n, state.turns.hexdigest(),
                    state.loss_chars, state.loss.hexdigest(), state.chars))
    kinds = None

    def table():
        nonlocal held
        rows, out[:], held = list(zip(*out)), [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=[
            "conv_id", "part", "last", "formatted", "loss_spans", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
    for batch in batches:
        i, s = pa.int64(), pa.string()
        kinds = [batch.schema.types[0], i, pa.bool_(), s, pa.list_(i), i, s, i, s, i]
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if state is None or conv != current:
                if state is not None:
                    flush(True)
                current, state = conv, _Conversation()
            elif state.size > PART_CHARS:
                flush(False)
            state.add(role or "", text or "")
            if len(out) >= 1000 or held > PART_CHARS:
                yield table()
    if state is not None:
        flush(True)
    if out:
        yield table()


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Formatted conversations in parts (one for all but very long ones):
    text, loss spans in it (flat, code points), and running digests; the row
    with ``last`` holds those of the whole conversation."""
    c = lambda name: F.col(f"`{name}`")
    rows = turns.select(c(conv_col).alias("conv_id"), c(role_col).alias("role"), c(text_col).alias("text"), c(turn_col).alias("turn"))
    kind = rows.schema[0].dataType.simpleString()
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, SCHEMA.format(kind))


def digests(turns: DataFrame, **columns) -> DataFrame:
    """One row per conversation, read back from the formatted text."""
    return format_conversations(turns, **columns).filter("last").select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
