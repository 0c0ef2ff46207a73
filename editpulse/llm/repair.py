"""Conversation structure repair by weighted interval parsing.

A well-formed conversation is an optional system turn and then alternating user and
assistant turns, or nothing:  (s? (u a)+)?  over the initials of the roles. A turn may
be kept (0), given the role user or assistant (1) or deleted (2); empty turns of user
or assistant may be inserted (5). Blank turns and turns that repeat an earlier role and
text must be deleted; a turn that stops without [.!?] costs 5 more unless deleted.

The repair grammar is in Chomsky normal form. Its symbols (p, q) stand for runs of
edited turns that lead from state p of the language to state q; its rules are
(p, q) -> (p, r) (r, q), and (p, q) -> an edit of one turn, closed under insertions on
both sides. A cell holds, for each symbol of a span, the least (cost, audit), where the
audit spells the edits (D, I, K, R). Cells are combined bottom-up by span length: all
spans and all splits of a block of BLOCK turns, then spans of doubling length. Of a
longer span one split is enough, since every rule's right side covers every state r;
and as audits of equal cost over the same turns are never prefixes of each other, the
least audit of a span is made of least audits of its parts.

Turns are dealt by conversation and sorted by (turn, role, text), nulls first; a task
holds one conversation at a time. A conversation of more than HOT_ROWS turns or
HOT_BYTES of text is dealt by ranges of that order instead, over all tasks: repeated
turns are found by an aggregation, each run of turns becomes one cell, the cells of a
conversation are combined, and its texts stream once past the audit for the digest.
There the task that joins the cells holds about ten bytes for each turn.

Null roles and texts are one blank (so a null text is a blank turn, and a null role
has to be changed or goes); null turns come first and are left out of gaps; a null
conversation id is a conversation. Rows equal in every column are turns like others, the
later ones duplicates. An empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.session import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 8
HOT_ROWS, HOT_BYTES = 100_000, 16 << 20
SEGMENT = 1 << 15

EMPTY, SYSTEM, OPEN, CLOSED = range(4)
STATES = range(4)
MOVES = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): OPEN, (SYSTEM, "u"): OPEN, (OPEN, "a"): CLOSED, (CLOSED, "u"): OPEN}
FINAL = (EMPTY, CLOSED)
ROLE = {"u": "user", "a": "assistant"}
#: The one role that may be given or inserted in each state.
NEXT = {p: c for p in STATES for c in "ua" if (p, c) in MOVES}
BLANK_CHARS = " \t\n\x0b\x0c\r"
#: What a turn is to the grammar: its initial, and its fault.
SOUND, GOES, CUT = range(3)
CODES = [(c, fault) for c in "sua-" for fault in (SOUND, GOES, CUT)]
CODE = {x: bytes([i]) for i, x in enumerate(CODES)}

Cell = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """Least (cost, audit) of each symbol over two neighbouring spans."""
    out = {} if into is None else into
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            other = right.get((r, q))
            if other is not None:
                found = (cost + other[0], audit + other[1])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _closure() -> Cell:
    """Insertions alone: no turn read, any state to any state in reach."""
    one = {(p, MOVES[p, c]): (INSERT, "I") for p, c in NEXT.items()}
    all_ = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        all_ = combine(all_, one, dict(all_))
    return all_


INSERTED = _closure()


def _terminal(code: int) -> Cell:
    initial, fault = CODES[code]
    out = {(p, p): (DELETE, "D") for p in STATES}
    if fault != GOES:
        extra = TRUNCATED if fault == CUT else 0
        for p in STATES:
            options = [(MOVES[p, initial], KEEP + extra, "K")] if (p, initial) in MOVES else []
            options += [(MOVES[p, NEXT[p]], REROLE + extra, "R")]
            for q, cost, edit in options:
                out[p, q] = min(out.get((p, q), (1 << 60, "")), (cost, edit))
    return combine(combine(INSERTED, out), INSERTED)


LEAVES = [_terminal(i) for i in range(len(CODES))]


@lru_cache(1 << 16)
def _chart(codes: bytes) -> Cell:
    """The cell of a block, from the chart of all its spans."""
    n = len(codes)
    chart = {(i, 1): LEAVES[c] for i, c in enumerate(codes)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = {}
            for k in range(1, length):
                combine(chart[i, k], chart[i + k, length - k], cell)
            chart[i, length] = cell
    return chart[0, n]


def join_cells(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans, by doubling lengths."""
    while len(cells) > 1:
        cells = [combine(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else INSERTED


def parse(codes: bytes) -> Cell:
    return join_cells([_chart(codes[i : i + BLOCK]) for i in range(0, len(codes), BLOCK)])


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest repair; ties go to the ASCII-least audit."""
    return min(cell[EMPTY, q] for q in FINAL if (EMPTY, q) in cell)


def code_of(role: str, fault: int) -> bytes:
    return CODE[role[:1] if role[:1] in ("s", "u", "a") else "-", fault]


def fault_of(text: str, repeated: bool) -> str | None:
    """A turn's first fault."""
    body = text.rstrip(BLANK_CHARS)
    if not body:
        return "blank"
    if repeated:
        return "duplicate"
    return None if body[-1] in ".!?" else "truncated"


KIND = {None: SOUND, "blank": GOES, "duplicate": GOES, "truncated": CUT}


class _Digest:
    """SHA-256 of the repaired turns, as they stream past the audit."""

    def __init__(self, audit: str):
        self.edits, self.state, self.sha, self.first, self.at = audit, EMPTY, hashlib.sha256(), True, 0

    def _put(self, role: str, text: str):
        self.sha.update((("" if self.first else "\n") + f"{role}:{text}").encode())
        self.first = False

    def _inserted(self):
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            role = NEXT[self.state]
            self._put(ROLE[role], "")
            self.state, self.at = MOVES[self.state, role], self.at + 1

    def turn(self, role: str, text: str):
        self._inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "D":
            return
        initial = NEXT[self.state] if edit == "R" else role[:1]
        self._put(ROLE[initial] if edit == "R" else role, text)
        self.state = MOVES[self.state, initial]

    def hexdigest(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "conv_id {}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"


class _Facts:
    """Counts over a run of turns in order; runs of one conversation can be joined."""

    def __init__(self):
        self.n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first_role = self.last_role = self.low = self.high = None
        self.turns = 0

    def add(self, turn, initial: str, fault: str | None):
        if fault:
            self.n[fault] += 1
        if self.last_role is None:
            self.first_role = initial
        elif self.last_role + initial not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.last_role = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def join(self, later: _Facts):
        for k, v in later.n.items():
            self.n[k] += v
        if self.last_role is not None and later.first_role is not None and self.last_role + later.first_role not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        if self.first_role is None:
            self.first_role = later.first_role
        self.last_role = later.last_role if later.last_role is not None else self.last_role
        if later.low is not None:
            self.turns += later.turns - (later.low == self.high)
            self.low, self.high = later.low if self.low is None else self.low, later.high

    def row(self, conv, cost: int, audit: str, digest: str | None):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (conv, gaps, *(self.n[k] for k in ("blank", "duplicate", "truncated", "illegal")), cost, audit, digest)


def _table(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)
    rows.clear()
    return out


_NAMES = ["conv_id", *COUNTS, "audit", "repaired_sha256"]


def _types(kind):
    return [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]


def _whole(conv, rows: list[tuple]) -> tuple:
    """The result of one conversation that is held whole."""
    facts, seen, codes = _Facts(), set(), []
    for turn, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        facts.add(turn, role[:1], fault)
        codes.append(code_of(role, KIND[fault]))
    cost, audit = best(parse(b"".join(codes)))
    digest = _Digest(audit)
    for _, role, text in rows:
        digest.turn(role, text)
    return facts.row(conv, cost, audit, digest.hexdigest())


def _conversations(batches):
    """Rows sorted by conversation and turn to one result for each conversation."""
    current, rows, out, kind = None, None, [], None
    held = 0
    for batch in batches:
        kind = batch.schema.types[0]
        for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if rows is None or conv != current:
                if rows is not None:
                    out.append(_whole(current, rows))
                    held += len(out[-1][-2])
                    if len(out) >= X.BATCH_ROWS or held > X.CHUNK_BYTES:
                        yield _table(out, _NAMES, _types(kind))
                        held = 0
                current, rows = conv, []
            if role is not None:  # else a mark of a turn that was lost
                rows.append((turn, role, text))
    if rows is not None:
        out.append(_whole(current, rows))
    if out:
        yield _table(out, _NAMES, _types(kind))


_CELLS = ["conv_id", "pos", "facts", "cell"]


def _segments(batches):
    """Narrow rows in order (conv_id, pos, turn, initial, fault) to cells of runs."""
    current, facts, codes, start, out, kind = None, None, [], 0, [], None

    def closed():
        cell = {f"{p}{q}": v for (p, q), v in parse(b"".join(codes)).items()}
        return current, start, json.dumps(vars(facts)), json.dumps(cell)
    types = lambda: [kind, pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        kind = batch.schema.types[0]
        for conv, pos, turn, initial, fault in zip(*(batch.column(c).to_pylist() for c in range(5))):
            if facts is None or conv != current or len(codes) >= SEGMENT:
                if facts is not None:
                    out.append(closed())
                    yield _table(out, _CELLS, types())
                current, facts, codes, start = conv, _Facts(), [], pos
            facts.add(turn, initial, fault or None)
            codes.append(code_of(initial, KIND[fault or None]))
    if facts is not None:
        out.append(closed())
        yield _table(out, _CELLS, types())


def _joined(batches):
    """Cells of each conversation in order to its result, but for the digest."""
    current, facts, cells, out, kind = None, None, [], [], None

    def closed():
        return facts.row(current, *best(join_cells(cells)), None)
    for batch in batches:
        kind = batch.schema.types[0]
        for conv, _, saved, cell in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if facts is None or conv != current:
                if facts is not None:
                    out.append(closed())
                    yield _table(out, _NAMES, _types(kind))
                current, facts, cells = conv, _Facts(), []
            later = _Facts()
            vars(later).update(json.loads(saved))
            facts.join(later)
            cells.append({(int(k[0]), int(k[1])): tuple(v) for k, v in json.loads(cell).items()})
    if facts is not None:
        out.append(closed())
        yield _table(out, _NAMES, _types(kind))


def _streamed(batches):
    """Rows by (conv_id, pos), the first of each conversation holding its result."""
    result, digest, out, kind = None, None, [], None
    for batch in batches:
        kind = batch.schema.types[0]
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            conv, pos, role, text, rest = row[0], row[1], row[2], row[3], row[4:]
            if pos < 0:
                if digest is not None:
                    out.append((*result, digest.hexdigest()))
                    yield _table(out, _NAMES, _types(kind))
                result, digest = (conv, *rest), _Digest(rest[-1])
            else:
                digest.turn(role, text)
    if digest is not None:
        out.append((*result, digest.hexdigest()))
        yield _table(out, _NAMES, _types(kind))


def _hot(rows: DataFrame, kind: str) -> DataFrame:
    """Results of conversations too large for one task."""
    order = ["conv_id", "turn", "role", "text", "tie"]
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    turns = stored(ranged.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "repair-turns")
    body = F.rtrim(F.col("text"), F.lit(BLANK_CHARS))
    narrow = turns.select("conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), (body == "").alias("blank"),
                          (~F.substring(body, -1, 1).isin(*".!?")).alias("cut"),
                          F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("same"))
    firsts = narrow.groupBy("conv_id", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    coded = narrow.drop("same").join(firsts, "pos", "left").select("conv_id", "pos", "turn", "initial", fault.alias("fault"))
    cells = coded.repartitionByRange("pos").sortWithinPartitions("pos").mapInArrow(_segments, f"conv_id {kind}, pos bigint, facts string, cell string")
    results = cells.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_joined, RESULT.format(kind))
    counts = [c for c in _NAMES if c not in ("conv_id", "repaired_sha256")]
    heads = results.select("conv_id", F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), *counts)
    lines = turns.select("conv_id", "pos", "role", "text", *[F.lit(None).cast(t).alias(c) for c, t in results.dtypes if c in counts])
    stream = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return stream.mapInArrow(_streamed, RESULT.format(kind))


def repair(turns: DataFrame, known: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", hot_rows: int = HOT_ROWS, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """One row per conversation of ``turns``, and of ``known`` (conv_id) if given,
    whose conversations may have no turn left: counts of faults, cost and audit of the
    cheapest repair, and the digest of the repaired conversation."""
    c = lambda name: F.col(f"`{name}`")
    text = lambda name: F.coalesce(c(name).cast("string"), F.lit(" "))
    rows = turns.select(c(conv_col).alias("conv_id"), c(turn_col).cast("bigint").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    size = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("bytes"))
    hot = stored(size.filter((F.col("n") > hot_rows) | (F.col("bytes") > hot_bytes)).select(F.col("conv_id").alias("hot_id")), "repair-hot")
    any_hot = bool(hot.head(1))
    same = F.col("conv_id").eqNullSafe(F.col("hot_id"))
    plain = rows.join(hot, same, "left_anti") if any_hot else rows
    if known is not None:
        marks = known.select(c(conv_col).alias("conv_id")).distinct()
        if any_hot:
            marks = marks.join(hot, same, "left_anti")
        plain = plain.unionByName(marks, allowMissingColumns=True)
    X.limit_batches(turns.sparkSession)
    dealt = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    found = dealt.mapInArrow(_conversations, RESULT.format(kind))
    return found.unionByName(_hot(rows.join(hot, same, "left_semi"), kind)) if any_hot else found


def damage(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with every fault there is, at places that
    depend on the ids alone: 0 lost, 1 emptied, 2 without [.!?], 3 repeated, 4 user."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    changed = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("times"))
    return changed.select("conv_id", "turn", "role", "text", F.explode("times").alias("copy")).drop("copy")
