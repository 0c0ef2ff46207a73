"""Conversation repair against a search over single edits."""

import hashlib
import heapq
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from editpulse.llm import repair as R
from editpulse.llm import queries as Q
from test_dealt import SMALL

BLANK = " \t\n\x0b\x0c\r"


def well_formed(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return (rest != "" or initials == "") and rest == "ua" * (len(rest) // 2)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(BLANK)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def search(rows):
    """(cost, audit, repaired turns) by uniform-cost search over edits in order."""
    marks = faults(rows)
    heap, done = [(0, "", 0, ())], set()
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        initials = "".join(r[:1] if len(r[:1]) else "-" for r, _ in made)
        if i == len(rows) and well_formed(initials):
            return cost, audit, made
        prefix = initials[1:] if initials[:1] == "s" else initials
        state = (i, initials[:1] == "s", len(prefix) % 2, bool(prefix))
        if prefix != ("ua" * len(prefix))[: len(prefix)] or state in done:  # only the first way into a state can be the least one
            continue
        done.add(state)
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", i, (*made, (role, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, made))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 if marks[i] else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, (*made, (role, text))))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, (*made, (new, text))))


def every(rows):
    """The same by trying all edits, with at most two insertions at a place."""
    marks, best = faults(rows), None
    gaps = [()] + [(a,) for a in "ua"] + list(itertools.product("ua", repeat=2))
    names = {"u": "user", "a": "assistant"}
    for edits in itertools.product(("K", "D", "Ru", "Ra"), repeat=len(rows)):
        if any(m in ("blank", "duplicate") and e != "D" for m, e in zip(marks, edits)):
            continue
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, made = 0, "", []
            for i in range(len(rows) + 1):
                cost += 5 * len(put[i])
                audit += "I" * len(put[i])
                made += [(names[c], "") for c in put[i]]
                if i < len(rows):
                    cost += {"K": 0, "D": 2}.get(edits[i], 1) + (5 if marks[i] == "truncated" and edits[i] != "D" else 0)
                    audit += edits[i][0]
                    if edits[i] != "D":
                        made.append((rows[i][1] if edits[i] == "K" else names[edits[i][1]], rows[i][2]))
            if well_formed("".join(r[:1] or "-" for r, _ in made)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, tuple(made))
    return best


def expected(rows):
    """The result of one conversation from its turns in order."""
    turns = [t for t, _, _ in rows if t is not None]
    marks = faults(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, made = search(rows)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


COLUMNS = (*R.COUNTS, "audit", "repaired_sha256")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def by_conversation(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, role, text))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def check(found, rows):
    want = by_conversation(damaged(rows))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert got.keys() == {r[0] for r in rows} and found.count() == len(got)
    for conv, result in got.items():
        assert result == expected(want.get(conv, []))


@pytest.mark.parametrize("limit", [R.HOT_ROWS, 3])
def test_query_brute_force(spark, monkeypatch, limit):
    """All conversations, held whole and dealt by ranges of turns."""
    rows = [tuple(r) for r in Q.table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    monkeypatch.setattr(R.repair, "__defaults__", tuple(limit if d == R.HOT_ROWS else d for d in R.repair.__defaults__))
    monkeypatch.setattr(R, "SEGMENT", min(limit, R.SEGMENT))
    check(Q.op13_repair(spark, SMALL), rows)


def random_rows(rng, n, roles=("system", "user", "assistant", "user", "assistant", "", "other", "ua"), texts=("a.", "b", "", " ", "c!", "d?\n", "e. f", "　")):
    return sorted((i // 2 if rng.random() < 0.3 else i, rng.choice(roles), rng.choice(texts)) for i in range(n))


def test_cells_against_search_and_enumeration():
    rng = random.Random(3)
    for n, tries in ((0, 1), (1, 60), (2, 60), (3, 40)):
        for _ in range(tries):
            rows = random_rows(rng, n)
            assert search(rows) == every(rows)
    for _ in range(400):
        rows = random_rows(rng, rng.randrange(0, 40))
        assert R._whole(1, rows)[1:] == expected(rows)


def test_any_split_gives_the_chart():
    """Blocks, doubling spans and other cuts agree with the chart of the whole."""
    rng = random.Random(5)
    for _ in range(60):
        codes = bytes(rng.randrange(len(R.CODES)) for _ in range(rng.randrange(1, 20)))
        whole = R._chart(codes)
        assert R.parse(codes) == whole
        cut = rng.randrange(len(codes) + 1)
        assert R.join_cells([R.parse(codes[:cut]), R.parse(codes[cut:])]) == whole


EDGES = [(1, 0, "user", "x" * 2_000_000 + "."), (1, 1, "assistant", "y"), (None, 1, "user", "hi."), (None, None, "assistant", "ho."), (2, None, None, None), (2, None, None, None),
         (3, -5, "system", "s."), (3, 7, "user", "q?"), (3, 7, "user", "q?"), (3, 9, "assistant", "a!"), (4, 1, "System", "A."), (5, 1, "", "."), (6, 2, "assistant", "same."), (6, 3, "assistant", "same."),
         (6, 3, "user", "\x1c"), (7, 1, "user\n", "a\n.\n")]
EDGES += [(8, t, "user" if t % 2 else "assistant", f"turn {t % 9}.") for t in range(60)] + [(9, 4, "user", "again.")] * 25


@pytest.mark.parametrize("limit", [R.HOT_ROWS, 1])
def test_edge_cases(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "SEGMENT", 7)
    turns = spark.createDataFrame(EDGES, "conv_id bigint, turn bigint, role string, text string").withColumn("pos", F.lit("clash")).withColumn("hot_id", F.lit(1)).repartition(3)
    check(R.repair(R.damage(turns), known=turns, hot_rows=limit), EDGES)
    plain = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in R.repair(turns, hot_rows=limit).collect()}
    for conv, rows in by_conversation([(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in EDGES]).items():
        assert plain[conv] == expected(rows)
    assert R.repair(turns.limit(0), known=turns.limit(0)).count() == 0


def test_lost_conversation(spark):
    """No turn left: zeros, no audit, the digest of nothing."""
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    turns = spark.createDataFrame([(conv, 1, "user", "a.")], "conv_id bigint, turn bigint, role string, text string")
    row, = R.repair(R.damage(turns), known=turns).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
