"""Token alignment between two tokenizers by interval coalescing.

Each text is encoded twice: a blank and the text by a byte-level BPE file (A), the
text by a piece model (B, which adds the blank itself). All tokens of a block of
texts are sorted by start; the running maximum of their ends is taken, and a group
breaks where a start reaches it, so a group ends where tokens of both end. Within a
group the overlaps expand: every A token is linked with every B token.

A pair's count is the number of documents that hold it linked. The distinct pairs
of a document, with their numbers of links, are written once to the shared folder
and counted from there. Pairs are then looked up in two ways that together hold
all of them: at most FREQUENT pairs of the highest counts in a broadcast table, the
rest by a join on the pair; no pair of the rest can stand in a large share of all rows,
so the join has no hot key.

The links of a group are a product and may be far more than its tokens (a long text
without common ends). Such texts are expanded by slices of A ids, at most PART_LINKS
links at a time, and a single A id beyond that by counting its groups' B tokens; their
pairs leave in several rows. A task holds the tokens of one block (a longer text alone).

Null and empty texts, and texts that one of the tokenizers does not spell back byte
for byte, have no tokens: zeros and an empty group string. Rows are aligned one by
one, so a repeated row counts again, as one more document; an empty table gives no
rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.llm.bpe import Encoder, Vocabulary, byte_characters
from editpulse.session import stored

FREQUENT = 250_000
PART_LINKS = 1 << 20
#: Links a byte of text beyond which a text is expanded in slices.
DENSE = 8
#: The splitting library recurses over blank runs; longer runs take the other encoder.
BLANK_RUN = 10_000

# Fixed value: the published word pattern of the byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteTokens:
    """A: ids and bytes of a byte-level BPE file; special tokens are plain text."""

    def __init__(self, raw: str):
        import tiktoken
        source = json.loads(raw)
        back = {c: b for b, c in byte_characters().items()}
        special = {t["content"] for t in source["added_tokens"]}
        spelt = {bytes(back[c] for c in token): i for token, i in source["model"]["vocab"].items() if token not in special}
        self.bytes_of = [b""] * (max(spelt.values()) + 1)
        for b, i in spelt.items():
            self.bytes_of[i] = b
        # An encoder by ranks gives the file's ids where ids follow the order of merges.
        made = [spelt[bytes(back[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in source["model"]["merges"]]
        if made != sorted(made) or (made and made[0] < 256):
            raise ValueError("ids do not follow the order of the merges")
        self.ranks = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=spelt, special_tokens={})
        self._raw, self._slow = raw, None

    def encode(self, text: str) -> list[int]:
        if len(text) > BLANK_RUN and _has_blank_run(text):
            if self._slow is None:
                self._slow = Encoder(Vocabulary.from_text(self._raw))
                self._slow.cut = None
            return self._slow.encode(text).tolist()
        return self.ranks.encode_ordinary(text)


def _has_blank_run(text: str) -> bool:
    import re
    return re.search(r"\s{%d}" % BLANK_RUN, text) is not None


class PieceTokens:
    """B: ids and bytes of a piece model; U+2581 is a blank, <0xHH> a byte."""

    def __init__(self, raw: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        piece = self.model.id_to_piece
        self.bytes_of = [bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode()
                         for i in range(self.model.get_piece_size())]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1) if text else []


class Aligner:
    """Both tokenizers and their tables, made once in each worker."""

    def __init__(self, byte_file: str, piece_model: bytes):
        self.a, self.b = ByteTokens(byte_file), PieceTokens(piece_model)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b))
        self.n_a, self.n_b = len(self.size_a), len(self.size_b)
        # Written ids: A inside and at the end of its side, then B.
        self.written = [f"{i}{mark}".encode() for n, mark in ((self.n_a, ","), (self.n_a, "|"), (self.n_b, ","), (self.n_b, ";")) for i in range(n)]

    def tokens(self, text: str | None) -> tuple[list[int], list[int]] | None:
        """Ids of both, or None where one does not spell the text back."""
        if not text:
            return None
        raw = b" " + text.encode()
        a, b = self.a.encode(" " + text), self.b.encode(text)
        same = b"".join(map(self.a.bytes_of.__getitem__, a)) == raw == b"".join(map(self.b.bytes_of.__getitem__, b))
        return (a, b) if same else None


def coalesce(start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Group number of each interval; a group breaks where the next start
    reaches the running maximum of the ends."""
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group


def _expand(a: np.ndarray, of: np.ndarray, b: np.ndarray, first_b: np.ndarray, count_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the A token, B id) of every link of the A tokens ``a`` in groups ``of``."""
    times = count_b[of]
    place = np.repeat(np.arange(len(a)), times)
    within = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
    return place, b[first_b[of][place] + within]


def _slices(a: np.ndarray, of: np.ndarray, b: np.ndarray, of_b: np.ndarray, first_b, count_b, n_b: int):
    """(pairs, links) of one dense text, a bounded number of links at a time."""
    order = np.argsort(a, kind="stable")
    a, of = a[order], of[order]
    weight = np.cumsum(count_b[of])
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    ends = np.append(starts[1:], len(a))
    at = 0
    while at < len(starts):
        before = weight[starts[at]] - count_b[of[starts[at]]]
        last = int(np.searchsorted(weight[ends - 1], before + PART_LINKS, "right"))
        if last <= at:  # one A id beyond the bound: count the B tokens of its groups
            held = np.bincount(of[starts[at] : ends[at]], minlength=len(count_b))
            links = np.bincount(b, held[of_b]).astype(np.int64)
            found = np.flatnonzero(links)
            yield int(a[starts[at]]) * n_b + found, links[found]
            at += 1
        else:
            part = slice(starts[at], ends[last - 1])
            place, other = _expand(a[part], of[part], b, first_b, count_b)
            yield np.unique(a[part][place] * n_b + other, return_counts=True)
            at = last


def _block(aligner: Aligner, found: list[tuple[list[int], list[int]]]):
    """For each text of a block: (groups, links, group string digest, [(pairs, links)])."""
    n_a, n_b = (np.array([len(t[k]) for t in found]) for k in (0, 1))
    a, b = (np.concatenate([np.array(t[k], np.int64) for t in found]) for k in (0, 1))
    end_a, end_b = np.cumsum(aligner.size_a[a]), np.cumsum(aligner.size_b[b])
    end = np.concatenate([end_a, end_b])
    kind = np.repeat([0, 1], [len(a), len(b)])
    group = coalesce(end - np.concatenate([aligner.size_a[a], aligner.size_b[b]]), end, kind)
    of_a, of_b = group[: len(a)], group[len(a) :]
    count_a, count_b = np.bincount(of_a), np.bincount(of_b)
    first_b = np.cumsum(count_b) - count_b
    at_a = np.concatenate([[0], np.cumsum(n_a)])
    at_b = np.concatenate([[0], np.cumsum(n_b)])
    at_group = np.append(of_a[at_a[:-1]], len(count_a))
    links = np.add.reduceat(count_a * count_b, at_group[:-1])

    # The group string: tokens by (group, side), each with the mark that follows it.
    last = np.empty(len(group), bool)
    last[: len(a)] = np.append(of_a[1:] != of_a[:-1], True)
    last[len(a) :] = np.append(of_b[1:] != of_b[:-1], True)
    code = np.concatenate([a, b + 2 * aligner.n_a]) + last * np.repeat([aligner.n_a, aligner.n_b], [len(a), len(b)])
    pieces = list(map(aligner.written.__getitem__, code[np.lexsort((kind, group))].tolist()))
    ends = (at_a + at_b).tolist()
    digests = [hashlib.sha256(b"".join(pieces[x:y])[:-1]).hexdigest() for x, y in zip(ends, ends[1:])]

    size = np.diff(np.append(end_a[at_a[:-1]] - aligner.size_a[a[at_a[:-1]]], end_a[-1]))
    dense = links > DENSE * size
    doc_a = np.repeat(np.arange(len(found)), n_a)
    plain = ~dense[doc_a]
    place, other = _expand(a[plain], of_a[plain], b, first_b, count_b)
    span = aligner.n_a * aligner.n_b
    keys, times = np.unique(doc_a[plain][place] * span + a[plain][place] * aligner.n_b + other, return_counts=True)
    cut = np.searchsorted(keys, np.arange(len(found) + 1) * span)
    for i in range(len(found)):
        if dense[i]:
            x, y = slice(at_a[i], at_a[i + 1]), slice(at_b[i], at_b[i + 1])
            base, n = at_group[i], at_group[i + 1] - at_group[i]
            counts = count_b[base : base + n]
            parts = _slices(a[x], of_a[x] - base, b[y], of_b[y] - base, np.cumsum(counts) - counts, counts, aligner.n_b)
        else:
            parts = iter([(keys[cut[i] : cut[i + 1]] - i * span, times[cut[i] : cut[i + 1]])])
        yield int(at_group[i + 1] - at_group[i]), int(links[i]), digests[i], parts


COLUMNS = "rid bigint, part int, doc_id {}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, links array<bigint>"


def _rows(aligner: Aligner, batch: pa.RecordBatch):
    """Batches of aligned rows, one for each block of texts; a dense text gives more."""
    kind, ids, rids = batch.schema.types[1], batch.column(1), batch.column(0)
    _, offsets = X.column_bytes(batch.column(2))
    for lo, hi in X.chunks(offsets):
        found = [aligner.tokens(t) for t in batch.column(2).slice(lo, hi - lo).to_pylist()]
        real = [t for t in found if t is not None]
        done = _block(aligner, real) if real else iter(())
        rows, pairs, links, held = [], [], [], 0

        def table():
            flat = lambda arrays: pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32), np.concatenate([*arrays, np.zeros(0, np.int64)]).astype(np.int64))
            types = [pa.int64(), pa.int32(), kind, *[pa.int64()] * 4, pa.string()]
            out = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)] + [flat(pairs), flat(links)]
            for x in (rows, pairs, links):
                x.clear()
            return pa.RecordBatch.from_arrays(out, names=[c.split(" ")[0] for c in COLUMNS.split(", ")])
        for k, tokens in enumerate(found, lo):
            rid, doc = rids[k].as_py(), ids[k].as_py()
            if tokens is None:
                groups, n_links, digest, parts = 0, 0, "", [(np.zeros(0, np.int64),) * 2]
                tokens = ((), ())
            else:
                groups, n_links, digest, parts = next(done)
            for part, (pair, times) in enumerate(parts):
                rows.append((rid, part, doc, len(tokens[0]), len(tokens[1]), groups, n_links, digest))
                pairs.append(pair)
                links.append(times)
                held += len(pair)
                if held > PART_LINKS:
                    yield table()
                    held = 0
        if rows:
            yield table()


_aligners: dict[int, Aligner] = {}


def _aligner(held) -> Aligner:
    if id(held.value) not in _aligners:
        _aligners.clear()
        _aligners[id(held.value)] = Aligner(*held.value)
    return _aligners[id(held.value)]


def aligned(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens, groups and distinct linked pairs of each document, stored. A pair
    is A id * size of B + B id; rows with ``part`` above 0 only carry more pairs."""
    with open(byte_file, encoding="utf-8") as f, open(piece_file, "rb") as g:
        held = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    rows = X.named(docs, doc_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _rows(_aligner(held), batch)
    X.limit_batches(docs.sparkSession)
    return stored(rows.mapInArrow(run, COLUMNS.format(rows.schema["doc_id"].dataType.simpleString())), "aligned")


def pair_counts(base: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): documents that hold each pair, and whether no other pair
    of its A id is held by more. Stored."""
    counts = stored(base.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    first = F.expr(f"pair div {n_b}")
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return stored(counts.withColumn("a", first).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def least_frequent_count(counts: DataFrame, limit: int) -> int:
    """The least power of two n such that at most ``limit`` pairs have that count or more."""
    level = F.floor(F.log2("n")).cast("int").alias("level")
    held, least = 0, 1 << 62
    for r in sorted(counts.groupBy(level).count().collect(), key=lambda r: -r.level):
        held += r["count"]
        if held > limit:
            break
        least = 1 << r.level
    return least


def align(docs: DataFrame, byte_file: str, piece_file: str, frequent: int = FREQUENT, **columns: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256,
    n_best (links whose pair has its A id's highest count) and count_sum."""
    import sentencepiece
    n_b = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    base = aligned(docs, byte_file, piece_file, **columns)
    counts = pair_counts(base, n_b)
    least = least_frequent_count(counts, frequent)
    held = base.select("rid", F.inline(F.arrays_zip("pairs", "links"))).withColumnRenamed("pairs", "pair")
    top = F.broadcast(counts.filter(F.col("n") >= least))

    def sums(rows):
        return rows.groupBy("rid").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
    found = sums(held.join(top, "pair"))
    if least > 1:
        rare = counts.filter(F.col("n") < least)
        rest = held.join(top.select("pair"), "pair", "left_anti").join(rare.hint("merge"), "pair")
        found = found.unionByName(sums(rest)).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return base.filter("part = 0").drop("part", "pairs", "links").join(found, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
