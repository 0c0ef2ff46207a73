"""Byte-level BPE encoding and decoding with a published vocabulary.

The vocabulary file is read once on the driver (tens of thousands of entries)
and broadcast; executors need neither the file nor a tokenizer library. Texts
are cut at the special tokens, then into words by the published pattern. A word
is merged over a contiguous rank array: part boundaries and the rank of each
adjacent pair; scan for the least rank, delete that boundary, refresh the two
neighbouring ranks. Words of over LONG_WORD bytes use a heap over the same parts
(the scan is quadratic), with equal results. Encoded words are kept with their ids
in a bounded table per worker, which goes when the worker drops the broadcast: a
worker outlives its stage, and later stages need the memory.

A null text is empty and has no tokens. Every row is encoded by itself, so
repeated rows and ties need no rule. An empty table gives no rows, and further
columns do not matter. A text of any length is encoded whole, in a few times its size.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X

LONG_WORD = 96
CACHE_WORDS = 400_000
#: A pair of ids, and a rank with the id it makes, are one integer each.
ID_BITS = 24
ID_MASK, NO_RANK = (1 << ID_BITS) - 1, 1 << 60

# Unicode White_Space.
SPACES = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _ranges(letter: str, last_code: int) -> str:
    """A character class of all code points whose category starts with ``letter``."""
    out, first, last = [], None, None
    for code in range(last_code + 1):
        if unicodedata.category(chr(code))[0] == letter:
            if last != code - 1:
                if first is not None:
                    out.append((first, last))
                first = code
            last = code
    out.append((first, last))
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def word_pattern(last_code: int = sys.maxunicode) -> re.Pattern:
    """The vocabulary's published pattern, with \\p{L}, \\p{N} and \\s spelt out for
    texts of code points up to ``last_code``; small classes match much faster."""
    letter, number = _ranges("L", last_code), _ranges("N", last_code)
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{SPACES}{letter}{number}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(plain))
    return table


class Vocabulary:
    """Ids, bytes and pair ranks of a byte-level BPE file; fits in a broadcast."""

    encoder: Encoder | None = None

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self._read(f.read())

    @classmethod
    def from_text(cls, raw: str) -> Vocabulary:
        made = cls.__new__(cls)
        made._read(raw)
        return made

    def _read(self, raw: str) -> None:
        source = json.loads(raw)
        back = {c: b for b, c in byte_characters().items()}
        spelt = {token: bytes(back[c] for c in token) for token in source["model"]["vocab"]}
        ids = {spelt[token]: i for token, i in source["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in source["added_tokens"]}
        self.bytes_of = {i: b for b, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.pairs = {}
        for rank, merge in enumerate(source["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[ids[spelt[a]] << ID_BITS | ids[spelt[b]]] = rank << ID_BITS | ids[spelt[a] + spelt[b]]


def merge_short(parts: list[int], pairs: dict[int, int]) -> list[int]:
    """Repeatedly join the leftmost pair of least rank."""
    ranks = [pairs.get(a << ID_BITS | b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while ranks:
        best = min(ranks)
        if best == NO_RANK:
            break
        i = ranks.index(best)
        parts[i] = best & ID_MASK
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = pairs.get(parts[i] << ID_BITS | parts[i + 1], NO_RANK)
        if i:
            ranks[i - 1] = pairs.get(parts[i - 1] << ID_BITS | parts[i], NO_RANK)
    return parts


def merge_long(parts: list[int], pairs: dict[int, int]) -> list[int]:
    """The same joins from a heap of (rank, place), over a linked list."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(pairs[p], i, p) for i, p in enumerate(a << ID_BITS | b for a, b in zip(parts, parts[1:])) if p in pairs]
    heapq.heapify(heap)
    while heap:
        best, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= n or parts[i] << ID_BITS | parts[j] != pair or parts[i] < 0:
            continue
        parts[i], parts[j] = best & ID_MASK, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for x in (before[i], i):
            if x >= 0 and after[x] < n and (p := parts[x] << ID_BITS | parts[after[x]]) in pairs:
                heapq.heappush(heap, (pairs[p], x, p))
    return [p for p in parts if p >= 0]


class Encoder(dict):
    """word → its ids (32 bit, native order); filled on first use. Words not met
    since the table was last half full leave it. It does not refer to the vocabulary,
    which holds it."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.single, self.pairs, self.special, self.older = vocabulary.single, vocabulary.pairs, vocabulary.special, {}
        self.pattern, self.latin = word_pattern(), word_pattern(0xFF)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        self.spelling = [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of) + 1)]
        self.packed = [i.to_bytes(4, sys.byteorder) for i in range(len(self.spelling))]
        self.written = [str(i) for i in range(len(self.spelling))]

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            raw = word.encode()
            merge = merge_short if len(raw) <= LONG_WORD else merge_long
            found = b"".join(map(self.packed.__getitem__, merge([self.single[b] for b in raw], self.pairs)))
            if len(raw) > LONG_WORD:
                return found
        if len(self) >= CACHE_WORDS // 2:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    def ids(self, text: str) -> memoryview:
        pieces = [text] if self.cut is None else self.cut.split(text)
        try:
            pattern = self.latin if text.isascii() or text.encode("latin-1") else self.pattern
        except UnicodeEncodeError:
            pattern = self.pattern
        out = []
        for k, piece in enumerate(pieces):
            if k % 2:
                out.append(self.packed[self.special[piece]])
            elif piece:
                out.extend(map(self.__getitem__, pattern.findall(piece)))
        return memoryview(b"".join(out)).cast("I")

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.ids(text), np.uint32)

    def written_ids(self, ids: memoryview) -> str:
        return ",".join(map(self.written.__getitem__, ids))

    def decode(self, ids: memoryview | list[int]) -> str:
        return b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace")


def _encoder(held) -> Encoder:
    """The worker's encoder, kept on the broadcast vocabulary."""
    v = held.value
    if v.encoder is None:
        v.encoder = Encoder(v)
    return v.encoder


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and,
    with ``with_ids``, the token ids."""
    held = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _encoder(held)
        n, sha, decoded, ids = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = coder.ids(text or "")
            n.append(len(found))
            sha.append(hashlib.sha256(coder.written_ids(found).encode()).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(found).encode()).hexdigest())
            if with_ids:
                ids.append(np.frombuffer(found, np.int32))
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(decoded, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), np.concatenate([*ids, np.zeros(0, np.int32)])))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)
    rows = X.named(docs, doc_id=id_col, text=text_col)
    kind = rows.schema[0].dataType.simpleString()
    return X.map_batches(rows, run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def decode(rows: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts from token ids; invalid UTF-8 becomes U+FFFD, as in the library."""
    held = rows.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = _encoder(held)
        texts = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    named = X.named(rows, doc_id=id_col, ids=ids_col).withColumn("ids", F.col("ids").cast("array<int>"))
    return X.map_batches(named, run, f"doc_id {named.schema[0].dataType.simpleString()}, text string")
