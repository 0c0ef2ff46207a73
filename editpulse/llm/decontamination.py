"""Benchmark decontamination by n-gram windows.

The windows of all benchmark items form a hash set that is broadcast in blocks
of bounded size; every block is one narrow pass over the documents, so the
documents are never shuffled. Between blocks the documents are written to the
shared folder: a task holds one block, however many there are. A task hashes all
windows of its texts at once, looks them up, and compares the words of each
candidate with the item's.

A window is ``width`` consecutive words of an item; an item of fewer words, but
not none, is one window. A null or empty text has no words and no hits, a null
item has no windows, an item without an id is reported as ``null``. Repeated
documents get equal rows; further columns are passed on where asked for.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.session import stored

WIDTH = 10
#: (window, item) pairs in one broadcast block.
BLOCK_PAIRS = 500_000

SCANNED = "n_words bigint, n_hit bigint, items array<string>, hits array<bigint>"


def item_windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, window, n): every distinct window of every item, as its words
    joined by blanks."""
    low = F.translate(F.col(f"`{text_col}`"), X.UPPER, X.LOWER)
    rows = items.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("item"),
        F.regexp_extract_all(low, F.lit(f"({X.WORD_PATTERN})"), F.lit(1)).alias("w"))
    short = F.size("w") <= width
    windows = F.when(short, F.array(F.array_join("w", " "))).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, width), " ")))
    return (rows.filter(F.size("w") > 0)
            .select("item", F.explode(windows).alias("window"), F.least(F.size("w"), F.lit(width)).alias("n")).distinct())


class WindowSet:
    """Windows of one block: a hash set for each window length, and the items
    of each window."""

    def __init__(self, rows):
        self.items: dict[bytes, list[str]] = {}
        by_length: dict[int, list[bytes]] = {}
        for item, window, n in rows:
            key = window.encode()
            if key not in self.items:
                by_length.setdefault(n, []).append(key)
            self.items.setdefault(key, []).append(item)
        self.sets = {n: X.HashSet(np.concatenate([self._hash(w, n) for w in keys])) for n, keys in by_length.items()}
        self.longest = max(self.sets, default=0)

    @staticmethod
    def _hash(window: bytes, n: int) -> np.ndarray:
        data = np.frombuffer(window, np.uint8)
        starts, ends, _ = X.words(data, np.array([0, len(data)]))
        return dict(X.window_hashes(X.word_hashes(data, starts, ends), n))[n]


def _scan_chunk(data, offsets, windows: WindowSet, before, known):
    """Per text: words, words hit, item ids, hit intervals (words). ``before``
    and ``known`` are the intervals and items of earlier blocks."""
    low = X.lowered(data)
    starts, ends, first = X.words(low, offsets)
    n = len(starts)
    step = np.zeros(n + 1, np.int32)
    found: dict[int, set[str]] = {}
    raw = low.tobytes()
    for k, h in X.window_hashes(X.word_hashes(low, starts, ends), windows.longest) if n else ():
        if k not in windows.sets:
            continue
        at = windows.sets[k].find(h)
        owner = np.searchsorted(first, at, "right") - 1
        inside = at + k <= first[owner + 1]
        for i, doc in zip(at[inside].tolist(), owner[inside].tolist()):
            key = b" ".join([raw[a:b] for a, b in zip(starts[i : i + k].tolist(), ends[i : i + k].tolist())])
            if key in windows.items:
                found.setdefault(doc, set()).update(windows.items[key])
                step[i] += 1
                step[i + k] -= 1
    touched = set(found)
    for doc, spans in enumerate(before):
        if len(spans):
            touched.add(doc)
            for a, b in zip(spans[::2], spans[1::2]):
                step[first[doc] + a] += 1
                step[first[doc] + b] -= 1
    hit = np.cumsum(step[:n]) > 0
    counts, hits = np.zeros(len(offsets) - 1, np.int64), [[] for _ in range(len(offsets) - 1)]
    items = [list(x) for x in known]
    for doc in touched:
        mask = np.zeros(first[doc + 1] - first[doc] + 2, np.int8)
        mask[1:-1] = hit[first[doc] : first[doc + 1]]
        edge = np.flatnonzero(np.diff(mask))
        hits[doc], counts[doc] = edge.tolist(), int(mask.sum())
        items[doc] = sorted(set(items[doc]) | found.get(doc, set()))
    return np.diff(first), counts, items, hits


def scan(docs: DataFrame, items: DataFrame, keep: list[str], width: int = WIDTH, text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``keep`` columns of ``docs`` with ``scan``: struct of n_words, n_hit,
    items (sorted) and hits (word intervals, flat)."""
    spark = docs.sparkSession
    pairs = stored(item_windows(items, width, item_id_col, item_text_col), "benchmark-windows")
    blocks = max(1, -(-pairs.count() // block_pairs))
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, names)], *[F.col(f"`{text_col}`").alias("t")] * (text_col not in keep))
    at = keep.index(text_col) if text_col in keep else len(keep)  # the text travels once
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema)
    block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    for b in range(blocks):
        held = spark.sparkContext.broadcast(WindowSet(pairs.filter(block == b).select("item", "window", "n").collect()))
        drop = b == blocks - 1 and text_col not in keep
        rows = X.map_batches(rows, _pass(held, b == 0, drop, at), schema + SCANNED)
        if b < blocks - 1:
            rows = stored(rows, "benchmark-block")
            held.unpersist()
    return rows.select(*[F.col(k).alias(c) for c, k in zip(keep, names)],
                       F.struct("n_words", "n_hit", "items", "hits").alias(X.fresh(docs, "scan")))


def _pass(held, opening: bool, drop: bool, at: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = list(batch.columns if opening else batch.columns[:-4])
        data, offsets = X.column_bytes(kept[at])
        old = None if opening else (batch.column("items").to_pylist(), batch.column("hits").to_pylist())
        n_words, n_hit, items, hits = [], [], [], []
        for lo, hi in X.chunks(offsets):
            known = old[0][lo:hi] if old else [[]] * (hi - lo)
            before = old[1][lo:hi] if old else [[]] * (hi - lo)
            a, b, c, d = _scan_chunk(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], held.value, before, known)
            n_words.append(a), n_hit.append(b), items.extend(c), hits.extend(d)
        names = batch.schema.names[: len(kept)]
        if drop:
            kept[at] = pa.nulls(batch.num_rows, pa.string())
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_hit)),
             pa.array(items, pa.list_(pa.string())), pa.array(hits, pa.list_(pa.int64()))],
            names=[*names, "n_words", "n_hit", "items", "hits"])
    return run


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: words, hit words, and the items found in it."""
    scanned = scan(X.named(docs, doc_id=id_col, text=options.pop("text_col", "text")), items, ["doc_id"], **options)
    s = F.col("scan")
    return scanned.select(
        "doc_id", s.n_words.alias("n_words"), s.n_hit.alias("n_hit"), F.size(s["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(s["items"], ",").cast("binary"), 256).alias("items_sha256"), (s.n_hit > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Documents without any benchmark window, all columns as they were."""
    scanned = scan(docs, items, docs.columns, **options)
    mark = scanned.columns[-1]
    return scanned.filter(F.col(f"`{mark}`.n_hit") == 0).drop(mark)


def remove_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents; from each text the hit words go, with what stands
    between the words of one hit interval. Clean texts stay byte for byte."""
    scanned = scan(docs, items, docs.columns, text_col=text_col, **options)
    mark = scanned.columns[-1]
    at = docs.columns.index(text_col)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        for i, s in enumerate(spans):
            if s["hits"]:
                raw = texts[i].encode()
                starts, ends, _ = X.words(X.lowered(np.frombuffer(raw, np.uint8)), np.array([0, len(raw)]))
                out, last = [], 0
                for a, b in zip(s["hits"][::2], s["hits"][1::2]):
                    out.append(raw[last : starts[a]])
                    last = ends[b - 1]
                texts[i] = b"".join([*out, raw[last:]]).decode()
        columns = batch.columns[:-1]
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return X.map_batches(scanned, cut, schema)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
