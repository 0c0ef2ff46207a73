"""Exact de-duplication over an extendible-hash index on shared files.

1. A first narrow pass counts entries and bytes per hash prefix. From these the
   directory is built by doubling: a bucket above its capacity is split by the
   next bit, as long as bits are left. The directory has at most 2^MAX_DEPTH
   slots whatever the input, so it may be broadcast.
2. A second pass collapses equal texts inside each batch to one entry (text,
   largest id, number of rows, ids), so that a text held by a third of all rows
   is sent once per batch and not once per row. Entries go to the owner task of
   their bucket, sorted by hash; the owner chains the entries of one hash and
   compares bytes, so a hash collision never joins different texts. Resolved
   entries are written, without texts, to the shared folder.
3. Class sizes and the row that stays are summed from those files.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
equal texts the largest id stays (a null id is smaller than any). Repeated rows
count as rows of their own; with equal ids all of them carry the same decision.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.session import stored

#: Directory bits at most; 2^18 slots are one megabyte.
MAX_DEPTH = 18
#: Bytes of text in a bucket before it is split.
BUCKET_BYTES = 16 << 20

ENTRY = "h bigint, slot int, body binary, sha string, keep bigint, n bigint, ids array<bigint>"


def build_directory(histogram: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> np.ndarray:
    """slot → bucket number. ``histogram``: bytes per ``max_depth``-bit prefix."""
    size = np.zeros(1 << max_depth, np.int64)
    for prefix, n in histogram.items():
        size[prefix] = n
    total = np.concatenate([[0], np.cumsum(size)])
    depth, buckets = 0, [(0, 0)]  # (local depth, prefix)
    while True:
        over = [(d, p) for d, p in buckets if d < max_depth and total[(p + 1) << (max_depth - d)] - total[p << (max_depth - d)] > capacity]
        if not over:
            break
        split = set(over)
        buckets = [x for x in buckets if x not in split] + [(d + 1, 2 * p + bit) for d, p in over for bit in (0, 1)]
        depth = max(depth, max(d for d, _ in buckets))  # the directory doubles when a bucket is as deep as it is
    directory = np.zeros(1 << depth, np.int32)
    for number, (d, p) in enumerate(sorted(buckets, key=lambda x: x[1] << (max_depth - x[0]))):
        directory[p << (depth - d) : (p + 1) << (depth - d)] = number
    return directory


def _collapsed(batch: pa.RecordBatch):
    """Equal texts of a batch as one entry: (hash, normalised bytes, ids)."""
    data, offsets = X.column_bytes(batch.column(1))
    raw = data.tobytes().translate(X.TO_LOWER)
    entries: dict[bytes, list] = {}
    for doc, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        body = raw[a:b]
        entries.setdefault(body, []).append(doc)
    return entries


def _count_prefixes(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = X.column_bytes(batch.column(0))
    raw = data.tobytes().translate(X.TO_LOWER)
    seen = {xxhash.xxh64_intdigest(raw[a:b]): b - a for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())}
    prefix = np.array(list(seen), np.uint64) >> np.uint64(64 - MAX_DEPTH)
    at, back = np.unique(prefix, return_inverse=True)
    size = np.bincount(back, np.array(list(seen.values()), np.float64) + 64)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(size.astype(np.int64))], names=["prefix", "size"])


def _entries(held):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _collapsed(batch)
        directory = held.value
        shift = 64 - (len(directory).bit_length() - 1)
        h = np.array([xxhash.xxh64_intdigest(body) for body in found], np.uint64)
        slot = directory[h >> np.uint64(shift)] if shift < 64 else np.zeros(len(h), np.int32)
        keep = [max((i for i in ids if i is not None), default=None) for ids in found.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(slot), pa.array(list(found), pa.binary()),
             pa.array([hashlib.sha256(body).hexdigest() for body in found]), pa.array(keep, pa.int64()),
             pa.array([len(ids) for ids in found.values()], pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))],
            names=["h", "slot", "body", "sha", "keep", "n", "ids"])
    return run


def _chain(batches):
    """Owner task: entries arrive sorted by (slot, hash). Those of one hash form
    a chain; each entry takes the number of the first link with its bytes."""
    current, links = None, []
    for batch in batches:
        bodies, chain = batch.column(2), []
        for i, h in enumerate(batch.column(0).to_pylist()):
            if h != current:
                current, links = h, []
            body = bodies[i].as_py()
            for number, link in enumerate(links):
                if link == body:
                    break
            else:
                number = len(links)
                links.append(body)
            chain.append(number)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(chain, pa.int32()), *batch.columns[3:]],
            names=["h", "slot", "link", "sha", "keep", "n", "ids"])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The index, read back from the shared folder: (h, slot, link, sha, keep,
    n, ids), one row per entry."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = X.map_batches(rows.select("text"), _count_prefixes, "prefix int, size bigint").groupBy("prefix").agg(F.sum("size").alias("size"))
    directory = build_directory({r.prefix: r["size"] for r in counts.collect()}, bucket_bytes)
    held = spark.sparkContext.broadcast(directory)
    owners = max(int(directory.max()) + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    entries = X.map_batches(rows, _entries(held), ENTRY)
    owned = entries.repartition(owners, "slot").sortWithinPartitions("slot", "h")
    chained = owned.mapInArrow(_chain, "h bigint, slot int, link int, sha string, keep bigint, n bigint, ids array<bigint>")
    return stored(chained, "hash-index")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, **options)
    classes = index.groupBy("h", "link").agg(F.max("keep").alias("keep_id"), F.sum("n").alias("group_size"))
    return (index.select("h", "link", "sha", F.explode("ids").alias("doc_id")).join(classes, ["h", "link"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256")))
