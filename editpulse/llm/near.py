"""Near copies by similarity of word shingles: min-hash bands, then true sets.

A shingle is SHINGLE = 5 words (runs of non-blank bytes after lower-casing A-Z)
joined by blanks; fewer words are one shingle, no word is the empty set. Two texts
are near copies when their sets of shingles have a Jaccard similarity of at least
SIMILARITY. Each text has BANDS hashes of ROWS min-hashes each; texts that share a
band are candidates, and every tie is verified on the sets. At similarity 0.8
exactly a pair shares no band with probability (1 - 0.8^6)^24 = 0.0007, at 0.9
below 1e-7. Texts with equal sets have equal bands and are tied by a hash of the set
of 128 bits and its size.

No bucket is paired out at once. In rounds, the least keys of each bucket (one in
the first round, HUBS in later ones) are compared with the greater keys in it; a
key that is tied to a lesser one leaves all buckets, a key that has been a hub
leaves that bucket, until no bucket has two keys. So a class of k copies costs k
comparisons a bucket at most in the first round. Keys that stay are never near each
other where they share a bucket. Then the keys that have left are compared with the
keys of other classes in their buckets, which closes chains of texts: a class is a
connected component of all pairs that share a bucket and are near, and only pairs
that are in one class by then are not compared. The sets of all keys in buckets are
written once; a round joins them, never the texts, and removes what the round before
has written.

A null or blank text has the empty set, and is a copy of any other such text. Rows
that repeat a key are one node, near to what any of their texts is near to; rows
with a null key are in no class. An empty table has no classes, a text of any length
is read whole, and further columns do not matter.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.llm.components import components
from editpulse.session import remove_stored, stored

SHINGLE, SIMILARITY = 5, 0.8
#: The table that says whose sets are wanted, sent to every executor, has 16 to 32
#: bits a key, and 16 MB at most; a fuller table lets more sets pass.
FILTER_BITS = (1 << 15, 1 << 27)
BANDS, ROWS, HUBS = 24, 6, 16
_NOT_BLANK = np.array([not bytes([i]).isspace() for i in range(256)])
_RNG = np.random.default_rng(5)
_XOR, _ODD = (_RNG.integers(0, 1 << 63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingles(column: pa.Array):
    """Arrays of distinct shingle hashes, one for each text."""
    data, offsets = X.column_bytes(column)
    for first, last in X.chunks(offsets):
        at = offsets[first : last + 1]
        part = X.lowered(data[at[0] : at[-1]])
        starts, ends, before = X.words(part, at - at[0], _NOT_BLANK)
        h = X.word_hashes(part, starts, ends)
        runs = dict(X.window_hashes(h, SHINGLE))
        for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
            k = min(SHINGLE, b - a)
            yield np.unique(_mixed(runs[k][a : b - k + 1] + np.uint64(k))) if k else np.zeros(0, np.uint64)


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, BANDS) hashes; the sets must not be empty."""
    out = np.zeros((len(sets), BANDS), np.uint64)
    if not sets:
        return out
    flat, begin = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    for i in range(BANDS * ROWS):
        least = np.minimum.reduceat((flat ^ _XOR[i]) * _ODD[i], begin)
        out[:, i // ROWS] = _mixed((out[:, i // ROWS] + np.uint64(i + 1)) * _STEP + least)
    return out


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Set hash (two words), size and bands of each text; the empty set has no bands."""
    whole, other, size, rows, group, held = [], [], [], [], [], 0

    def flush():
        found = iter(bands([s for s in group if len(s)]))
        for s in group:
            whole.append(int(np.bitwise_xor.reduce(_mixed(s * _ODD[0]))) if len(s) else 0)
            other.append(int(np.add.reduce(_mixed((s ^ _XOR[0]) * _ODD[1]))) if len(s) else 0)
            size.append(len(s))
            rows.append(next(found).view(np.int64).tolist() if len(s) else [])
        group.clear()
    for s in shingles(batch.column(1)):
        group.append(s)
        held += len(s)
        if held > 1 << 17:
            flush()
            held = 0
    flush()
    words = [pa.array(np.array(h, np.uint64).view(np.int64)) for h in (whole, other)]
    return pa.RecordBatch.from_arrays([batch.column(0), *words, pa.array(size, pa.int32()), pa.array(rows, pa.list_(pa.int64()))],
                                      names=["key", "whole", "other", "size", "bands"])


def _key_bits(keys: DataFrame) -> np.ndarray:
    """Bits with those of the keys' hashes set: bounded, however many keys there are."""
    least, most = FILTER_BITS
    n_bits = min(max(least, 1 << (16 * keys.count()).bit_length()), most)
    place = F.pmod(F.xxhash64("key"), F.lit(n_bits)) + 1
    rows = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).toArrow()
    bits = np.zeros(n_bits // 8, np.uint8)
    for bucket, part in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        bits[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(part, np.uint8)
    return bits


def _candidate_sets(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, shingles) of the texts of ``keys``, stored once. Texts stay in the task
    that reads them: a broadcast table of bits says which keys may be wanted, and
    sets of further keys, which it lets pass, join nothing later."""
    bits = _key_bits(keys)
    held = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        place = batch.column(2).to_numpy()
        wanted = batch.filter(pa.array((held.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))
        if wanted.num_rows:
            return pa.RecordBatch.from_arrays([wanted.column(0), pa.array([s.tobytes() for s in shingles(wanted.column(1))], pa.binary())], names=["key", "shingles"])
    rows = texts.select("key", "text", F.pmod(F.xxhash64("key"), F.lit(8 * len(bits))).alias("place"))
    return stored(X.map_batches(rows, run, "key bigint, shingles binary"), "near-sets")


def _similar(batch: pa.RecordBatch) -> pa.RecordBatch:
    keep = []
    for x, y in zip(batch.column(2), batch.column(3)):
        x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
        common = len(np.intersect1d(x, y, assume_unique=True))
        keep.append(common >= SIMILARITY * (len(x) + len(y) - common) - 1e-9)
    return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    of = lambda c: sets.select(F.col("key").alias(c), F.col("shingles").alias(f"{c}_set"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "a_set", "b_set")
    return X.map_batches(joined, _similar, "a bigint, b bigint").distinct()


def classes(texts: DataFrame) -> DataFrame:
    """(key, root) of every key of ``texts`` (key: bigint, text) that is not the
    least of its class; root is the least key."""
    texts = texts.filter("key IS NOT NULL")
    sketches = stored(X.map_batches(texts.select("key", "text"), _sketch, "key bigint, whole bigint, other bigint, size int, bands array<bigint>"), "near-sketch")
    same = ["whole", "other", "size"]
    heads = sketches.groupBy(*same).agg(F.min("key").alias("head"))
    copies = stored(sketches.select("key", *same).join(heads, same).filter("key <> head"), "near-copies")
    # By text, not by key: the other texts of a repeated key stay.
    buckets = sketches.join(copies, ["key", *same], "left_anti").select("key", "size", F.explode("bands").alias("band")).distinct()
    many = buckets.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    every, hubs_wanted = stored(buckets.join(many.hint("merge"), "band"), "near-buckets"), 1
    ties = [stored(copies.select(F.col("key").alias("a"), F.col("head").alias("b")).distinct(), "near-ties")]
    remove_stored(sketches, copies)
    members = stored(every.select("key").distinct(), "near-members")
    sets = _candidate_sets(texts, members)
    remove_stored(members)
    left = every
    while True:
        order = Window.partitionBy("band").orderBy("key", "size")
        hubs = stored(left.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= hubs_wanted), "near-hubs")
        met = left.select("band", F.col("key").alias("a"), "size").join(hubs.select("band", F.col("key").alias("b"), F.col("size").alias("other")).hint("merge"), "band").filter("a > b")
        pairs = stored(met.filter(_fits()).select("a", "b").distinct(), "near-pairs")
        ties.append(stored(_verified(pairs, sets), "near-ties"))
        gone = ties[-1].select(F.col("a").alias("key")).distinct()
        rest = left.join(hubs.select("band", "key", "size"), ["band", "key", "size"], "left_anti").join(gone, "key", "left_anti")
        last, rest = left, stored(rest, "near-buckets")
        many = rest.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
        left = stored(rest.join(many.hint("merge"), "band"), "near-buckets")
        remove_stored(rest, hubs, pairs)
        if last is not every:
            remove_stored(last)
        hubs_wanted = HUBS
        if not left.head(1):
            break
    found = components(reduce(DataFrame.unionByName, ties), "near")
    mixed = stored(_mixed_buckets(every, found), "near-mixed")
    remove_stored(left, every)
    pairs = stored(_apart(mixed), "near-pairs")
    ties.append(stored(_verified(pairs, sets), "near-ties"))
    remove_stored(mixed, pairs, sets)
    if ties[-1].head(1):
        found = components(reduce(DataFrame.unionByName, ties), "near")
    remove_stored(*ties)
    return found.select(F.col("node").alias("key"), "root")


def _fits() -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least("size", "other") >= SIMILARITY * F.greatest("size", "other") - 1e-9


def _mixed_buckets(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """(key, band, size, root) of the buckets that hold keys of several classes."""
    rooted = buckets.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("band")
    return rooted.join(mixed.hint("merge"), "band")


def _apart(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) that share a bucket, a with a lesser key in its class, b in another
    class. Two keys that are the least of their classes have been compared before."""
    gone = rows.filter("key <> root").select("band", F.col("key").alias("a"), "size", F.col("root").alias("root_a"))
    others = rows.select("band", F.col("key").alias("b"), F.col("size").alias("other"), F.col("root").alias("root_b"))
    once = (F.col("root_a") != F.col("root_b")) & ((F.col("b") == F.col("root_b")) | (F.col("a") > F.col("b")))
    return gone.join(others.hint("merge"), "band").filter(once & _fits()).select("a", "b").distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class of near copies stays: the one with the least id. Of
    rows that repeat its id, one of each different text stays; rows without an id
    stay, as none can be named."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    copies = classes(rows).select("key", F.lit(False).alias("once"))
    repeated = rows.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.lit(True).alias("once"))
    mark = X.fresh(docs, "decided_id")
    decided = stored(copies.unionByName(repeated).groupBy(F.col("key").alias(mark)).agg(F.min("once").alias("once")), "near-decided")
    same = F.col(f"`{id_col}`") == F.col(mark)
    plain = docs.join(decided.select(mark), same, "left_anti")
    if not decided.filter("once").head(1):
        return plain
    folded = docs.join(decided.filter("once").select(mark), same, "left_semi")
    place = X.fresh(docs, "place")
    rest = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith("map") and c not in (id_col, text_col)]
    one = Window.partitionBy(f"`{id_col}`", f"`{text_col}`").orderBy(*(rest or [F.lit(0)]))
    return plain.unionByName(folded.withColumn(place, F.row_number().over(one)).filter(F.col(f"`{place}`") == 1).drop(place))
