"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within RADIUS = 3 bits are linked. Of two such fingerprints one can
walk to a point that is at most one bit from itself and at most two from the
other. So every fingerprint emits the variants within half the radius: itself,
all one-bit variants and, on one side only, two-bit variants. Rows are shuffled on
the variant; at each point all fingerprints are tied to one that is at most one bit
away, each tie is verified, and components of the ties are the classes. A point
with k fingerprints gives k - 1 ties, never pairs.

No link is lost, with three savings. Copies share a fingerprint and emit once.
Linked fingerprints at distance 3 differ in parity, and two of the three bits are
in one half of the word, so only even fingerprints emit two-bit variants and only
inside a half: 1,057 or 65 variants instead of 2,081. And by the same argument on
halves, linked fingerprints have a half within one bit; fingerprints without any
such neighbour (found by 66 half-word variants, counted, not paired) emit nothing.

Words are runs of non-blank bytes after lower-casing A-Z; a shingle is three
words joined by blanks; fewer words are one shingle; null, empty and blank texts
have fingerprint zero, and are linked like any other. Repeated rows are copies;
documents without an id are rows with a null id and never name a class unless it
has no other. Further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.llm import text as X
from editpulse.llm.components import components
from editpulse.session import stored

RADIUS, SHINGLE, SEED = 3, 3, 42
HALF_MASK = (1 << 32) - 1


def fingerprint(norm: bytes, n: int = SHINGLE) -> int:
    """Fingerprint of lower-cased bytes: majority of each bit of the shingles' hashes."""
    words = norm.split()
    if not words:
        return 0
    joined, size = b" ".join(words), [len(w) for w in words]
    ends = np.cumsum(size) + np.arange(len(words))
    starts = ends - size
    h = xxhash.xxh64_intdigest
    if len(words) < n:
        return h(joined, SEED)
    votes, total = np.zeros(64, np.int64), len(words) - n + 1
    first, last = starts[:total].tolist(), ends[n - 1 :].tolist()
    for at in range(0, total, 8192):
        values = np.array([h(joined[a:b], SEED) for a, b in zip(first[at : at + 8192], last[at : at + 8192])], np.uint64)
        bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int32)
    return int(sum(1 << i for i in np.flatnonzero(2 * votes > total).tolist()))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp as a signed 64-bit integer."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = X.column_bytes(batch.column(1))
        raw = data.tobytes().translate(X.TO_LOWER)
        fp = np.array([fingerprint(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return X.map_batches(rows, run, "doc_id bigint, fp bigint")


def _dealt(prints: DataFrame) -> DataFrame:
    """Spread over all tasks, as every row becomes dozens or hundreds. Spark's
    size estimates do not see that, hence also the merge hints below."""
    return prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def _with_neighbours(distinct: DataFrame) -> DataFrame:
    """Fingerprints that share a half with another up to one bit."""
    halves = _dealt(distinct).select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("fp").bitwiseAND(F.lit(HALF_MASK)).alias("half")),
        F.struct(F.lit(1).alias("side"), F.shiftrightunsigned("fp", 32).alias("half")))).alias("x")).select("fp", "x.side", "x.half")
    homes = halves.groupBy("side", "half").agg(F.count("*").alias("n"))
    flips = F.array(*[F.lit(v) for v in (0, *(1 << i for i in range(32)))])
    probes = halves.select("fp", "side", F.explode(flips).alias("flip"), "half").select("fp", "side", "flip", F.col("half").bitwiseXOR(F.col("flip")).alias("half"))
    return probes.join(homes.hint("merge"), ["side", "half"]).filter("flip <> 0 OR n > 1").select("fp").distinct()


def _ball(fp: Column) -> Column:
    """Variants of a fingerprint with their distance."""
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    near = F.array(*[F.lit(signed(v)) for v in (0, *(1 << i for i in range(64)))])
    two = F.array(*[F.lit(signed((1 << i) | (1 << j))) for base in (0, 32) for i in range(base, base + 32) for j in range(i + 1, base + 32)])
    row = lambda masks, far: F.transform(masks, lambda m: F.struct(fp.bitwiseXOR(m).alias("v"), F.lit(far).alias("far")))
    return F.when(F.bit_count(fp) % 2 == 0, F.concat(row(near, False), row(two, True))).otherwise(row(near, False))


def links(distinct: DataFrame) -> DataFrame:
    """Verified ties (a, b) whose components are those of all links."""
    near = stored(_with_neighbours(distinct), "simhash-near")
    points = _dealt(near).select("fp", F.explode(_ball(F.col("fp"))).alias("p")).select("fp", "p.v", "p.far")
    hubs = points.filter("NOT far").groupBy("v").agg(F.min("fp").alias("hub"), F.count("*").alias("n"))
    ties = points.join(hubs.hint("merge"), "v").filter("fp <> hub").select(F.greatest("fp", "hub").alias("a"), F.least("fp", "hub").alias("b")).distinct()
    return ties.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def classes(docs: DataFrame, **columns) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    prints = stored(fingerprints(docs, **columns), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp")), "simhash").withColumnRenamed("node", "fp")
    member = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = member.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = member.join(names, "root").select("fp", "component_id")
    return prints.join(labelled, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class stays: the one with the least id; of rows
    that repeat its id, one. Rows without an id stay, as none can be named."""
    found = classes(docs, id_col=id_col, text_col=text_col).filter("doc_id IS NOT NULL")
    ids = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    mark = X.fresh(docs, "decided_id")
    decided = stored(ids.filter("doc_id <> component_id OR n > 1").select(
        F.col("doc_id").alias(mark), (F.col("doc_id") == F.col("component_id")).alias("once")), "simhash-decided")
    same = F.col(f"`{id_col}`") == F.col(mark)
    plain = docs.join(decided.select(mark), same, "left_anti")
    if not decided.filter("once").head(1):
        return plain
    return plain.unionByName(docs.join(decided.filter("once").select(mark), same, "left_semi").dropDuplicates([id_col]))
