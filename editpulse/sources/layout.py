"""Stored layouts: files by page and time together, and buckets by a key.

*Clustered.* A row's page has a slot by its hash, its time a slot between quantiles
of all times. The bits of both slots, interleaved, are its zone, and a zone is a
folder: rows of a page lie in one zone of every time slot, rows of a period in one
zone of every page slot, so both kinds of read open about the square root of the
folders. Inside a file rows are sorted by page and time, which the row groups'
bounds use. A page that holds a third of all rows still becomes several files.

*Bucketed.* Rows are stored by the hash of a key, so windows, joins and sums over the
key need no shuffle. One bucket is one task, so a table with hot keys is read as
plain files, which any number of tasks share.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.functions.scalars import epoch_seconds
from editpulse.operators.keysplit import MAX_ROWS, has_hot_keys

ZONE = "zone"


def interleaved(page: int, time: int, bits: int) -> int:
    return sum((page >> i & 1) << 2 * i + 1 | (time >> i & 1) << 2 * i for i in range(bits))


def _zone(page: Column, time: Column, bits: int) -> Column:
    bit = lambda slot, i: F.shiftright(slot, i).bitwiseAND(1)
    zone = F.lit(0)
    for i in range(bits):
        zone = zone.bitwiseOR(F.shiftleft(bit(page, i), 2 * i + 1)).bitwiseOR(F.shiftleft(bit(time, i), 2 * i))
    return zone


def _page_slot(page: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(page.cast("string")), F.lit(1 << bits)).cast("int")


def write_clustered(df: DataFrame, path: str, *, page_col: str = "page_title", ts_col: str = "timestamp",
                    bits: int = 4) -> None:
    """Store ``df`` by zone: 4 ^ ``bits`` folders. Rows without a time are in the
    first time slot. The quantiles, at most 2 ^ ``bits`` numbers, are stored with it."""
    seconds = epoch_seconds(ts_col)
    parts = [i / (1 << bits) for i in range(1, 1 << bits)]
    edges = df.agg(F.percentile_approx(seconds, parts, 10_000).alias("edges"))
    edges.select(F.coalesce("edges", F.array().cast("array<bigint>")).alias("edges"), F.lit(bits).alias("bits"), F.lit(df.schema.json()).alias("schema"),
                 F.lit(page_col).alias("page_col"), F.lit(ts_col).alias("ts_col")).write.mode("overwrite").parquet(f"{path}/layout")
    found = df.sparkSession.read.parquet(f"{path}/layout").first().edges
    time_slot = F.lit(0)
    for edge in found:
        time_slot = time_slot + F.coalesce((seconds >= edge).cast("int"), F.lit(0))
    zoned = df.withColumn(ZONE, _zone(_page_slot(F.col(page_col), bits), time_slot, bits))
    (zoned.hint("rebalance", ZONE).sortWithinPartitions(ZONE, page_col, ts_col)
     .write.mode("overwrite").partitionBy(ZONE).parquet(f"{path}/rows"))


def read_clustered(spark: SparkSession, path: str, *, pages: list[str] | None = None,
                   since: str | None = None, until: str | None = None) -> DataFrame:
    """Rows of the given pages with ``since`` <= time < ``until`` (texts of times; each
    may be left out). Only the zones that can hold such rows are opened."""
    layout = spark.read.parquet(f"{path}/layout").first()
    bits, n = layout.bits, 1 << layout.bits
    schema = T.StructType.fromJson(json.loads(layout.schema)).add(ZONE, T.IntegerType())
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    page_slots, first, last = set(range(n)), 0, n - 1
    if pages is not None:
        rows = rows.filter(F.col(layout.page_col).isin(pages))
        wanted = spark.createDataFrame([(p,) for p in pages], "page string")
        page_slots = {r[0] for r in wanted.select(_page_slot(F.col("page"), bits)).collect()}
    limits = spark.range(1).select(*[epoch_seconds(F.to_timestamp(F.lit(t))) for t in (since, until)]).first()
    time = F.col(layout.ts_col)
    if since is not None:
        rows, first = rows.filter(time >= F.to_timestamp(F.lit(since))), bisect_right(layout.edges, limits[0])
    if until is not None:
        rows, last = rows.filter(time < F.to_timestamp(F.lit(until))), bisect_right(layout.edges, limits[1])
    zones = sorted(interleaved(p, t, bits) for p in page_slots for t in range(first, last + 1))
    return (rows if len(zones) == n * n else rows.filter(F.col(ZONE).isin(zones))).drop(ZONE)


#: Rows that one bucket, which is one task, holds on average.
ROWS_PER_BUCKET = 500_000


def buckets_for(df: DataFrame, least: int = 8) -> int:
    """Buckets that keep a task's rows the same however large the table is."""
    return max(least, ceil(df.count() / ROWS_PER_BUCKET))


def write_bucketed(df: DataFrame, name: str, path: str, *, key: str = "user", buckets: int = 64) -> None:
    """Store ``df`` at ``path`` as the table ``name``, bucketed by ``key``. Rows meet by
    bucket before they are written, so a bucket is few files; large ones are split."""
    # The hash that buckets use.
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    (df.withColumn("_bucket", bucket).hint("rebalance", "_bucket").drop("_bucket")
     .write.mode("overwrite").bucketBy(buckets, key).option("path", path).saveAsTable(name))


def register_bucketed(spark: SparkSession, name: str, path: str, *, key: str = "user", buckets: int = 64) -> None:
    """Make a stored table known to a session whose catalogue does not have it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {int(buckets)} BUCKETS LOCATION '{place}'")


def read_bucketed(spark: SparkSession, name: str, path: str, *, key: str = "user",
                  max_rows: int | None = MAX_ROWS) -> DataFrame:
    """The table by its buckets, or its plain files where a key has over ``max_rows`` rows."""
    table = spark.table(name)
    return spark.read.parquet(path) if has_hot_keys(table, key, max_rows) else table
