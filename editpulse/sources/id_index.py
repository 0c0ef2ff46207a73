"""An exact index of stored revision ids: bitmaps of 32,768 ids each.

A delivery adds a bitmap for every bucket its ids fall in, in folders of FOLDER
buckets. Whether ids are stored is then answered from the folders a delivery hits,
a bit an id, and never from the stored revisions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.operators.clean import dedup_revisions
from editpulse.sources import deliveries as D

FOLDER = 1024
_SCHEMA = "bucket bigint, bits binary, folder bigint"


def _placed(ids: DataFrame, id_col: str) -> DataFrame:
    bucket = F.bitmap_bucket_number(id_col)
    return ids.withColumns({"bucket": bucket, "folder": F.floor(bucket / FOLDER).cast("bigint")})


def add_ids(ids: DataFrame, path: str, number: int, *, id_col: str = "revid") -> None:
    """The bitmaps of one delivery's ids, under the number of that delivery."""
    rows = _placed(ids.filter(F.col(id_col).isNotNull()).select(id_col), id_col)
    bits = rows.groupBy("folder", "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits"))
    D.write_part(bits.select("bucket", "bits", "folder"), path, "ids", number, by="folder")


def _bit(bits, position):
    """The bit of a bitmap at a place, as 0 or 1."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1))


def stored_bits(spark: SparkSession, path: str, folders: list[int]) -> DataFrame:
    """(bucket, bits) of the named folders over all committed deliveries."""
    found = D.read_parts(spark, path, "ids", _SCHEMA, D.committed(spark, path)).filter(F.col("folder").isin(folders) if folders else F.lit(False))
    return found.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def not_indexed(incoming: DataFrame, path: str, *, id_col: str = "revid") -> DataFrame:
    """Incoming revisions whose id is not in the index, each id once. Only the
    index folders that the incoming ids fall in are read."""
    rows = _placed(dedup_revisions(incoming, id_col=id_col), id_col)
    folders = [r.folder for r in _placed(incoming.select(id_col), id_col).select("folder").filter("folder IS NOT NULL").distinct().collect()]
    bits = stored_bits(incoming.sparkSession, path, folders)
    known = _bit(F.col("bits"), F.bitmap_bit_position(id_col))
    return rows.join(bits, "bucket", "left").filter(F.coalesce(known, F.lit(0)) == 0).select(*incoming.columns)
