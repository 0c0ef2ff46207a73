"""The update store, folded as its windows close.

``sinks.update_writer`` adds a folder of changed rows with every micro-batch. Compaction
moves the newest version of all rows of windows behind the watermark, which no batch
can change any more, to a final table, and those of open windows to a tail, and notes
the last batch it has folded. Readers take the final table, the newest tail and
the batches after it: what they read besides finished rows is bounded by the open
windows. The three parts become visible together; a run that breaks off changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from editpulse.session import stored
from editpulse.sources import deliveries as D


def watermark_of(query: StreamingQuery) -> datetime | None:
    """Watermark of a query's last micro-batch; None before the first rows."""
    text = ((query.lastProgress or {}).get("eventTime") or {}).get("watermark")
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


def _folded(spark: SparkSession, store: str) -> tuple[list[int], int]:
    """Committed compactions, and the last batch they have folded (-1: none)."""
    numbers = D.committed(spark, store)
    last = D.read_parts(spark, store, "folded", "batch bigint", numbers[-1:]).first()
    return numbers, -1 if last is None else last.batch


def _open(spark: SparkSession, rows_path: str, store: str, schema: T.StructType, keys: list[str], numbers: list[int], batch: int) -> DataFrame:
    """Newest version of each key in the newest tail and the batches after it."""
    tail = D.read_parts(spark, store, "tail", schema, numbers[-1:]).drop("delivery").withColumn("batch_id", F.lit(-1).cast("bigint"))
    # With the schema given, listing the folders is all a skipped batch costs.
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(whole).parquet(rows_path).filter(F.col("batch_id") > batch)
    values = [c for c in schema.fieldNames() if c not in keys]
    return tail.unionByName(rows).groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values])


def compact_updates(spark: SparkSession, rows_path: str, store: str, schema: T.StructType, closed_before: datetime | None, *,
                    keys: list[str], window: str = "window") -> int:
    """Fold all batches there are; windows that end at or before ``closed_before``
    are final. Returns the number of final rows added."""
    numbers, batch = _folded(spark, store)
    number = max(numbers, default=-1) + 1
    last = spark.read.schema("batch_id bigint").parquet(rows_path).agg(F.max("batch_id")).first()[0]
    if last is None or (last <= batch and closed_before is None):
        return 0
    rows = stored(_open(spark, rows_path, store, schema, keys, numbers, batch), "open-windows")
    closed = F.lit(False) if closed_before is None else F.coalesce(F.col(f"{window}.end") <= F.lit(closed_before), F.lit(False))
    final = rows.filter(closed)
    D.write_part(final, store, "final", number)
    D.write_part(rows.filter(~closed), store, "tail", number)
    D.write_part(spark.range(1).select(F.lit(max(last, batch)).cast("bigint").alias("batch")), store, "folded", number)
    D.commit(spark, store, number)
    return final.count()


def compacted_updates(spark: SparkSession, rows_path: str, store: str, schema: T.StructType, *, keys: list[str]) -> DataFrame:
    """Newest version of each key, from final rows and the open rest."""
    numbers, batch = _folded(spark, store)
    final = D.read_parts(spark, store, "final", schema, numbers).drop("delivery")
    return final.unionByName(_open(spark, rows_path, store, schema, keys, numbers, batch).select(*final.columns))
