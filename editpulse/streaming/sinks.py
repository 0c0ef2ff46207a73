"""Stream sinks and bounded runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from editpulse.streaming.events import roll_up


def update_writer(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Update mode into Parquet, one folder per micro-batch.

    A repeated batch overwrites its own folder, so a retry after a failure
    leaves every update exactly once.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint).foreachBatch(save))


def append_writer(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append mode into Parquet: closed windows only."""
    return (stream.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint))


def console_writer(stream: DataFrame, checkpoint: str) -> DataStreamWriter:
    return (stream.writeStream.outputMode("update").format("console")
            .option("truncate", False).option("checkpointLocation", checkpoint))


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of each key written by ``update_writer``."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in keys and c != "batch_id"]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in values])


def current_page_counts(spark: SparkSession, path: str) -> DataFrame:
    """Exact per-page windows from stored ``editor_counts`` updates."""
    return roll_up(latest_updates(spark, path, ["window", "page_title", "user"]))


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_bounded(writer: DataStreamWriter, seconds: int = 300) -> StreamingQuery:
    """Run for a limited time, then stop."""
    query = writer.start()
    query.awaitTermination(seconds)
    query.stop()
    return query
