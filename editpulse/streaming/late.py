"""Late rows kept and counted, where a windowed stream drops them silently.

A row is late if its window ended at or before the watermark of the batches before,
the rule by which the aggregation drops it (within one run Spark's aggregation may take
it a batch later, as its watermark lags behind by a batch). The writer deals the raw rows of each
micro-batch to two tables and notes, with the counts observed while writing, the latest
event time so far; a repeated batch overwrites its own folders.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from editpulse.streaming.events import WATERMARK, WINDOW

_SEEN = "latest timestamp, n_rows bigint, n_late bigint, batch_id bigint"


def seen_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch: latest event time, rows and late rows."""
    try:
        return spark.read.schema(_SEEN).parquet(f"{path}/seen")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SEEN)


def _window_end(ts_col: str, window: str):
    """End of a row's window; the window function itself would drop rows without a time."""
    length = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {window}"))
    return F.timestamp_micros((F.floor(F.unix_micros(ts_col) / length) + 1) * length)


def late_writer(events: DataFrame, path: str, checkpoint: str, *, ts_col: str = "timestamp", window: str = WINDOW,
                watermark: str = WATERMARK) -> DataStreamWriter:
    """Rows to ``path/on_time`` or ``path/late``, one folder per micro-batch, and
    the batch's counts to ``path/seen``. Rows without a time are late."""
    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = seen_batches(spark, path).filter(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]
        line = F.lit(latest).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
        late = F.coalesce(_window_end(ts_col, window) <= line, F.col(ts_col).isNull())
        marked = batch.withColumn("_late", late)
        counted = Observation()
        rows = marked.observe(counted, F.count(F.lit(1)).alias("n"), F.count_if("_late").alias("late"), F.max(ts_col).alias("latest"))
        rows.write.mode("overwrite").partitionBy("_late").parquet(f"{path}/rows/batch_id={batch_id}")
        got = counted.get
        spark.createDataFrame([(got["latest"], got["n"], got["late"])], "latest timestamp, n_rows bigint, n_late bigint").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/seen/batch_id={batch_id}")
    return events.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)


def late_rows(spark: SparkSession, path: str, *, late: bool = True) -> DataFrame:
    """The rows that came late, or those that did not; only their folders are read."""
    return spark.read.parquet(f"{path}/rows").filter(F.col("_late") == F.lit(late)).drop("_late")
