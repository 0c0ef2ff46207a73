"""Runtime session settings and scratch space.

The caller owns the session. Only settings that can change at run time are
touched here; memory, off-heap and executor sizes belong to spark-submit.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Wall-clock columns must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_defaults(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Set the runtime defaults; ``shuffle_partitions`` only when asked for."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


_scratch: list[str] = []


def scratch_folders() -> list[str]:
    """Scratch folders made so far; the caller removes them when done."""
    return list(_scratch)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the checkpoint directory the cluster names, or else
    under the warehouse: both are shared by driver and executors."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to scratch space and read it back: the work is done once,
    later readers take only the columns they need, and a lost executor costs
    no recomputation. See ``scratch_folders`` for cleaning up."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    back._scratch = path
    return back


def remove_stored(*tables: DataFrame) -> None:
    """Remove the folders of tables from ``stored`` that no later step reads."""
    for table in tables:
        spark, path = table.sparkSession, table._scratch
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _scratch.remove(path)
