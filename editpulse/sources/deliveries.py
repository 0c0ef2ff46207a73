"""Tables that grow by deliveries, each visible as a whole or not at all.

A delivery writes its part of every table into folders of its own and is committed by
a marker last. Readers see committed deliveries only; a delivery that broke off is
written again under the same number.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def committed(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed deliveries, ascending."""
    try:
        marks = spark.read.schema("done boolean, delivery int").parquet(f"{path}/commits")
        return sorted(r.delivery for r in marks.select("delivery").distinct().collect())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def commit(spark: SparkSession, path: str, number: int) -> None:
    spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/delivery={number}")


def write_part(df: DataFrame, path: str, table: str, number: int, by: str | None = None) -> None:
    """One delivery's rows of one table, in folders by ``by`` if given."""
    writer = (df if by is None else df.hint("rebalance", by)).write.mode("overwrite")
    (writer if by is None else writer.partitionBy(by)).parquet(f"{path}/{table}/delivery={number}")


def read_parts(spark: SparkSession, path: str, table: str, schema: T.StructType | str, numbers: list[int]) -> DataFrame:
    """Rows of one table from the given deliveries, with the column ``delivery``."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*kind.fields, T.StructField("delivery", T.IntegerType())])
    if not numbers:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", f"{path}/{table}").parquet(*[f"{path}/{table}/delivery={n}" for n in numbers])
