"""Silver, feature and gold tables in Parquet, SQL views and KPI files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EDITS_VIEW = "edits"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; column and partition pruning is left to Catalyst."""
    return spark.read.parquet(path)


def write_by_month(df: DataFrame, path: str, *, increment: bool = False,
                   max_records_per_file: int = 5_000_000) -> None:
    """Parquet folders by year and month.

    ``rebalance`` gathers a month into few files and lets AQE split a month
    that is much larger than the others. ``increment`` replaces only the
    months present in ``df``.
    """
    writer = (
        df.hint("rebalance", "year", "month").write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("partitionOverwriteMode", "dynamic" if increment else "static")
    )
    writer.partitionBy("year", "month").parquet(path)


write_silver = write_by_month
write_features = write_by_month


def write_gold(df: DataFrame, path: str, cluster: str = "prediction") -> None:
    df.hint("rebalance", cluster).write.mode("overwrite").partitionBy(cluster).parquet(path)


def register_edits(df: DataFrame, name: str = EDITS_VIEW) -> str:
    df.createOrReplaceTempView(name)
    return name


def top_editors_sql(spark: SparkSession, view: str = EDITS_VIEW, n: int = 5) -> DataFrame:
    return spark.sql(
        """SELECT page_title, count(*) AS edit_count, count(DISTINCT user) AS unique_editors
           FROM identifier(:view) GROUP BY page_title
           ORDER BY edit_count DESC, page_title LIMIT :n""",
        args={"view": view, "n": n})


def write_kpis(tables: dict[str, DataFrame], path: str) -> None:
    """Each KPI table as JSON under its own folder."""
    for name, table in tables.items():
        table.write.mode("overwrite").json(f"{path}/{name}")


def nested_document(sections: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """One JSON text: section, then table, then its rows. Only for report tables,
    which are a few rows each however large the data is."""
    parts = [
        table.agg(F.to_json(F.collect_list(F.struct(*table.columns)), {"ignoreNullFields": "false"}).alias("json"))
        .select(F.lit(section).alias("section"), F.lit(name).alias("name"), "json")
        for section, tables in sections.items() for name, table in tables.items()]

    def joined(name: str, json: str):
        fields = F.sort_array(F.collect_list(F.concat(F.lit('"'), F.col(name), F.lit('":'), F.col(json))))
        return F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}"))

    per_section = reduce(DataFrame.union, parts).groupBy("section").agg(joined("name", "json").alias("json"))
    return per_section.agg(joined("section", "json").alias("value"))


def kpi_document(table: DataFrame, name: str) -> DataFrame:
    """A one-row KPI table as a JSON text."""
    return table.select(F.lit(name).alias("kpi"), F.to_json(F.struct("*")).alias("document"))
