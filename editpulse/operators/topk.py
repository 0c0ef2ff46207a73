"""Top-k tables and histograms. Every ranking has a total order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions.scalars import epoch_seconds
from editpulse.operators.aggregates import n_rows


def top_by_count(df: DataFrame, key: str, n: int = 10, count_col: str = "edits") -> DataFrame:
    """The ``n`` most frequent keys, name as tie-break. Planned as a per-task
    top-n followed by one small merge."""
    return (df.groupBy(key).agg(n_rows().alias(count_col))
            .orderBy(F.desc(count_col), key).limit(n))


def top_pages(df: DataFrame, n: int = 10) -> DataFrame:
    return top_by_count(df, "page_title", n)


def top_users(df: DataFrame, n: int = 10) -> DataFrame:
    return top_by_count(df, "user", n)


def top_editors_per_page(df: DataFrame, n: int = 5) -> DataFrame:
    """Pages with most edits and how many people made them."""
    return (df.groupBy("page_title")
            .agg(n_rows().alias("edit_count"), F.count_distinct("user").alias("unique_editors"))
            .orderBy(F.desc("edit_count"), "page_title").limit(n))


def edits_by_hour(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return (df.groupBy(F.hour(ts_col).alias("hour"))
            .agg(n_rows().alias("edits")).orderBy("hour"))


def top_revert_pages(features: DataFrame, n: int = 10) -> DataFrame:
    return top_by_count(features.filter("is_revert_candidate = 1"), "page_title", n, "reverts")


def page_velocity(df: DataFrame, *, key: str = "page_title", ts_col: str = "timestamp",
                  min_days: float = 1.0) -> DataFrame:
    """Edits per day between the first and last edit of each page."""
    span = epoch_seconds(F.max(ts_col)) - epoch_seconds(F.min(ts_col))
    return (df.groupBy(key)
            .agg(n_rows().alias("edits"), (span / F.lit(86400.0)).alias("days"))
            .filter(F.col("days") > min_days)
            .withColumn("edits_per_day", F.try_divide("edits", "days")))


def top_velocity_pages(df: DataFrame, n: int = 10, *, key: str = "page_title",
                       ts_col: str = "timestamp") -> DataFrame:
    return (page_velocity(df, key=key, ts_col=ts_col)
            .orderBy(F.desc("edits_per_day"), key).limit(n))
