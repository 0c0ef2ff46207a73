"""Monthly partial aggregates, merged instead of reading silver again.

One row per (month, page, user) holds additive sums. Totals, user and page
statistics and the dataset figures over any months follow from these rows, distinct
pages and users included. A new month adds its own folder (``tables.write_by_month``
with ``increment``); earlier months are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions.scalars import percent, safe_round
from editpulse.operators.aggregates import n_rows, total

_KEY = ("year", "month", "page_title", "user")


def monthly_partials(silver: DataFrame) -> DataFrame:
    change = F.col("size_change")
    return silver.groupBy(*_KEY).agg(
        n_rows().alias("edits"),
        total("size_bytes").alias("size_sum"), F.count("size_bytes").alias("size_n"),
        total("comment_length").alias("comment_sum"), F.count("comment_length").alias("comment_n"),
        total("size_change_abs").alias("change_sum"), F.count("size_change_abs").alias("change_n"),
        total("is_bot").alias("bot"), total("is_anon").alias("anon"), total("is_minor").alias("minor"),
        F.count_if(change > 0).alias("additions"), F.count_if(change < 0).alias("deletions"),
        F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))


def _mean(name: str):
    return F.try_divide(F.sum(f"{name}_sum").cast("double"), F.sum(f"{name}_n"))


def merged_summary(partials: DataFrame) -> DataFrame:
    """``silver_summary`` and the date range."""
    return partials.agg(
        total("edits").alias("total_edits"), F.count_distinct("page_title").alias("unique_pages"),
        F.count_distinct("user").alias("unique_users"), _mean("size").alias("avg_edit_size"), _mean("comment").alias("avg_comment_len"),
        total("bot").alias("bot_edits"), total("anon").alias("anon_edits"), total("minor").alias("minor_edits"),
        F.min("earliest").alias("earliest_edit"), F.max("latest").alias("latest_edit"))


def merged_dataset_kpis(partials: DataFrame) -> DataFrame:
    """``dataset_kpis``."""
    s = merged_summary(partials)
    return s.select(
        "total_edits", F.col("unique_pages").alias("total_pages"), F.col("unique_users").alias("total_users"),
        "bot_edits", "anon_edits", "minor_edits", safe_round("avg_edit_size", 1).alias("avg_edit_size"),
        *[percent(f"{c}_edits", "total_edits").alias(f"{c}_pct") for c in ("bot", "anon", "minor")])


def merged_user_stats(partials: DataFrame) -> DataFrame:
    """``user_stats``."""
    return partials.groupBy("user").agg(
        total("edits").alias("user_total_edits"), F.count_distinct("page_title").alias("user_pages_edited"),
        _mean("change").alias("user_avg_edit_size"), total("minor").alias("user_minor_edit_count"),
        (F.sum("minor") / F.sum("edits")).alias("user_minor_edit_ratio"))


def merged_page_stats(partials: DataFrame) -> DataFrame:
    """``page_stats``."""
    return partials.groupBy("page_title").agg(
        total("edits").alias("page_total_edits"), F.count_distinct("user").alias("page_unique_editors"),
        _mean("change").alias("page_avg_edit_size"), total("additions").alias("page_additions"), total("deletions").alias("page_deletions"),
    ).withColumn("page_controversy_score", F.col("page_total_edits").cast("double") * F.col("page_unique_editors") / F.lit(1000.0))
