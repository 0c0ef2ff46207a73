"""The 28 features over silver rows, plus trailing edit counts.

``features`` makes exactly two shuffles of the full rows, one by user and one
by page: in each, the join with the per-key statistics and the ordered windows
use the same partitioning. The statistics themselves read only a few columns
and combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.functions.scalars import epoch_seconds, flag
from editpulse.operators.aggregates import page_stats, user_stats
from editpulse.operators.keysplit import (
    MAX_ROWS, drop_carry, previous, row_sequence, split_hot_keys, trailing_counts,
    with_sequence,
)
from editpulse.schemas import DERIVED_FEATURES, PAGE_FEATURES, USER_FEATURES

HOUR = 3600
WEEK = 604_800
TRAILING = {"edits_last_hour": HOUR, "edits_last_7_days": WEEK}


def join_user_stats(df: DataFrame, stats: DataFrame | None = None, *,
                    user_col: str = "user", page_col: str = "page_title") -> DataFrame:
    """Attach the per-user statistics (left join, gaps become 0)."""
    stats = user_stats(df, user_col=user_col, page_col=page_col) if stats is None else stats
    return df.join(stats, user_col, "left").fillna(0, subset=USER_FEATURES)


def join_page_stats(df: DataFrame, stats: DataFrame | None = None, *,
                    user_col: str = "user", page_col: str = "page_title") -> DataFrame:
    """Attach the per-page statistics (left join, gaps become 0)."""
    stats = page_stats(df, user_col=user_col, page_col=page_col) if stats is None else stats
    return df.join(stats, page_col, "left").fillna(0, subset=PAGE_FEATURES)


def temporal_features(df: DataFrame) -> DataFrame:
    hour = F.col("hour")
    return df.withColumns({
        "is_weekend": flag(F.col("day_of_week").isin(1, 7)),
        "is_business_hours": flag(hour.between(9, 17)),
        "is_late_night": flag((hour >= 22) | (hour <= 5)),
        "hour_category": F.when((hour >= 6) & (hour < 12), "morning")
        .when((hour >= 12) & (hour < 18), "afternoon")
        .when((hour >= 18) & (hour < 22), "evening")
        .otherwise("night"),
    })


def edit_features(df: DataFrame) -> DataFrame:
    """Size classes of the edit; an unknown change counts as large."""
    change, magnitude = F.col("size_change"), F.col("size_change_abs")
    return df.withColumns({
        "is_major_edit": flag(magnitude > 1000),
        "is_deletion": flag(change < -100),
        "is_addition": flag(change > 100),
        "edit_magnitude": F.when(magnitude < 100, "small")
        .when(magnitude < 1000, "medium").otherwise("large"),
        "has_long_comment": flag(F.col("comment_length") > 50),
    })


def user_sequence(df: DataFrame, *, user_col: str = "user", ts_col: str = "timestamp",
                  id_col: str = "revid", stats: DataFrame | None = None,
                  source: DataFrame | None = None, horizons: dict[str, int] | None = None,
                  max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Position in the user's history, gap to the edit before, rapid flag, and
    with ``horizons`` (column: seconds) the trailing counts, on the same shuffle.

    ``source`` may name a cheaper table with the same rows for the hot-user
    check.
    """
    seconds = epoch_seconds(ts_col)
    split = split_hot_keys(df if source is None else source, user_col, max_rows)
    order = [ts_col, id_col]
    rows = with_sequence(df, split, order, stats=stats, source=source).withColumns({
        "user_edit_sequence": row_sequence(split, order),
        "_before": previous(seconds, split, order),
    })
    gap = F.coalesce(seconds - F.col("_before"), F.lit(0)).cast("bigint")
    out = (
        drop_carry(rows, split)
        .withColumn("time_since_last_edit_sec", gap)
        .withColumn("user_is_rapid_editor",
                    flag(F.col("time_since_last_edit_sec").between(1, 60)))
        .drop("_before")
    )
    if horizons:
        out = trailing_counts(out, user_col, seconds, horizons, max_rows, df if source is None else source, split)
    return out


def page_sequence(df: DataFrame, *, page_col: str = "page_title", ts_col: str = "timestamp",
                  id_col: str = "revid", change_col: str = "size_change",
                  stats: DataFrame | None = None, source: DataFrame | None = None,
                  max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Position in the page's history and the revert-candidate flag.

    A revert candidate removes more than 80 % of what the edit before changed.
    ``source`` may name a cheaper table with the same rows for the hot-page
    check.
    """
    split = split_hot_keys(df if source is None else source, page_col, max_rows)
    order = [ts_col, id_col]
    rows = with_sequence(df, split, order, (change_col,), stats=stats, source=source).withColumns({
        "page_edit_sequence": row_sequence(split, order),
        "_before": previous(change_col, split, order),
    })
    change = F.col(change_col)
    undo = F.abs(change) > F.lit(0.8) * F.coalesce(F.abs("_before"), F.lit(0))
    return (
        drop_carry(rows, split)
        .withColumn("is_revert_candidate", flag((change < 0) & undo))
        .drop("_before")
    )


def derived_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "edit_efficiency": F.col("size_change_abs") / (F.col("comment_length") + 1),
        "user_specialization": F.lit(1.0) / (F.col("user_pages_edited") + 1),
        "page_edit_density": F.col("page_total_edits") / (F.col("page_unique_editors") + 1),
    }).fillna(0, subset=DERIVED_FEATURES)


def features(silver: DataFrame, *, trailing: bool = False, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Silver plus the 28 features, and with ``trailing`` the trailing edit counts.

    Pass a stored silver table: statistics and hot-key checks read a few of its
    columns each, next to the one pass over whole rows.
    """
    by_user = user_sequence(silver, stats=user_stats(silver), horizons=TRAILING if trailing else None, max_rows=max_rows)
    # Counted on silver itself; the user step keeps every row.
    by_page = page_sequence(by_user, source=silver, stats=page_stats(silver), max_rows=max_rows)
    filled = by_page.fillna(0, subset=USER_FEATURES + PAGE_FEATURES)
    return derived_features(edit_features(temporal_features(filled)))


def user_features(silver: DataFrame, *, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """The user step of ``features`` alone, with the same values: for work that reads
    nothing of the page."""
    return user_sequence(silver, stats=user_stats(silver), max_rows=max_rows).fillna(0, subset=USER_FEATURES)


def trailing_edit_counts(df: DataFrame, *, user_col: str = "user", ts_col: str = "timestamp",
                         horizons: dict[str, int] | None = None,
                         source: DataFrame | None = None,
                         max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Edits by the same user in the last hour and the last seven days."""
    return trailing_counts(df, user_col, epoch_seconds(ts_col), horizons or TRAILING, max_rows, source)
