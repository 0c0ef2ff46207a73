"""Raw revisions to clean, typed, de-duplicated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.functions.scalars import (
    day_name, flag, has_text, parse_timestamp, text_length, time_parts, try_cast,
)
from editpulse.operators.keysplit import (
    MAX_ROWS, drop_carry, has_hot_keys, previous, split_hot_keys, with_sequence,
)
from editpulse.schemas import REQUIRED, SILVER_COLUMNS
from editpulse.session import stored


def require_not_null(df: DataFrame, columns: list[str] = REQUIRED) -> DataFrame:
    return df.dropna(subset=columns)


def dedup_revisions(df: DataFrame, *, id_col: str = "revid",
                    prefer: list[str] | None = None) -> DataFrame:
    """One row per revision id: the earliest, ties broken by every column.

    ``row_number = 1`` is planned as a group limit before the shuffle, so each
    map task sends at most one row per id however often it was collected.
    """
    prefer = prefer or [c for c in ("timestamp", "page_title", "user") if c in df.columns]
    rest = [c for c in df.columns if c not in prefer and c != id_col]
    order = [F.col(c).asc_nulls_last() for c in prefer + rest]
    w = Window.partitionBy(id_col).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def bool_flags(df: DataFrame, flags: dict[str, str] | None = None) -> DataFrame:
    """Booleans to 0/1 integers; NULL becomes 0."""
    flags = flags or {"is_minor": "minor", "is_bot": "bot", "is_anon": "anon"}
    return df.withColumns({out: flag(F.col(c)) for out, c in flags.items()})


def comment_columns(df: DataFrame, comment_col: str = "comment") -> DataFrame:
    return df.withColumns({
        "comment_length": text_length(comment_col),
        "has_comment": has_text(comment_col),
    })


def time_columns(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return df.withColumns({**time_parts(ts_col), "day_name": day_name(ts_col)})


def size_change(df: DataFrame, *, page_col: str = "page_title", ts_col: str = "timestamp",
                id_col: str = "revid", size_col: str = "size_bytes",
                keep_prev: bool = False,
                max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Size difference to the page's previous revision, in (time, id) order.

    The first revision counts in full. A NULL size gives a NULL change, and
    the revision after it counts in full again.
    """
    split = split_hot_keys(df, page_col, max_rows)
    order = [ts_col, id_col]
    out = with_sequence(df, split, order, (size_col,)).withColumn(
        "prev_size", previous(size_col, split, order))
    change = F.col(size_col) - F.coalesce("prev_size", F.lit(0))
    out = drop_carry(out, split).withColumns({
        "size_change": change, "size_change_abs": F.abs(change)})
    return out if keep_prev else out.drop("prev_size")


def silver_projection(df: DataFrame) -> DataFrame:
    """The 24 silver columns with their fixed types."""
    ints = {"page_watchers", "year", "month", "day", "hour", "day_of_week",
            "is_anon", "is_bot", "is_minor", "comment_length", "has_comment"}
    longs = {"revid", "parentid", "userid", "size_bytes", "size_change", "size_change_abs"}
    return df.select(*[
        try_cast(c, "int").alias(c) if c in ints
        else try_cast(c, "bigint").alias(c) if c in longs
        else F.col(c)
        for c in SILVER_COLUMNS])


def clean_revisions(bronze: DataFrame) -> DataFrame:
    """Bronze rows to typed rows, everything but the size change."""
    typed = require_not_null(bronze).withColumns({
        "timestamp": parse_timestamp("timestamp"),
        "size_bytes": try_cast("size", "bigint"),
    }).drop("size", "collected_at")
    rows = dedup_revisions(typed)
    return comment_columns(bool_flags(time_columns(rows)))


def silver(bronze: DataFrame, *, max_rows: int | None = MAX_ROWS, parse_once: bool = False) -> DataFrame:
    """Bronze to silver in one lazy plan: two shuffles, by id and by page.

    The hot-page check counts bronze rows, before de-duplication, so it costs
    one narrow pass and no extra shuffle of whole rows. Where there are hot
    pages, the cleaned rows are read more than once and therefore stored.
    With ``parse_once`` they are stored first and counted there: for raw JSON,
    where a second pass costs more than writing the cleaned rows.
    """
    rows = clean_revisions(bronze)
    if parse_once:
        return silver_projection(size_change(stored(rows, "clean"), max_rows=max_rows))
    if not has_hot_keys(require_not_null(bronze), "page_title", max_rows):
        return silver_projection(size_change(rows, max_rows=None))
    return silver_projection(size_change(stored(rows, "clean"), max_rows=max_rows))
