"""Column expressions: casts, time parts, flags, rounding and hash buckets.

Raw text goes through ``try_*`` functions so that one bad value becomes NULL
instead of failing the job under ANSI mode; typed columns use plain casts.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """Text to TIMESTAMP, NULL when it is not a timestamp."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def time_parts(ts="timestamp") -> dict[str, Column]:
    ts = _col(ts)
    return {
        "year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts),
        "hour": F.hour(ts), "day_of_week": F.dayofweek(ts),
    }


def day_name(ts="timestamp") -> Column:
    return F.date_format(_col(ts), "EEEE")


def iso_day(ts="timestamp") -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def epoch_seconds(ts="timestamp") -> Column:
    """Whole seconds since the epoch; works for both timestamp types."""
    return F.unix_timestamp(_col(ts).cast("timestamp"))


def try_cast(c, data_type: str) -> Column:
    return _col(c).try_cast(data_type)


def flag(condition: Column) -> Column:
    """Boolean to 0/1, NULL counts as 0."""
    return F.when(condition, 1).otherwise(0)


def has_text(c) -> Column:
    c = _col(c)
    return flag(c.isNotNull() & (c != ""))


def text_length(c) -> Column:
    return F.length(_col(c))


def percent(part, total, decimals: int = 2) -> Column:
    """``100 * part / total`` rounded, NULL for an empty total."""
    return F.round(F.try_divide(F.lit(100.0) * _col(part), _col(total)), decimals)


def safe_round(c, decimals: int = 4) -> Column:
    return F.round(_col(c).try_cast("double"), decimals)


def hash_text(c="revid") -> Column:
    """Stable hexadecimal hash of an id, the same in any engine with md5."""
    return F.md5(_col(c).cast("string"))


def hash_bucket(c="revid", buckets: int = 100) -> Column:
    """Stable bucket 0..buckets-1 of an id; does not depend on partitioning."""
    prefix = F.substring(hash_text(c), 1, 6)
    return (F.conv(prefix, 16, 10).cast("int") % F.lit(buckets)).cast("int")


def months_between_filter(start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Predicate on the year/month partition columns, both ends inclusive.

    Stated on the partition columns themselves so that the scan skips folders.
    """
    (y0, m0), (y1, m1) = start, end
    year, month = F.col("year"), F.col("month")
    after = (year > y0) | ((year == y0) & (month >= m0))
    before = (year < y1) | ((year == y1) & (month <= m1))
    return after & before
