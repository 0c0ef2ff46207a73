"""SQL building blocks and result formatting shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Edits over the events table.
EDITS = """edits AS (
  SELECT event_id AS revid,
         'page_' || lpad(cast(cast(json_extract(props, '$.k') AS int) AS varchar), 2, '0') AS page_title,
         'user_' || cast(user_id AS varchar) AS usr, ts,
         cast(floor(value * 20) AS bigint) AS size_bytes,
         CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS is_minor,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_anon,
         CASE WHEN user_id % 7 = 0 THEN 1 ELSE 0 END AS is_bot,
         CASE WHEN event_type = 'signup' THEN ''
              ELSE repeat(event_type || ' ', 1 + cast(json_extract(props, '$.k') AS int) % 10) END AS comment,
         cast(year(ts) AS int) AS year, cast(month(ts) AS int) AS month,
         cast(day(ts) AS int) AS day, cast(hour(ts) AS int) AS hour,
         cast(dayofweek(ts) + 1 AS int) AS day_of_week, dayname(ts) AS day_name,
         cast(floor(epoch(ts)) AS bigint) AS sec
  FROM events)"""

CHANGED = EDITS + """, changed AS (
  SELECT *, cast(length(comment) AS int) AS comment_length,
         CASE WHEN comment <> '' THEN 1 ELSE 0 END AS has_comment,
         size_bytes - coalesce(lag(size_bytes) OVER (PARTITION BY page_title ORDER BY ts, revid), 0) AS size_change,
         abs(size_bytes - coalesce(lag(size_bytes) OVER (PARTITION BY page_title ORDER BY ts, revid), 0)) AS size_change_abs
  FROM edits)"""

STATS = CHANGED + """, user_stats AS (
  SELECT usr, count(*) AS user_total_edits, count(DISTINCT page_title) AS user_pages_edited,
         avg(size_change_abs) AS user_avg_edit_size, cast(sum(is_minor) AS bigint) AS user_minor_edit_count,
         sum(is_minor) / cast(count(*) AS double) AS user_minor_edit_ratio
  FROM changed GROUP BY usr), page_stats AS (
  SELECT page_title, count(*) AS page_total_edits, count(DISTINCT usr) AS page_unique_editors,
         avg(size_change_abs) AS page_avg_edit_size,
         count(*) FILTER (size_change > 0) AS page_additions,
         count(*) FILTER (size_change < 0) AS page_deletions,
         count(*) * count(DISTINCT usr) / 1000.0::double AS page_controversy_score
  FROM changed GROUP BY page_title)"""

FEATURES = STATS + """, sequenced AS (
  SELECT *,
         row_number() OVER (PARTITION BY usr ORDER BY ts, revid) AS user_edit_sequence,
         coalesce(sec - lag(sec) OVER (PARTITION BY usr ORDER BY ts, revid), 0) AS time_since_last_edit_sec,
         row_number() OVER (PARTITION BY page_title ORDER BY ts, revid) AS page_edit_sequence,
         CASE WHEN size_change < 0 AND abs(size_change) >
              0.8::double * coalesce(abs(lag(size_change) OVER (PARTITION BY page_title ORDER BY ts, revid)), 0)
              THEN 1 ELSE 0 END AS is_revert_candidate
  FROM changed), features AS (
  SELECT *,
         CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours,
         CASE WHEN hour >= 22 OR hour <= 5 THEN 1 ELSE 0 END AS is_late_night,
         CASE WHEN hour >= 6 AND hour < 12 THEN 'morning' WHEN hour >= 12 AND hour < 18 THEN 'afternoon'
              WHEN hour >= 18 AND hour < 22 THEN 'evening' ELSE 'night' END AS hour_category,
         CASE WHEN size_change_abs > 1000 THEN 1 ELSE 0 END AS is_major_edit,
         CASE WHEN size_change < -100 THEN 1 ELSE 0 END AS is_deletion,
         CASE WHEN size_change > 100 THEN 1 ELSE 0 END AS is_addition,
         CASE WHEN size_change_abs < 100 THEN 'small' WHEN size_change_abs < 1000 THEN 'medium'
              ELSE 'large' END AS edit_magnitude,
         CASE WHEN comment_length > 50 THEN 1 ELSE 0 END AS has_long_comment,
         CASE WHEN time_since_last_edit_sec BETWEEN 1 AND 60 THEN 1 ELSE 0 END AS user_is_rapid_editor,
         coalesce(size_change_abs / cast(comment_length + 1 AS double), 0) AS edit_efficiency,
         1.0::double / (user_pages_edited + 1) AS user_specialization,
         page_total_edits / cast(page_unique_editors + 1 AS double) AS page_edit_density
  FROM sequenced JOIN user_stats USING (usr) JOIN page_stats USING (page_title))"""

# Raw records with repeated deliveries, gaps and unreadable times.
BRONZE = """deliveries AS (
  SELECT *, ts AS seen, 0 AS copy FROM events
  UNION ALL SELECT *, ts + INTERVAL 1 HOUR AS seen, 1 AS copy FROM events WHERE event_type = 'click'
), numbered AS (
  SELECT *, cast(json_extract(props, '$.k') AS int) AS k FROM deliveries
), bronze AS (
  SELECT CASE WHEN event_type = 'signup' AND k >= 95 THEN NULL
              ELSE 'page_' || lpad(cast(k AS varchar), 2, '0') END AS page_title,
         cast(k AS varchar) AS page_id, k * 3 AS page_watchers, event_id AS revid,
         cast(0 AS bigint) AS parentid,
         CASE WHEN event_type = 'error' AND k = 50 THEN 'not a time'
              ELSE strftime(seen, '%Y-%m-%dT%H:%M:%S.%fZ') END AS stamp,
         CASE WHEN event_type = 'error' AND k = 50 THEN NULL ELSE seen END AS ts,
         CASE WHEN event_type = 'purchase' AND k < 10 THEN NULL
              ELSE 'user_' || cast(user_id AS varchar) END AS usr,
         user_id AS userid, event_type = 'error' AS anon,
         cast(floor(value * 20) AS bigint) AS size,
         CASE WHEN copy = 1 THEN 'again' WHEN event_type = 'signup' THEN ''
              ELSE repeat(event_type || ' ', 1 + k % 10) END AS comment,
         CASE WHEN event_type <> 'signup' THEN event_type = 'view' END AS minor,
         user_id % 7 = 0 AS bot, event_type AS tags
  FROM numbered)"""

SILVER = BRONZE + """, kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY revid ORDER BY ts NULLS LAST, page_title, usr) AS rn
    FROM bronze WHERE page_title IS NOT NULL AND revid IS NOT NULL AND usr IS NOT NULL AND stamp IS NOT NULL)
  WHERE rn = 1), silver AS (
  SELECT page_title, page_id, page_watchers, revid, parentid, ts,
         cast(year(ts) AS int) AS year, cast(month(ts) AS int) AS month, cast(day(ts) AS int) AS day,
         cast(hour(ts) AS int) AS hour, cast(dayofweek(ts) + 1 AS int) AS day_of_week, dayname(ts) AS day_name,
         usr, userid, CASE WHEN anon THEN 1 ELSE 0 END AS is_anon, CASE WHEN bot THEN 1 ELSE 0 END AS is_bot,
         size AS size_bytes,
         size - coalesce(lag(size) OVER (PARTITION BY page_title ORDER BY ts NULLS FIRST, revid), 0) AS size_change,
         abs(size - coalesce(lag(size) OVER (PARTITION BY page_title ORDER BY ts NULLS FIRST, revid), 0)) AS size_change_abs,
         CASE WHEN minor THEN 1 ELSE 0 END AS is_minor, comment, cast(length(comment) AS int) AS comment_length,
         CASE WHEN comment <> '' THEN 1 ELSE 0 END AS has_comment, tags
  FROM kept)"""

DATASET_KPIS = """SELECT count(*) AS total_edits, count(DISTINCT page_title) AS total_pages,
  count(DISTINCT usr) AS total_users, cast(sum(is_bot) AS bigint) AS bot_edits,
  cast(sum(is_anon) AS bigint) AS anon_edits, cast(sum(is_minor) AS bigint) AS minor_edits,
  round(avg(size_bytes), 1) AS avg_edit_size, round(100.0::double * sum(is_bot) / count(*), 2) AS bot_pct,
  round(100.0::double * sum(is_anon) / count(*), 2) AS anon_pct,
  round(100.0::double * sum(is_minor) / count(*), 2) AS minor_pct FROM edits"""

# Bucket 0..99 of a revision id, from its md5.
BUCKET = "cast('0x' || substr(md5(cast(revid AS varchar)), 1, 6) AS int) % 100"
STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a comparable number of digits, times to text, lists to text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double":
            c = F.round(c, digits)
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "array<string>":
            c = F.array_join(c, ",")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(name))
    return df.select(*out)


def long_table(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    """All tables of a report as rows (part, item, figure, value): ``keys`` names the
    column that tells the rows of a table apart; times count in microseconds."""
    out = None
    for name, table in tables.items():
        key = (keys or {}).get(name)
        times = {c for c, kind in table.dtypes if kind.startswith("timestamp")}
        figures = [c for c in table.columns if c != key]
        rows = table.select(F.lit(name).alias("part"), (F.col(key).cast("string") if key else F.lit("")).alias("item"), *[
            (F.unix_micros(c) if c in times else F.col(c)).cast("double").alias(c) for c in figures]).unpivot(["part", "item"], figures, "figure", "value")
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("value", F.round("value", 6))
