"""Aggregates, set operations, top-k tables and joins."""

from pyspark.sql import functions as F

from editpulse.catalog.base import BRONZE, CHANGED, EDITS, FEATURES, SILVER, STATS, rounded, with_
from editpulse.operators import aggregates as A
from editpulse.operators import features as FE
from editpulse.operators import topk as T
from editpulse.operators.clean import silver
from editpulse.operators.joins import join_cluster_labels, new_revisions
from editpulse.plans import edits as E
from editpulse.schemas import BRONZE as BRONZE_SCHEMA
from editpulse.sources.tables import register_edits, top_editors_sql


def changed(fn):
    return lambda spark, d: rounded(fn(E.edits_with_change(spark, d)))


def plain(fn):
    return lambda spark, d: rounded(fn(E.edits(spark, d)))


def featured(fn):
    return lambda spark, d: rounded(fn(E.edit_features(spark, d)))


def segments(df):
    """A given (not learned) user segment, for tables about clusters."""
    n = F.col("total_edits")
    return df.withColumn("prediction", F.when(n < 60, 0).when(n < 70, 1).otherwise(2))


def guesses(df):
    """A given (not learned) prediction of the bot flag."""
    quick = (F.col("comment_length") % 3 == 0) | (F.col("is_bot") * F.col("is_minor") == 1)
    return df.select("revid", F.col("is_bot").alias("label"),
                     F.when(quick, 1).otherwise(0).alias("prediction"))


PROFILES = CHANGED + """, profiles AS (
  SELECT usr, count(*) AS total_edits, count(DISTINCT page_title) AS pages_edited,
         avg(size_change_abs) AS avg_edit_size, cast(sum(is_minor) AS bigint) AS minor_edits,
         cast(sum(is_bot) AS bigint) AS is_bot_flag, avg(comment_length) AS avg_comment_len
  FROM changed GROUP BY usr HAVING count(*) >= 5), clustered AS (
  SELECT *, CASE WHEN total_edits < 60 THEN 0 WHEN total_edits < 70 THEN 1 ELSE 2 END AS prediction
  FROM profiles)"""

GUESSES = CHANGED + """, guesses AS (
  SELECT revid, is_bot AS label,
         CASE WHEN comment_length % 3 = 0 OR is_bot * is_minor = 1 THEN 1 ELSE 0 END AS prediction
  FROM changed)"""

HOURLY = EDITS + """, hourly AS (
  SELECT *, count(*) OVER (PARTITION BY usr ORDER BY sec
            RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS edits_last_hour FROM edits)"""

FLAGSHIP_SQL = with_(STATS, """SELECT page_title, page_total_edits, page_unique_editors,
  round(page_avg_edit_size, 6) AS page_avg_edit_size, page_additions, page_deletions,
  round(page_controversy_score, 6) AS page_controversy_score
  FROM page_stats ORDER BY page_controversy_score DESC, page_title LIMIT 10""")


def flagship(spark, d):
    """Most contested pages."""
    stats = A.page_stats(E.edits_with_change(spark, d))
    return rounded(stats.orderBy(F.desc("page_controversy_score"), "page_title").limit(10))


def append_new(spark, d):
    stored = E.edits(spark, d).filter("hour < 12").select("revid")
    return new_revisions(E.bronze(spark, d), stored).select("revid", "page_title", "comment")


def sql_view(spark, d):
    return top_editors_sql(spark, register_edits(E.edits(spark, d)))


def layers(spark, d):
    raw = E.bronze(spark, d)
    return A.retention(raw, silver(raw))


def labelled_edits(df):
    users = segments(A.user_profiles(df))
    return join_cluster_labels(df, users).select("revid", "user", "prediction")


_BRONZE_SQL = {"user": "usr", "timestamp": "stamp", "collected_at": "NULL"}

QUERIES = {
    "contested_pages": (flagship, FLAGSHIP_SQL),
    "silver_summary": (changed(A.silver_summary), with_(CHANGED, """
        SELECT count(*) AS total_edits, count(DISTINCT page_title) AS unique_pages,
               count(DISTINCT usr) AS unique_users, round(avg(size_bytes), 6) AS avg_edit_size,
               round(avg(comment_length), 6) AS avg_comment_len, cast(sum(is_bot) AS bigint) AS bot_edits,
               cast(sum(is_anon) AS bigint) AS anon_edits, cast(sum(is_minor) AS bigint) AS minor_edits
        FROM changed""")),
    "date_range": (plain(A.date_range), with_(EDITS, """
        SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS earliest_edit,
               strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest_edit FROM edits""")),
    "user_stats": (changed(A.user_stats), with_(STATS, """
        SELECT usr AS "user", user_total_edits, user_pages_edited,
               round(user_avg_edit_size, 6) AS user_avg_edit_size, user_minor_edit_count,
               round(user_minor_edit_ratio, 6) AS user_minor_edit_ratio FROM user_stats""")),
    "page_stats": (changed(A.page_stats), with_(STATS, """
        SELECT page_title, page_total_edits, page_unique_editors,
               round(page_avg_edit_size, 6) AS page_avg_edit_size, page_additions, page_deletions,
               round(page_controversy_score, 6) AS page_controversy_score FROM page_stats""")),
    "null_counts": (lambda spark, d: A.null_counts(E.bronze(spark, d)), with_(BRONZE, "SELECT " + ", ".join(
        f'count(*) FILTER ({_BRONZE_SQL.get(c, c)} IS NULL) AS "{c}"' for c in BRONZE_SCHEMA.fieldNames()) + " FROM bronze")),
    "duplicate_count": (lambda spark, d: A.duplicate_count(E.bronze(spark, d)), with_(BRONZE, """
        SELECT count(*) - count(DISTINCT revid) AS duplicate_rows FROM bronze""")),
    "retention": (layers, with_(SILVER, """
        SELECT r AS raw_count, f AS final_count, r - f AS removed, round(100.0::double * f / r, 2) AS kept_pct
        FROM (SELECT (SELECT count(*) FROM bronze) AS r, (SELECT count(*) FROM silver) AS f)""")),
    "partition_count": (plain(lambda df: A.partition_count(df, ("year", "month"))), with_(EDITS, """
        SELECT count(*) AS partitions FROM (SELECT DISTINCT year, month FROM edits)""")),
    "distinct_rows": (plain(lambda df: A.distinct_rows(df, ["year", "month", "day", "day_name"])),
                      with_(EDITS, "SELECT DISTINCT year, month, day, day_name FROM edits")),
    "sql_top_editors_per_page": (sql_view, with_(EDITS, """
        SELECT page_title, count(*) AS edit_count, count(DISTINCT usr) AS unique_editors
        FROM edits GROUP BY page_title ORDER BY edit_count DESC, page_title LIMIT 5""")),
    "top_editors_per_page": (plain(T.top_editors_per_page), with_(EDITS, """
        SELECT page_title, count(*) AS edit_count, count(DISTINCT usr) AS unique_editors
        FROM edits GROUP BY page_title ORDER BY edit_count DESC, page_title LIMIT 5""")),
    "value_distribution": (
        changed(lambda df: A.value_distribution(FE.edit_features(df), "edit_magnitude")),
        with_(FEATURES, "SELECT edit_magnitude, count(*) AS edits FROM features GROUP BY edit_magnitude")),
    "ordered_distribution": (
        plain(lambda df: A.ordered_distribution(FE.temporal_features(df), "hour_category")),
        with_(FEATURES, """SELECT hour_category, count(*) AS edits FROM features
        GROUP BY hour_category ORDER BY edits DESC, hour_category""")),
    "label_class_check": (
        changed(lambda df: A.label_class_check(FE.edit_features(df), "edit_magnitude", 1000)),
        with_(FEATURES, """SELECT count(*) AS classes, count(*) FILTER (n < 1000) AS tiny_classes,
        count(*) >= 2 AS ok FROM (SELECT edit_magnitude, count(*) AS n FROM features GROUP BY 1)""")),
    "confusion_matrix": (plain(lambda df: A.confusion_matrix(guesses(df))), with_(GUESSES, """
        SELECT label, prediction, count(*) AS n, 'act' || label || '_pred' || prediction AS cell
        FROM guesses GROUP BY label, prediction""")),
    "user_profiles": (changed(A.user_profiles), with_(PROFILES, """
        SELECT usr AS "user", total_edits, pages_edited, round(avg_edit_size, 6) AS avg_edit_size,
               minor_edits, is_bot_flag, round(avg_comment_len, 6) AS avg_comment_len FROM profiles""")),
    "user_profiles_kpi": (
        plain(lambda df: A.user_profiles_kpi(FE.trailing_edit_counts(
            df, horizons={"edits_last_hour": FE.HOUR}))),
        with_(HOURLY, """
        SELECT usr AS "user", count(*) AS total_edits, round(avg(size_bytes), 6) AS avg_edit_size,
               cast(sum(is_bot) AS bigint) AS bot_edit_count, cast(sum(is_minor) AS bigint) AS minor_edit_count,
               round(avg(edits_last_hour), 6) AS avg_hourly_rate, count(DISTINCT page_title) AS unique_pages
        FROM hourly GROUP BY usr HAVING count(*) >= 3""")),
    "user_size_profile": (plain(A.user_size_profile), with_(EDITS, """
        SELECT usr AS "user", count(*) AS total_edits, round(avg(size_bytes), 6) AS avg_edit_size
        FROM edits GROUP BY usr""")),
    "cluster_sizes": (changed(lambda df: A.cluster_sizes(segments(A.user_profiles(df)))),
                      with_(PROFILES, """SELECT prediction, count(*) AS users FROM clustered
                      GROUP BY prediction ORDER BY prediction""")),
    "cluster_profiles": (changed(lambda df: A.cluster_profiles(segments(A.user_profiles(df)))),
                         with_(PROFILES, """
        SELECT prediction, count(*) AS users, round(avg(total_edits), 6) AS avg_edits,
               round(avg(pages_edited), 6) AS avg_pages, round(avg(avg_edit_size), 6) AS avg_size,
               round(avg(minor_edits), 6) AS avg_minor, round(avg(is_bot_flag), 6) AS avg_bot_edits
        FROM clustered GROUP BY prediction ORDER BY prediction""")),
    "threshold_filter": (plain(lambda df: A.group_having(df, ["user", "page_title"], 3)), with_(EDITS, """
        SELECT usr AS "user", page_title, count(*) AS edits FROM edits
        GROUP BY usr, page_title HAVING count(*) >= 3""")),
    "top_pages": (plain(T.top_pages), with_(EDITS, """
        SELECT page_title, count(*) AS edits FROM edits GROUP BY page_title
        ORDER BY edits DESC, page_title LIMIT 10""")),
    "top_users": (plain(T.top_users), with_(EDITS, """
        SELECT usr AS "user", count(*) AS edits FROM edits GROUP BY usr
        ORDER BY edits DESC, usr LIMIT 10""")),
    "edits_by_hour": (plain(T.edits_by_hour), with_(EDITS, """
        SELECT hour, count(*) AS edits FROM edits GROUP BY hour ORDER BY hour""")),
    "top_revert_pages": (changed(lambda df: T.top_revert_pages(FE.page_sequence(df))), with_(FEATURES, """
        SELECT page_title, count(*) AS reverts FROM features WHERE is_revert_candidate = 1
        GROUP BY page_title ORDER BY reverts DESC, page_title LIMIT 10""")),
    "top_velocity_pages": (plain(T.top_velocity_pages), with_(EDITS, """
        SELECT page_title, edits, round(days, 6) AS days, round(edits / days, 6) AS edits_per_day
        FROM (SELECT page_title, count(*) AS edits, (max(sec) - min(sec)) / 86400.0::double AS days
              FROM edits GROUP BY page_title) WHERE days > 1
        ORDER BY edits / days DESC, page_title LIMIT 10""")),
    "join_cluster_labels": (changed(labelled_edits), with_(PROFILES, """
        SELECT revid, usr AS "user", prediction FROM changed JOIN clustered USING (usr)""")),
    "append_new_revisions": (append_new, with_(BRONZE, """
        SELECT revid, page_title, comment FROM (
          SELECT *, row_number() OVER (PARTITION BY revid ORDER BY stamp NULLS LAST, page_title, usr) AS rn FROM bronze)
        WHERE rn = 1 AND revid NOT IN (SELECT event_id FROM events WHERE hour(ts) < 12)""")),
}
