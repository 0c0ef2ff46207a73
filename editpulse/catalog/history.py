"""Tables that grow by deliveries, and aggregates merged over months."""

from pyspark.sql import functions as F

from editpulse.catalog.base import BRONZE, EDITS, FEATURES, STATS, rounded, with_
from editpulse.catalog.streams import arriving
from editpulse.operators import partials as P
from editpulse.plans import edits as E
from editpulse.plans import history as H
from editpulse.session import scratch_dir
from editpulse.sources import deliveries as D
from editpulse.sources import tables as TB
from editpulse.sources.id_index import add_ids, not_indexed


def delivered_history(spark, d):
    """Five deliveries in the order of time but for the last, which is late."""
    path = scratch_dir(spark, "history")
    for part in arriving(spark, d):
        H.extend_history(spark, path, E.edits_of(part), buckets=8)
    return H.history_features(spark, path)


def by_index(spark, d):
    """New revisions told by the index of ids, not by the stored revisions."""
    path = scratch_dir(spark, "ids")
    add_ids(E.edits(spark, d).filter("hour < 12"), path, 0)
    D.commit(spark, path, 0)
    return not_indexed(E.bronze(spark, d), path).select("revid", "page_title", "comment")


def months(spark, d):
    """Partials of each month, stored one month after the other."""
    path = scratch_dir(spark, "partials")
    edits = E.edits_with_change(spark, d)
    for r in edits.select("year", "month").distinct().orderBy("year", "month").collect():
        part = P.monthly_partials(edits.filter((F.col("year") == r.year) & (F.col("month") == r.month)))
        TB.write_by_month(part, path, increment=True)
    return TB.read_table(spark, path)


def merged(fn):
    return lambda spark, d: rounded(fn(months(spark, d)))


QUERIES = {
    "incremental_history": (delivered_history, with_(FEATURES, """
        SELECT revid, size_change, size_change_abs, page_edit_sequence, is_revert_candidate, user_edit_sequence,
               time_since_last_edit_sec, user_is_rapid_editor FROM features""")),
    "append_by_id_index": (by_index, with_(BRONZE, """
        SELECT revid, page_title, comment FROM (
          SELECT *, row_number() OVER (PARTITION BY revid ORDER BY stamp NULLS LAST, page_title, usr) AS rn FROM bronze)
        WHERE rn = 1 AND revid NOT IN (SELECT event_id FROM events WHERE hour(ts) < 12)""")),
    "merged_user_stats": (merged(P.merged_user_stats), with_(STATS, """
        SELECT usr AS "user", user_total_edits, user_pages_edited, round(user_avg_edit_size, 6) AS user_avg_edit_size,
               user_minor_edit_count, round(user_minor_edit_ratio, 6) AS user_minor_edit_ratio FROM user_stats""")),
    "merged_page_stats": (merged(P.merged_page_stats), with_(STATS, """
        SELECT page_title, page_total_edits, page_unique_editors, round(page_avg_edit_size, 6) AS page_avg_edit_size,
               page_additions, page_deletions, round(page_controversy_score, 6) AS page_controversy_score FROM page_stats""")),
    "merged_dataset_kpis": (merged(P.merged_dataset_kpis), with_(EDITS, """
        SELECT count(*) AS total_edits, count(DISTINCT page_title) AS total_pages, count(DISTINCT usr) AS total_users,
               cast(sum(is_bot) AS bigint) AS bot_edits, cast(sum(is_anon) AS bigint) AS anon_edits, cast(sum(is_minor) AS bigint) AS minor_edits,
               round(avg(size_bytes), 1) AS avg_edit_size, round(100.0::double * sum(is_bot) / count(*), 2) AS bot_pct,
               round(100.0::double * sum(is_anon) / count(*), 2) AS anon_pct, round(100.0::double * sum(is_minor) / count(*), 2) AS minor_pct FROM edits""")),
    "merged_summary": (merged(P.merged_summary), with_(EDITS, """
        SELECT count(*) AS total_edits, count(DISTINCT page_title) AS unique_pages, count(DISTINCT usr) AS unique_users,
               round(avg(size_bytes), 6) AS avg_edit_size, round(avg(length(comment)), 6) AS avg_comment_len,
               cast(sum(is_bot) AS bigint) AS bot_edits, cast(sum(is_anon) AS bigint) AS anon_edits, cast(sum(is_minor) AS bigint) AS minor_edits,
               strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS earliest_edit, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest_edit FROM edits""")),
}
