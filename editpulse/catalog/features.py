"""Ordered computations and the feature table."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.catalog.aggregates import changed, featured, plain
from editpulse.catalog.base import CHANGED, EDITS, FEATURES, rounded, with_
from editpulse.operators import aggregates as A
from editpulse.operators import clean as C
from editpulse.operators import features as FE
from editpulse.plans import edits as E
from editpulse.schemas import ALL_FEATURES
from editpulse.session import scratch_dir
from editpulse.sources import layout as L

_DOUBLES = {"user_avg_edit_size", "user_minor_edit_ratio", "page_avg_edit_size",
            "page_controversy_score", "edit_efficiency", "user_specialization", "page_edit_density"}


def columns_sql(names):
    return ", ".join(f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in names)


def pick(names):
    return with_(FEATURES, f"SELECT revid, {columns_sql(names)} FROM features")


def selected(fn, names):
    return changed(lambda df: fn(df).select("revid", *names))


def prev_size(df):
    return C.size_change(df, keep_prev=True).select(
        "revid", "prev_size", "size_change", "size_change_abs")


def trailing(spark, d):
    return FE.trailing_edit_counts(E.edits(spark, d)).select(
        "revid", "edits_last_hour", "edits_last_7_days")


def null_check(df):
    return A.null_counts(df, ALL_FEATURES)


def from_buckets(spark, d):
    """All features of edits that are stored in buckets of the user."""
    path = scratch_dir(spark, "by-user")
    buckets = L.buckets_for(E.edits(spark, d), 8)
    L.write_bucketed(E.edits_with_change(spark, d), "edits_by_user", path, buckets=buckets)
    found = FE.features(L.read_bucketed(spark, "edits_by_user", path), trailing=True)
    return rounded(found.select("revid", "page_title", "user", *ALL_FEATURES, *FE.TRAILING))


READS = {
    "pages": (dict(pages=["page_07", "page_42", "page_63"]), "page_title IN ('page_07', 'page_42', 'page_63')"),
    "week": (dict(since="2024-01-08", until="2024-01-15"), "ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'"),
    "both": (dict(pages=["page_42"], since="2024-01-10 12:00:00"), "page_title = 'page_42' AND ts >= TIMESTAMP '2024-01-10 12:00:00'"),
    "all": ({}, "true"),
}


def clustered_reads(spark, d):
    """Reads by page, by period, by both, and of all rows, from one clustered table."""
    path = scratch_dir(spark, "clustered")
    L.write_clustered(E.edits(spark, d), path, bits=3)
    out = [L.read_clustered(spark, path, **read).select(F.lit(name).alias("read"), "revid", "page_title", "user", "size_bytes")
           for name, (read, _) in READS.items()]
    return reduce(DataFrame.unionByName, out)


_USER = ["user_total_edits", "user_pages_edited", "user_avg_edit_size",
         "user_minor_edit_count", "user_minor_edit_ratio"]
_PAGE = ["page_total_edits", "page_unique_editors", "page_avg_edit_size",
         "page_additions", "page_deletions", "page_controversy_score"]
_TIME = ["is_weekend", "is_business_hours", "is_late_night", "hour_category"]
_EDIT = ["is_major_edit", "is_deletion", "is_addition", "edit_magnitude", "has_long_comment"]
_USER_SEQ = ["user_edit_sequence", "time_since_last_edit_sec", "user_is_rapid_editor"]
_PAGE_SEQ = ["page_edit_sequence", "is_revert_candidate"]
_DERIVED = ["edit_efficiency", "user_specialization", "page_edit_density"]

# One query per feature: only what this feature needs is computed.
_ONE_BY_ONE = {
    **{c: FE.edit_features for c in _EDIT},
    **{c: FE.user_sequence for c in _USER_SEQ}, **{c: FE.page_sequence for c in _PAGE_SEQ},
}


def one_time(column):
    return plain(lambda df: FE.temporal_features(df).select("revid", column))


def one_change(column):
    return changed(lambda df: df.select("revid", column))


def one_trailing(column, seconds):
    def run(spark, d):
        return FE.trailing_edit_counts(E.edits(spark, d), horizons={column: seconds}).select("revid", column)
    sql = with_(EDITS, f"""
        SELECT revid, count(*) OVER (PARTITION BY usr ORDER BY sec
          RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW) AS {column} FROM edits""")
    return run, sql


def efficiency(df):
    return df.select("revid", F.coalesce(
        F.col("size_change_abs") / (F.col("comment_length") + 1), F.lit(0.0)).alias("edit_efficiency"))


def specialization(df):
    return FE.join_user_stats(df).select(
        "revid", (F.lit(1.0) / (F.col("user_pages_edited") + 1)).alias("user_specialization"))


def density(df):
    return FE.join_page_stats(df).select(
        "revid", (F.col("page_total_edits") / (F.col("page_unique_editors") + 1)).alias("page_edit_density"))


QUERIES = {
    **{c: (selected(fn, [c]), pick([c])) for c, fn in _ONE_BY_ONE.items()},
    **{c: (one_time(c), pick([c])) for c in _TIME},
    "prev_size": (plain(lambda df: prev_size(df).select("revid", "prev_size")), with_(CHANGED, """
        SELECT revid, lag(size_bytes) OVER (PARTITION BY page_title ORDER BY ts, revid) AS prev_size FROM changed""")),
    "size_change_abs": (one_change("size_change_abs"), with_(CHANGED, "SELECT revid, size_change_abs FROM changed")),
    "edits_last_hour": one_trailing("edits_last_hour", FE.HOUR),
    "edits_last_7_days": one_trailing("edits_last_7_days", FE.WEEK),
    "user_features": (selected(FE.join_user_stats, ["user", *_USER]), with_(FEATURES, f"""
        SELECT revid, usr AS "user", {columns_sql(_USER)} FROM features""")),
    "page_features": (selected(FE.join_page_stats, ["page_title", *_PAGE]), with_(FEATURES, f"""
        SELECT revid, page_title, {columns_sql(_PAGE)} FROM features""")),
    "edit_efficiency": (changed(efficiency), pick(["edit_efficiency"])),
    "user_specialization": (changed(specialization), pick(["user_specialization"])),
    "page_edit_density": (changed(density), pick(["page_edit_density"])),
    "size_change": (plain(prev_size), with_(CHANGED, """
        SELECT revid, lag(size_bytes) OVER (PARTITION BY page_title ORDER BY ts, revid) AS prev_size,
               size_change, size_change_abs FROM changed""")),
    "join_user_stats": (selected(FE.join_user_stats, _USER), pick(_USER)),
    "join_page_stats": (selected(FE.join_page_stats, _PAGE), pick(_PAGE)),
    "temporal_features": (selected(FE.temporal_features, _TIME), pick(_TIME)),
    "edit_features": (selected(FE.edit_features, _EDIT), pick(_EDIT)),
    "user_sequence": (selected(FE.user_sequence, _USER_SEQ), pick(_USER_SEQ)),
    "page_sequence": (selected(FE.page_sequence, _PAGE_SEQ), pick(_PAGE_SEQ)),
    "derived_features": (featured(lambda df: df.select("revid", *_DERIVED)), pick(_DERIVED)),
    "trailing_edit_counts": (trailing, with_(EDITS, """
        SELECT revid, count(*) OVER (PARTITION BY usr ORDER BY sec
                 RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS edits_last_hour,
               count(*) OVER (PARTITION BY usr ORDER BY sec
                 RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS edits_last_7_days
        FROM edits""")),
    "features_all": (
        featured(lambda df: df.select("revid", "page_title", "user", *ALL_FEATURES)),
        with_(FEATURES, f'SELECT revid, page_title, usr AS "user", {columns_sql(ALL_FEATURES)} FROM features')),
    "features_from_buckets": (from_buckets, with_(FEATURES, f"""
        SELECT revid, page_title, usr AS "user", {columns_sql(ALL_FEATURES)},
               count(*) OVER (PARTITION BY usr ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS edits_last_hour,
               count(*) OVER (PARTITION BY usr ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS edits_last_7_days
        FROM features""")),
    "clustered_reads": (clustered_reads, with_(EDITS, " UNION ALL ".join(
        f"""SELECT '{name}' AS "read", revid, page_title, usr AS "user", size_bytes FROM edits WHERE {where}""" for name, (_, where) in READS.items()))),
    "features_null_check": (
        featured(null_check),
        with_(FEATURES, "SELECT " + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}" for c in ALL_FEATURES) + " FROM features")),
}
