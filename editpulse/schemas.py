"""Explicit schemas and column lists shared by every layer."""

from pyspark.sql import types as T

# One raw revision record as the collectors write it.
BRONZE = T.StructType([
    T.StructField("page_title", T.StringType()),
    T.StructField("page_id", T.StringType()),
    T.StructField("page_watchers", T.IntegerType()),
    T.StructField("revid", T.LongType()),
    T.StructField("parentid", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("userid", T.LongType()),
    T.StructField("anon", T.BooleanType()),
    T.StructField("size", T.LongType()),
    T.StructField("comment", T.StringType()),
    T.StructField("minor", T.BooleanType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("collected_at", T.StringType()),
])

REQUIRED = ["page_title", "revid", "user", "timestamp"]

# Fields of one live event; flags use the raw record names.
STREAM_EVENT = T.StructType([
    T.StructField("page_title", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("minor", T.BooleanType()),
    T.StructField("bot", T.BooleanType()),
])

# Nested page payload of the history API. Flag fields count by presence, so
# their values are read as text.
API_REVISION = T.StructType([
    T.StructField("revid", T.LongType()),
    T.StructField("parentid", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("userid", T.LongType()),
    T.StructField("size", T.LongType()),
    T.StructField("comment", T.StringType()),
    T.StructField("anon", T.StringType()),
    T.StructField("minor", T.StringType()),
    T.StructField("bot", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])
API_RESPONSE = T.StructType([
    T.StructField("query", T.StructType([
        T.StructField("pages", T.MapType(T.StringType(), T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("watchers", T.IntegerType()),
            T.StructField("revisions", T.ArrayType(API_REVISION)),
        ]))),
    ])),
])

# Parts of an XML history dump. Ids are read as text so that one malformed id
# does not void its revision.
XML_PAGE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("id", T.StringType()),
])
XML_REVISION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("parentid", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("contributor", T.StructType([
        T.StructField("username", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("id", T.StringType()),
    ])),
    T.StructField("minor", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("text", T.StructType([
        T.StructField("_VALUE", T.StringType()),
        T.StructField("_bytes", T.LongType()),
    ])),
])

# Silver and feature column names.
SILVER_COLUMNS = [
    "page_title", "page_id", "page_watchers", "revid", "parentid", "timestamp",
    "year", "month", "day", "hour", "day_of_week", "day_name",
    "user", "userid", "is_anon", "is_bot",
    "size_bytes", "size_change", "size_change_abs", "is_minor",
    "comment", "comment_length", "has_comment", "tags",
]

USER_FEATURES = [
    "user_total_edits", "user_pages_edited", "user_avg_edit_size",
    "user_minor_edit_count", "user_minor_edit_ratio",
]
PAGE_FEATURES = [
    "page_total_edits", "page_unique_editors", "page_avg_edit_size",
    "page_additions", "page_deletions", "page_controversy_score",
]
TEMPORAL_FEATURES = ["is_weekend", "is_business_hours", "is_late_night", "hour_category"]
EDIT_FEATURES = [
    "is_major_edit", "is_deletion", "is_addition", "edit_magnitude", "has_long_comment",
]
SEQUENCE_FEATURES = [
    "user_edit_sequence", "time_since_last_edit_sec", "user_is_rapid_editor",
    "page_edit_sequence", "is_revert_candidate",
]
DERIVED_FEATURES = ["edit_efficiency", "user_specialization", "page_edit_density"]

ALL_FEATURES = (
    USER_FEATURES + PAGE_FEATURES + TEMPORAL_FEATURES
    + EDIT_FEATURES + SEQUENCE_FEATURES + DERIVED_FEATURES
)

# Model input columns.
BOT_INPUTS = [
    "user_total_edits", "user_pages_edited", "user_minor_edit_ratio",
    "size_change_abs", "comment_length", "is_minor",
    "time_since_last_edit_sec", "user_edit_sequence",
]
EDIT_TYPE_INPUTS = [
    "user_total_edits", "page_total_edits", "is_minor", "comment_length",
    "is_bot", "is_anon", "hour", "is_weekend",
]
CLUSTER_INPUTS = [
    "total_edits", "pages_edited", "avg_edit_size", "minor_edits", "avg_comment_len",
]
GOLD_INPUTS = ["total_edits", "avg_edit_size"]
