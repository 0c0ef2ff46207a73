"""The benchmark's ``events`` table as edits, in bronze and silver form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.scalars import flag
from editpulse.operators.clean import comment_columns, size_change, time_columns
from editpulse.operators.features import features, user_features
from editpulse.operators.keysplit import has_hot_keys
from editpulse.schemas import BRONZE
from editpulse.session import apply_defaults, stored

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _page_number() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _page() -> Column:
    return F.concat(F.lit("page_"), F.lpad(_page_number().cast("string"), 2, "0"))


def _user() -> Column:
    return F.concat(F.lit("user_"), F.col("user_id").cast("string"))


def _size() -> Column:
    return F.floor(F.col("value") * 20).cast("bigint")


def _comment() -> Column:
    words = F.repeat(F.concat("event_type", F.lit(" ")), F.lit(1) + _page_number() % 10)
    return F.when(F.col("event_type") == "signup", "").otherwise(words)


def _bot() -> Column:
    return F.col("user_id") % 7 == 0


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits with typed columns and flags, before any ordered computation."""
    return edits_of(table(spark, sf_dir, "events"))


def edits_of(events: DataFrame) -> DataFrame:
    """The same for a given events table or stream."""
    kind = F.col("event_type")
    rows = events.select(
        F.col("event_id").alias("revid"),
        _page().alias("page_title"), _user().alias("user"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        _size().alias("size_bytes"),
        flag(kind == "view").alias("is_minor"), flag(kind == "error").alias("is_anon"),
        flag(_bot()).alias("is_bot"), _comment().alias("comment"))
    return comment_columns(time_columns(rows))


def edits_with_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits with their size changes; stored where hot pages make the ordered
    pass expensive to repeat."""
    rows = edits(spark, sf_dir)
    if has_hot_keys(rows, "page_title"):
        return stored(size_change(rows), "changed")
    return size_change(rows, max_rows=None)


def edit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features. They look at their input several times, so it is stored
    first, as the silver table is in the pipeline."""
    return features(stored(edits_with_change(spark, sf_dir), "edits"))


def bot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bot model reads. None of it comes from the page's features, so only the
    columns of the user step are stored, and rows are not joined or ordered by page again."""
    rows = edits_with_change(spark, sf_dir).select(
        "revid", "user", "page_title", "timestamp", "is_bot", "is_minor", "comment_length", "size_change_abs")
    return user_features(stored(rows, "edits"))


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored features, for work that reads them again and again."""
    return stored(edit_features(spark, sf_dir), "features")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records, with what raw data has: clicks were collected twice (the
    second time an hour late), some purchases lack a user and some sign-ups a
    page, and one kind of event carries no readable time."""
    events = table(spark, sf_dir, "events")
    kind, k = F.col("event_type"), _page_number()
    first = events.select("*", F.col("ts").alias("at"), F.lit(0).alias("copy"))
    again = events.filter(kind == "click").select(
        "*", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at"), F.lit(1).alias("copy"))
    no_user = (kind == "purchase") & (k < 10)
    no_page = (kind == "signup") & (k >= 95)
    bad_time = (kind == "error") & (k == 50)
    return first.unionByName(again).select(
        F.when(~no_page, _page()).alias("page_title"),
        k.cast("string").alias("page_id"), (k * 3).alias("page_watchers"),
        F.col("event_id").alias("revid"), F.lit(0).cast("bigint").alias("parentid"),
        F.when(bad_time, "not a time").otherwise(F.date_format("at", ISO)).alias("timestamp"),
        F.when(~no_user, _user()).alias("user"), F.col("user_id").alias("userid"),
        (kind == "error").alias("anon"), _size().alias("size"),
        F.when(F.col("copy") == 1, "again").otherwise(_comment()).alias("comment"),
        F.when(kind != "signup", kind == "view").alias("minor"), _bot().alias("bot"),
        F.array(kind).alias("tags"), F.lit(None).cast("string").alias("collected_at"),
    ).to(BRONZE)


def json_records(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each record as one JSON line, next to the ``keep`` columns."""
    return records.select(F.to_json(F.struct("*")).alias("value"), *keep)
