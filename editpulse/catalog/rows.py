"""Projections, filters, null handling, sampling and scalar functions."""

from pyspark.sql import functions as F

from editpulse.catalog.aggregates import changed, featured, plain
from editpulse.catalog.base import BRONZE, BUCKET, CHANGED, EDITS, FEATURES, SILVER, STAMP, rounded, with_
from editpulse.functions import scalars as S
from editpulse.operators import clean as C
from editpulse.operators import features as FE
from editpulse.operators import sampling as SA
from editpulse.plans import edits as E
from editpulse.session import apply_defaults


def raw(fn):
    return lambda spark, d: rounded(fn(E.bronze(spark, d)))


_BRONZE_OUT = """page_title, page_id, page_watchers, revid, parentid, stamp AS "timestamp", usr AS "user",
  userid, anon, size, comment, minor, bot, tags, cast(NULL AS varchar) AS collected_at"""

_SILVER_OUT = f"""page_title, page_id, page_watchers, revid, parentid, {STAMP} AS "timestamp", year, month, day, hour,
  day_of_week, day_name, usr AS "user", userid, is_anon, is_bot, size_bytes, size_change, size_change_abs,
  is_minor, comment, comment_length, has_comment, tags"""


def sized(df):
    """Sizes with gaps: unknown for anonymous edits, plus a text gap."""
    known = F.col("is_anon") == 0
    return df.select("revid", F.when(known, F.col("size_bytes")).alias("size_bytes"),
                     F.when(known, F.col("size_bytes") / 4).alias("quarter"),
                     F.when(known, F.col("day_name")).alias("day_name"))


_SIZED = EDITS + """, sized AS (
  SELECT revid, CASE WHEN is_anon = 0 THEN size_bytes END AS size_bytes,
         CASE WHEN is_anon = 0 THEN size_bytes / 4.0::double END AS quarter,
         CASE WHEN is_anon = 0 THEN day_name END AS day_name FROM edits)"""


def train_test(df):
    train, test = SA.split_train_test(df.select("revid"))
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")))


def positives_and_negatives(df):
    pos, neg = df.filter("is_bot = 1"), df.filter("is_bot = 0")
    return pos.unionByName(neg).select("revid", "is_bot")


def session_settings(spark, d):
    apply_defaults(spark)
    rows = E.edits(spark, d)
    return rows.agg(F.count(F.lit(1)).alias("edits"),
                    F.max(F.current_timezone()).alias("time_zone"))


def time_parsing(df):
    ts = S.parse_timestamp("timestamp")
    return df.select("revid", "comment", ts.alias("parsed"))


def casts(df):
    """Text that is not always a number."""
    text = F.when(F.col("is_anon") == 1, "n/a").otherwise(F.col("size_bytes").cast("string"))
    return df.select("revid", S.try_cast(text, "bigint").alias("as_long"),
                     S.try_cast(text, "int").alias("as_int"),
                     F.col("revid").cast("string").alias("as_text"),
                     (F.col("is_bot") == 1).cast("int").alias("as_flag"))


QUERIES = {
    "require_not_null": (
        raw(lambda df: C.require_not_null(df).select("revid", "page_title", "user", "timestamp")),
        with_(BRONZE, """SELECT revid, page_title, usr AS "user", stamp AS "timestamp" FROM bronze
        WHERE page_title IS NOT NULL AND revid IS NOT NULL AND usr IS NOT NULL AND stamp IS NOT NULL""")),
    "dedup_revisions": (raw(C.dedup_revisions), with_(BRONZE, f"""
        SELECT {_BRONZE_OUT} FROM (
          SELECT *, row_number() OVER (PARTITION BY revid ORDER BY stamp NULLS LAST, page_title, usr) AS rn
          FROM bronze) WHERE rn = 1""")),
    "silver_projection": (raw(C.silver), with_(SILVER, f"SELECT {_SILVER_OUT} FROM silver")),
    "bool_flags": (raw(lambda df: C.bool_flags(df).groupBy("minor", "is_minor", "is_bot", "is_anon")
                       .agg(F.count(F.lit(1)).alias("n"))), with_(BRONZE, """
        SELECT minor, CASE WHEN minor THEN 1 ELSE 0 END AS is_minor, CASE WHEN bot THEN 1 ELSE 0 END AS is_bot,
               CASE WHEN anon THEN 1 ELSE 0 END AS is_anon, count(*) AS n FROM bronze GROUP BY ALL""")),
    "has_comment": (plain(lambda df: df.select("revid", "comment_length", "has_comment")), with_(CHANGED, """
        SELECT revid, comment_length, has_comment FROM changed""")),
    "eq_filter": (plain(lambda df: df.filter("is_bot = 1").select("revid", "user", "timestamp")), with_(
        EDITS, f'SELECT revid, usr AS "user", {STAMP} AS "timestamp" FROM edits WHERE is_bot = 1')),
    "fill_nulls": (plain(lambda df: sized(df).fillna(0)), with_(_SIZED, """
        SELECT revid, coalesce(size_bytes, 0) AS size_bytes, round(coalesce(quarter, 0), 6) AS quarter, day_name
        FROM sized""")),
    "fill_string": (plain(lambda df: sized(df).fillna("unknown", subset=["day_name"])), with_(_SIZED, """
        SELECT revid, size_bytes, round(quarter, 6) AS quarter, coalesce(day_name, 'unknown') AS day_name
        FROM sized""")),
    "drop_any_null": (plain(lambda df: sized(df).dropna()), with_(_SIZED, """
        SELECT revid, size_bytes, round(quarter, 6) AS quarter, day_name FROM sized
        WHERE size_bytes IS NOT NULL""")),
    "column_subset": (plain(lambda df: df.select("revid", "is_minor", "hour", "is_anon")), with_(
        EDITS, "SELECT revid, is_minor, hour, is_anon FROM edits")),
    "random_sample": (plain(lambda df: SA.random_sample(df).select("revid", "page_title")), with_(
        EDITS, f"SELECT revid, page_title FROM edits WHERE {BUCKET} < 10")),
    "split_train_test": (plain(train_test), with_(EDITS, f"""
        SELECT revid, CASE WHEN {BUCKET} < 80 THEN 'train' ELSE 'test' END AS split FROM edits""")),
    "stratified_split": (
        plain(lambda df: SA.stratified_split(df.select("revid", "is_bot"), "is_bot")
              .select("revid", "is_bot", "split")),
        with_(EDITS, """
        SELECT revid, is_bot, CASE WHEN
          row_number() OVER (PARTITION BY is_bot ORDER BY md5(cast(revid AS varchar)), revid)
            <= ceil(count(*) OVER (PARTITION BY is_bot) * 0.8::double) THEN 'train' ELSE 'test' END AS split
        FROM edits""")),
    "balanced_eval_sample": (
        plain(lambda df: SA.balanced_sample(df.select("revid", "is_bot"), "is_bot", 1000)
              .select("revid", "is_bot")),
        with_(EDITS, """
        SELECT revid, is_bot FROM (SELECT revid, is_bot,
          row_number() OVER (PARTITION BY is_bot ORDER BY md5(cast(revid AS varchar)), revid) AS rn FROM edits)
        WHERE rn <= 1000""")),
    "class_weights": (
        plain(lambda df: SA.class_weights(df, "is_bot").select("revid", "is_bot", "weight")),
        with_(EDITS, """
        SELECT revid, is_bot, round(CASE WHEN is_bot = 1 THEN
          (SELECT count(*) FILTER (is_bot = 0) / greatest(count(*) FILTER (is_bot = 1), 1)::double FROM edits)
          ELSE 1.0 END, 6) AS weight FROM edits""")),
    "conditional_columns": (
        lambda spark, d: E.edits(spark, d).select(
            *[c for c in ("revid", "user", "is_revert_candidate") if c in E.edits(spark, d).columns]),
        with_(EDITS, 'SELECT revid, usr AS "user" FROM edits')),
    "unpack_struct": (
        plain(lambda df: df.select(F.struct("revid", "hour", "day_name").alias("data")).select("data.*")),
        with_(EDITS, "SELECT revid, hour, day_name FROM edits")),
    "union_all": (plain(positives_and_negatives), with_(EDITS, "SELECT revid, is_bot FROM edits")),
    "limit_n": (plain(lambda df: df.orderBy("timestamp", "revid").limit(5).select("revid", "page_title")),
                with_(EDITS, "SELECT revid, page_title FROM edits ORDER BY ts, revid LIMIT 5")),
    "parse_timestamp": (raw(time_parsing), with_(BRONZE, f"""
        SELECT revid, comment, {STAMP} AS parsed FROM bronze""")),
    "time_parts": (plain(lambda df: df.select("revid", *S.time_parts())), with_(EDITS, """
        SELECT revid, year, month, day, hour, day_of_week FROM edits""")),
    "day_name": (plain(lambda df: df.select("revid", S.day_name().alias("day_name"))), with_(
        EDITS, "SELECT revid, day_name FROM edits")),
    "iso_day": (plain(lambda df: df.select("revid", S.iso_day().alias("day"))), with_(
        EDITS, "SELECT revid, strftime(ts, '%Y-%m-%d') AS day FROM edits")),
    "epoch_seconds": (plain(lambda df: df.select("revid", S.epoch_seconds().alias("sec"))), with_(
        EDITS, "SELECT revid, sec FROM edits")),
    "casts": (plain(casts), with_(EDITS, """
        SELECT revid, CASE WHEN is_anon = 0 THEN size_bytes END AS as_long,
               CASE WHEN is_anon = 0 THEN cast(size_bytes AS int) END AS as_int,
               cast(revid AS varchar) AS as_text, is_bot AS as_flag FROM edits""")),
    "text_length": (plain(lambda df: df.select("revid", S.text_length("comment").alias("n"))), with_(
        EDITS, "SELECT revid, cast(length(comment) AS int) AS n FROM edits")),
    "abs_coalesce_case": (
        changed(lambda df: df.select(
            "revid", F.abs(F.col("size_change") - 500).alias("off"),
            F.coalesce(F.when(F.col("size_change").between(0, 400), F.col("size_change")), F.lit(-1)).alias("part"),
            F.when(F.col("hour").isin(0, 12), "turn").when(F.col("hour") < 12, "am").otherwise("pm").alias("half"))),
        with_(CHANGED, """
        SELECT revid, abs(size_change - 500) AS "off",
               CASE WHEN size_change BETWEEN 0 AND 400 THEN size_change ELSE -1 END AS part,
               CASE WHEN hour IN (0, 12) THEN 'turn' WHEN hour < 12 THEN 'am' ELSE 'pm' END AS half FROM changed""")),
    "percent_of_total": (
        plain(lambda df: df.groupBy("hour").agg(
            S.percent(F.sum("is_bot"), F.count(F.lit(1))).alias("bot_pct"))),
        with_(EDITS, """SELECT hour, round(100.0::double * sum(is_bot) / count(*), 2) AS bot_pct
        FROM edits GROUP BY hour""")),
    "safe_round": (
        raw(lambda df: df.select("revid", "comment", S.safe_round(F.col("timestamp"), 2).alias("bad"),
                                 S.safe_round(F.col("size") / 7, 2).alias("good"))),
        with_(BRONZE, """SELECT revid, comment, cast(NULL AS double) AS bad,
        round(size / 7.0::double, 2) AS good FROM bronze""")),
    "session_defaults": (session_settings, with_(
        EDITS, "SELECT count(*) AS edits, 'UTC' AS time_zone FROM edits")),
}
