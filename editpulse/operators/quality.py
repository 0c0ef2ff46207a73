"""Audits of raw files and records, and the data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.functions.scalars import percent
from editpulse.operators.aggregates import n_rows
from editpulse.schemas import REQUIRED
from editpulse.session import stored
from editpulse.sources.arrays import array_records, heads, of_files

# Limits of the audit's recommendations.
MIN_VALID_RECORDS = 10_000
MIN_BOT_RECORDS = 500
COLLECTION_GOAL = 10_000_000


def null_report(df: DataFrame, columns: list[str] = REQUIRED) -> DataFrame:
    """One row per column: NULLs and their percentage, from a single scan."""
    counts = df.agg(n_rows().alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot("_n", columns, "column_name", "nulls").select(
        "column_name", "nulls", percent("nulls", "_n").alias("null_pct"))


def record_audit(records: DataFrame) -> DataFrame:
    """Totals over bronze records; content figures count valid records only."""
    valid = F.lit(True)
    for c in REQUIRED:
        valid = valid & F.col(c).isNotNull()
    marked = records.select(
        valid.alias("_ok"), F.when(valid, F.col("page_title")).alias("_page"),
        F.when(valid, F.col("user")).alias("_user"), "bot", "anon")
    return marked.agg(
        n_rows().alias("total_records"),
        F.count_if("_ok").alias("valid_records"),
        F.count_distinct("_page").alias("unique_pages"),
        F.count_distinct("_user").alias("unique_users"),
        F.count_if(F.col("_ok") & F.col("bot")).alias("bot_edits"),
        F.count_if(F.col("_ok") & F.col("anon")).alias("anon_edits"),
    ).withColumns({
        "bot_pct": percent("bot_edits", F.greatest("valid_records", F.lit(1)), 3),
        "anon_pct": percent("anon_edits", F.greatest("valid_records", F.lit(1)), 2),
    })


def audit_recommendations(audit: DataFrame, corrupt_files: int = 0) -> DataFrame:
    """Advice drawn from a record audit, one row per topic."""
    valid, bots = F.col("valid_records"), F.col("bot_edits")
    records = (F.when(valid == 0, "no_valid_records")
               .when(valid < MIN_VALID_RECORDS, "few_valid_records").otherwise("records_ok"))
    labels = (F.when(bots == 0, "no_bot_records")
              .when(bots < MIN_BOT_RECORDS, "few_bot_records").otherwise("bots_ok"))
    files = F.when(F.lit(corrupt_files) > 0, "corrupt_files_skipped").otherwise("files_ok")
    return audit.select(F.explode(F.array(
        F.struct(F.lit("records").alias("topic"), records.alias("advice")),
        F.struct(F.lit("bots").alias("topic"), labels.alias("advice")),
        F.struct(F.lit("files").alias("topic"), files.alias("advice")),
    )).alias("r")).select("r.*")


def _json_ok(text) -> Column:
    """Whether the text is exactly one JSON object or array.

    Parsers stop at the end of the first value, so the text is checked inside
    an array and inside an object: what follows the value breaks one of them.
    """
    t = F.trim(text)
    inside_array = F.json_array_length(F.concat(F.lit("["), t, F.lit("]"))) == 1
    inside_object = F.from_json(F.concat(F.lit('{"v":'), t, F.lit("}")), "v string").v.isNotNull()
    looks = t.startswith("{") | t.startswith("[")
    return F.coalesce(looks & inside_array & inside_object, F.lit(False))


def file_audit(spark: SparkSession, path: str, listed: DataFrame | None = None) -> DataFrame:
    """One row per file: array_file, ndjson, empty or corrupt.

    One scan tells where a file begins and whether it has lines. Files that begin with a
    bracket are cut into records wherever they are split (see ``sources.arrays``); the
    others, and those that are no arrays, are judged by their lines. Readers skip files
    of zero bytes; pass ``listed`` (column ``file``) to have them reported as empty.
    """
    found = stored(heads(spark, path), "file-heads")
    empty = found.filter("begin IS NULL AND pieces = 1").select("file", F.lit("empty").alias("format"))
    _, arrays = array_records(spark, path, bracketed(found), T.StructType().add("revid", "string"))
    arrays = stored(arrays.select("file", F.lit("array_file").alias("format")), "array-files")
    line = F.btrim(F.col("value"), F.lit(" \t\r\n"))
    rest = found.join(arrays, "file", "left_anti").join(empty, "file", "left_anti")
    by_line = of_files(
        spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")), [r.file for r in rest.filter(LINES).select("file").collect()]
    ).groupBy("file").agg(F.max(_json_ok(line)).alias("any"))
    out = rest.join(by_line, "file", "left").select("file", F.when(F.col("any"), "ndjson").otherwise("corrupt").alias("format"))
    out = out.unionByName(arrays).unionByName(empty)
    if listed is not None:
        out = listed.select("file").join(out, "file", "left").fillna("empty", subset=["format"])
    return out


#: Files that may hold records by line: not those of many pieces on a single line
#: that begin with a bracket, whose one line is the whole array.
LINES = "begin IS NOT NULL AND (begin <> '[' OR lines OR pieces = 1)"


def bracketed(found: DataFrame) -> list[str]:
    """Names of the files that begin like an array of records."""
    return [r.file for r in found.filter("begin = '[' AND pieces > 1").select("file").collect()]


def file_format_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("format").agg(n_rows().alias("files"))


def collection_progress(records: DataFrame, goal: int = COLLECTION_GOAL,
                        file_col: str = "file") -> DataFrame:
    """Records and files so far against a goal."""
    return records.agg(
        n_rows().alias("records"), F.count_distinct(file_col).alias("files")
    ).select(
        "records", "files", F.lit(goal).cast("bigint").alias("goal"),
        percent("records", F.lit(goal)).alias("done_pct"),
        F.greatest(F.lit(0), F.lit(goal) - F.col("records")).cast("bigint").alias("remaining"))
