"""Audits and quality reports."""

from pyspark.sql import functions as F

from editpulse.catalog.base import BRONZE, SILVER, long_table, rounded, with_
from editpulse.catalog.rows import _BRONZE_OUT
from editpulse.operators import quality as Q
from editpulse.operators.clean import silver
from editpulse.plans import edits as E
from editpulse.plans.reports import quality_report
from editpulse.session import scratch_dir
from editpulse.sources.bronze import parse_records, read_bronze, read_lines


def raw(fn):
    return lambda spark, d: rounded(fn(E.bronze(spark, d)))


PER_FILE = 2_000


def stored_files(spark, d, *kinds):
    """Bronze as files of ``PER_FILE`` ids each, in one folder per kind: JSON
    lines, lines that are cut off, arrays over many lines, and blanks. One job makes
    the texts and writes the files of all kinds; read them by folder, as a listing by
    names of files costs a task for each."""
    path = scratch_dir(spark, "audit")
    records = E.json_records(E.bronze(spark, d), keep=("revid",))
    file = records.groupBy(F.floor(F.col("revid") / PER_FILE).alias("file")).agg(F.sort_array(F.collect_list("value")).alias("v"))
    text = {
        "lines": F.array_join("v", "\n"),
        "broken": F.array_join(F.transform("v", lambda x: F.substring(x, F.lit(1), F.length(x) - 1)), "\n"),
        "arrays": F.concat(F.lit("[\n"), F.array_join("v", ",\n"), F.lit("\n]")),
        "blank": F.lit(" \n\t"),
    }
    rows = file.select(F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), text[kind].alias("value")) for kind in kinds or text])))
    rows.write.partitionBy("kind").option("maxRecordsPerFile", 1).text(path)
    return path


def file_audit(spark, d):
    audit = Q.file_audit(spark, f"{stored_files(spark, d)}/kind=*")
    kind = F.regexp_extract("file", "/kind=([^/]*)/[^/]*$", 1)
    return audit.groupBy(kind.alias("folder"), "format").agg(F.count("*").alias("files"))


def mixed(spark, d):
    """Lines and arrays give all records, broken and blank files none."""
    return rounded(read_bronze(spark, f"{stored_files(spark, d)}/kind=*"))


def progress(spark, d):
    path = stored_files(spark, d, "lines")
    records = parse_records(read_lines(spark, f"{path}/kind=lines"), keep=("file",))
    return Q.collection_progress(records, 1_000_000)


def report(spark, d):
    """All six tables."""
    raw_rows = E.bronze(spark, d)
    return long_table(quality_report(raw_rows, silver(raw_rows)), {"nulls": "column_name", "top_pages": "page_title"})


_VALID = "page_title IS NOT NULL AND revid IS NOT NULL AND usr IS NOT NULL AND stamp IS NOT NULL"
_AUDIT = f"""SELECT count(*) AS total_records, count(*) FILTER ({_VALID}) AS valid_records,
  count(DISTINCT page_title) FILTER ({_VALID}) AS unique_pages, count(DISTINCT usr) FILTER ({_VALID}) AS unique_users,
  count(*) FILTER ({_VALID} AND bot) AS bot_edits, count(*) FILTER ({_VALID} AND anon) AS anon_edits,
  round(100.0::double * count(*) FILTER ({_VALID} AND bot) / count(*) FILTER ({_VALID}), 3) AS bot_pct,
  round(100.0::double * count(*) FILTER ({_VALID} AND anon) / count(*) FILTER ({_VALID}), 2) AS anon_pct
  FROM bronze"""

QUERIES = {
    "null_report": (raw(Q.null_report), with_(BRONZE, " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, "
        f"round(100.0::double * count(*) FILTER ({c} IS NULL) / count(*), 2) AS null_pct FROM bronze"
        for name, c in (("page_title", "page_title"), ("revid", "revid"), ("user", "usr"),
                        ("timestamp", "stamp"))))),
    "bronze_record_audit": (raw(Q.record_audit), with_(BRONZE, _AUDIT)),
    "audit_recommendations": (
        raw(lambda df: Q.audit_recommendations(Q.record_audit(df), 2)),
        with_(BRONZE + f", a AS ({_AUDIT})", """
        SELECT 'records' AS topic, CASE WHEN valid_records = 0 THEN 'no_valid_records'
          WHEN valid_records < 10000 THEN 'few_valid_records' ELSE 'records_ok' END AS advice FROM a
        UNION ALL SELECT 'bots', CASE WHEN bot_edits = 0 THEN 'no_bot_records'
          WHEN bot_edits < 500 THEN 'few_bot_records' ELSE 'bots_ok' END FROM a
        UNION ALL SELECT 'files', 'corrupt_files_skipped'""")),
    "bronze_file_audit": (file_audit, with_(BRONZE + f", n AS (SELECT count(DISTINCT revid // {PER_FILE}) AS files FROM bronze)", """
        SELECT 'lines' AS folder, 'ndjson' AS format, files FROM n UNION ALL SELECT 'broken', 'corrupt', files FROM n
        UNION ALL SELECT 'arrays', 'array_file', files FROM n UNION ALL SELECT 'blank', 'empty', files FROM n""")),
    "read_whole_json_array": (mixed, with_(BRONZE, f"""
        SELECT {_BRONZE_OUT} FROM bronze UNION ALL SELECT {_BRONZE_OUT} FROM bronze""")),
    "collection_progress": (progress, with_(BRONZE, f"""
        SELECT count(*) AS records, count(DISTINCT revid // {PER_FILE}) AS files, cast(1000000 AS bigint) AS goal,
               round(100.0::double * count(*) / 1000000, 2) AS done_pct,
               greatest(0, 1000000 - count(*)) AS remaining FROM bronze""")),
    "quality_report": (report, with_(SILVER + """, n AS (SELECT (SELECT count(*) FROM bronze) AS r, (SELECT count(*) FROM silver) AS s),
        tops AS (SELECT page_title, count(*) AS edits FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""", " UNION ALL ".join([
        f"SELECT 'nulls' AS part, '{name}' AS item, '{figure}' AS figure, round(cast({value} AS double), 6) AS value FROM (SELECT count(*) AS n, count(*) FILTER ({c} IS NULL) AS m FROM bronze)"
        for name, c in (("page_title", "page_title"), ("revid", "revid"), ("user", "usr"), ("timestamp", "stamp"))
        for figure, value in (("nulls", "m"), ("null_pct", "round(100.0::double * m / n, 2)"))] + [
        "SELECT 'duplicates', '', 'duplicate_rows', cast(count(*) - count(DISTINCT revid) AS double) FROM bronze"] + [
        f"SELECT 'retention', '', '{figure}', cast({value} AS double) FROM n"
        for figure, value in (("raw_count", "r"), ("final_count", "s"), ("removed", "r - s"), ("kept_pct", "round(100.0::double * s / r, 2)"))] + [
        f"SELECT 'summary', '', '{figure}', round(cast({value} AS double), 6) FROM silver"
        for figure, value in (("total_edits", "count(*)"), ("unique_pages", "count(DISTINCT page_title)"), ("unique_users", "count(DISTINCT usr)"), ("avg_edit_size", "avg(size_bytes)"),
                              ("avg_comment_len", "avg(comment_length)"), ("bot_edits", "sum(is_bot)"), ("anon_edits", "sum(is_anon)"), ("minor_edits", "sum(is_minor)"))] + [
        f"SELECT 'date_range', '', '{figure}', cast(epoch_us({value}) AS double) FROM silver" for figure, value in (("earliest_edit", "min(ts)"), ("latest_edit", "max(ts)"))] + [
        "SELECT 'top_pages', page_title, 'edits', cast(edits AS double) FROM tops"]))),
}
