"""Sources and sinks, over files the queries write from the given tables."""

from pyspark.sql import functions as F

from editpulse.catalog.aggregates import PROFILES, segments
from editpulse.catalog.base import DATASET_KPIS, BRONZE, CHANGED, EDITS, FEATURES, SILVER, rounded, with_
from editpulse.catalog.features import columns_sql
from editpulse.catalog.rows import _BRONZE_OUT, _SILVER_OUT
from editpulse.functions.scalars import months_between_filter
from editpulse.operators.aggregates import user_profiles
from editpulse.operators.clean import silver
from editpulse.operators.joins import join_cluster_labels
from editpulse.operators.kpis import dataset_kpis
from editpulse.plans import edits as E
from editpulse.schemas import ALL_FEATURES, SILVER_COLUMNS
from editpulse.session import scratch_dir
from editpulse.sources import bronze as B
from editpulse.sources import payloads as P
from editpulse.sources import tables as TB


def lines(spark, d):
    path = scratch_dir(spark, "lines")
    B.write_batches(E.bronze(spark, d), path)
    return fields(B.read_lines(spark, f"{path}/part-*"))


def fields(text):
    """Id and comment of each JSON line, without the record parser."""
    return text.select(F.get_json_object("value", "$.revid").cast("bigint").alias("revid"),
                       F.get_json_object("value", "$.comment").alias("comment"))


def parsed(spark, d):
    """Records through JSON text, once as objects and once inside arrays."""
    text = E.json_records(E.bronze(spark, d))
    arrays = text.select(F.concat(F.lit("["), "value", F.lit("]")).alias("value"))
    cut = text.select(F.expr("substring(value, 1, length(value) - 1)").alias("value"))
    rows = B.parse_records(text.unionByName(arrays).unionByName(cut))
    return rounded(rows)


def wrong_types(spark, d):
    """A field of the wrong type becomes NULL; its record stays."""
    text = E.json_records(E.bronze(spark, d)).select(
        F.regexp_replace("value", '"size":[0-9]+,"comment":"again"', '"size":"n/a","comment":"again"').alias("value"))
    return B.parse_records(text).select("revid", "comment", "size")


def batches(spark, d):
    path = scratch_dir(spark, "batches")
    B.write_batches(E.bronze(spark, d), path, batch_size=3_000)
    rows = B.parse_records(B.read_lines(spark, f"{path}/part-*"), keep=("file",))
    per_file = rows.groupBy("file").agg((F.count("*") <= 3_000).alias("bounded"))
    return rows.join(per_file, "file").select("revid", "comment", "size", "bounded")


def api(spark, d):
    """Page payloads as the history API nests them, one per revision, and a
    payload for a page that does not exist for each missing title."""
    b = E.bronze(spark, d)
    mark = lambda c: F.when(F.col(c), "")  # noqa: E731 - flags count by presence
    revision = F.struct(
        "revid", "timestamp", "user", "userid", "size", "comment",
        mark("anon").alias("anon"), mark("minor").alias("minor"), mark("bot").alias("bot"), "tags")
    page = F.struct(F.col("page_title").alias("title"), F.col("page_watchers").alias("watchers"),
                    F.array(revision).alias("revisions"))
    key = F.when(F.col("page_title").isNull(), "-1").otherwise(F.col("page_id"))
    payload = F.struct(F.struct(F.create_map(key, page).alias("pages")).alias("query"))
    return rounded(P.parse_api_responses(b.select(F.to_json(payload.alias("v")).alias("value"))))


def xml(spark, d):
    """Edits as a dump of two-revision pages, read back."""
    path = scratch_dir(spark, "dump")
    who = F.when(F.col("is_anon") == 1, F.format_string("<ip>%s</ip>", "user")).otherwise(
        F.format_string("<username>%s</username><id>%d</id>", "user", F.col("revid")))
    minor = F.when(F.col("is_minor") == 1, "<minor/>").otherwise("")
    text = F.format_string(
        "<page><title>%s</title><id>%d</id>\n<revision><id>%d</id><timestamp>%s</timestamp>"
        "<contributor>%s</contributor>%s<comment>%s</comment><text bytes=\"%d\">%s</text></revision>\n"
        "<revision><id>%d</id><parentid>%d</parentid><timestamp>%s</timestamp>"
        "<contributor>%s</contributor><text/></revision></page>",
        "page_title", "hour", "revid", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        who, minor, "comment", "size_bytes", F.concat(F.lit(" \n"), F.repeat(F.lit("x"), F.col("hour")), F.lit("\n\t ")),
        -F.col("revid") - 1, "revid", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"), who)
    E.edits(spark, d).select(text.alias("value")).write.text(path)
    return rounded(P.read_xml_dump(spark, f"{path}/part-*"))


def manifest(spark, d):
    pages = E.table(spark, d, "pages")
    name = F.concat(F.md5("url"), F.lit("-p"), F.col("page_id").cast("string"))
    kind = F.when(F.length("html") % 3 == 0, ".xml.bz2").when(F.length("html") % 3 == 1, ".sql.gz").otherwise("")
    text = F.when(kind == "", F.md5("html")).otherwise(F.concat(F.md5("html"), F.lit("  "), name, kind))
    return P.parse_manifest(pages.select(text.alias("value")))


def stored_silver(spark, d):
    path = scratch_dir(spark, "silver")
    TB.write_silver(silver(E.bronze(spark, d)), path)
    return path


def silver_table(spark, d):
    rows = TB.read_table(spark, stored_silver(spark, d))
    return rounded(rows.select(SILVER_COLUMNS))


def silver_month(spark, d):
    """Partition pruning: only one month's folder is read."""
    rows = TB.read_table(spark, stored_silver(spark, d))
    return rows.filter(months_between_filter((2024, 1), (2024, 1))).groupBy("day").agg(
        F.count("*").alias("edits"), F.sum("size_bytes").alias("size_bytes"))


def kpi_files(spark, d):
    path = scratch_dir(spark, "kpis")
    table = dataset_kpis(E.edits(spark, d))
    TB.write_kpis({"dataset": table}, path)
    return spark.read.schema(table.schema).json(f"{path}/dataset")


def feature_table(spark, d):
    path = scratch_dir(spark, "features")
    TB.write_features(E.edit_features(spark, d), path)
    return path


def features_back(spark, d):
    rows = TB.read_table(spark, feature_table(spark, d))
    return rounded(rows.select("revid", "year", "month", *ALL_FEATURES))


def features_by_month(spark, d):
    """Folder pruning and two columns out of fifty."""
    rows = TB.read_table(spark, feature_table(spark, d))
    return rows.filter("year = 2024 and month = 1").groupBy("edit_magnitude", "is_bot").agg(
        F.count("*").alias("edits"))


def gold_table(spark, d):
    """Edits with a given user segment, one folder per segment, read back."""
    path = scratch_dir(spark, "gold")
    changed = E.edits_with_change(spark, d)
    TB.write_gold(join_cluster_labels(
        changed.select("revid", "user", "hour"), segments(user_profiles(changed))), path)
    return TB.read_table(spark, path).select("revid", "user", "hour", F.col("prediction").cast("int"))


def view(spark, d):
    name = TB.register_edits(E.edits(spark, d))
    return spark.sql(f"""SELECT user, max(is_bot) AS is_bot, count(*) AS edits, count(DISTINCT page_title) AS pages
                         FROM {name} GROUP BY user""")


QUERIES = {
    "write_features": (features_back, with_(FEATURES, f"""
        SELECT revid, year, month, {columns_sql(ALL_FEATURES)} FROM features""")),
    "read_features": (features_by_month, with_(FEATURES, """
        SELECT edit_magnitude, is_bot, count(*) AS edits FROM features
        WHERE year = 2024 AND month = 1 GROUP BY edit_magnitude, is_bot""")),
    "write_gold": (gold_table, with_(PROFILES, """
        SELECT revid, usr AS "user", hour, prediction FROM changed JOIN clustered USING (usr)""")),
    "edits_view": (view, with_(CHANGED, """
        SELECT usr AS "user", max(is_bot) AS is_bot, count(*) AS edits, count(DISTINCT page_title) AS pages
        FROM changed GROUP BY usr""")),
    "bronze_lines": (lines, with_(BRONZE, "SELECT revid, comment FROM bronze")),
    "parse_bronze_json": (parsed, with_(BRONZE, f"""
        SELECT {_BRONZE_OUT} FROM bronze UNION ALL SELECT {_BRONZE_OUT} FROM bronze""")),
    "bronze_schema": (wrong_types, with_(BRONZE, """
        SELECT revid, comment, CASE WHEN comment <> 'again' THEN size END AS size FROM bronze""")),
    "write_bronze_batches": (batches, with_(BRONZE, "SELECT revid, comment, size, true AS bounded FROM bronze")),
    "parse_api_response": (api, with_(BRONZE, """
        SELECT page_title, page_id, page_watchers, revid, parentid, stamp AS "timestamp",
               coalesce(usr, 'Unknown') AS "user", userid, anon, size, comment, coalesce(minor, false) AS minor,
               bot, tags, cast(NULL AS varchar) AS collected_at FROM bronze WHERE page_title IS NOT NULL""")),
    "read_xml_dump": (xml, with_(EDITS, """
        SELECT page_title, cast(hour AS varchar) AS page_id, 0 AS page_watchers, revid, cast(0 AS bigint) AS parentid,
               strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", usr AS "user",
               CASE WHEN is_anon = 1 THEN 0 ELSE revid END AS userid, is_anon = 1 AS anon,
               cast(hour + 5 AS bigint) AS size, rtrim(comment) AS comment, is_minor = 1 AS minor, false AS bot,
               '' AS tags, cast(NULL AS varchar) AS collected_at FROM edits
        UNION ALL
        SELECT page_title, cast(hour AS varchar), 0, -revid - 1, revid, strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), usr,
               CASE WHEN is_anon = 1 THEN 0 ELSE revid END, is_anon = 1, 0, '', false, false, '', NULL FROM edits""")),
    "parse_dump_manifest": (manifest, """
        SELECT md5(url) || '-p' || page_id || '.xml.bz2' AS relative_path FROM pages WHERE length(html) % 3 = 0"""),
    "write_silver": (silver_table, with_(SILVER, f"SELECT {_SILVER_OUT} FROM silver")),
    "read_silver": (silver_month, with_(SILVER, """
        SELECT day, count(*) AS edits, cast(sum(size_bytes) AS bigint) AS size_bytes FROM silver
        WHERE year = 2024 AND month = 1 GROUP BY day""")),
    "write_kpis": (kpi_files, with_(EDITS, DATASET_KPIS)),
}
