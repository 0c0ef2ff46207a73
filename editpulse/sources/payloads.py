"""Nested API payloads, XML history dumps and dump manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editpulse.schemas import API_RESPONSE, BRONZE, XML_PAGE, XML_REVISION


def parse_api_responses(responses: DataFrame, *, value_col: str = "value",
                        collected_at: str | None = None) -> DataFrame:
    """Revisions inside page payloads; the missing page ``-1`` is skipped and
    flags count by presence."""
    pages = (
        responses.select(F.from_json(value_col, API_RESPONSE).alias("_r"))
        .select(F.explode("_r.query.pages").alias("page_id", "_page"))
        .filter("page_id != '-1'")
    )
    rev = F.col("_rev")
    return pages.select("page_id", "_page", F.explode("_page.revisions").alias("_rev")).select(
        F.col("_page.title").alias("page_title"), "page_id",
        F.coalesce("_page.watchers", F.lit(0)).alias("page_watchers"),
        rev.revid.alias("revid"),
        F.coalesce(rev.parentid, F.lit(0)).alias("parentid"),
        rev.timestamp.alias("timestamp"),
        F.coalesce(rev.user, F.lit("Unknown")).alias("user"),
        F.coalesce(rev.userid, F.lit(0)).alias("userid"),
        rev.anon.isNotNull().alias("anon"),
        F.coalesce(rev["size"], F.lit(0)).alias("size"),
        F.coalesce(rev.comment, F.lit("")).alias("comment"),
        rev.minor.isNotNull().alias("minor"),
        rev.bot.isNotNull().alias("bot"),
        F.coalesce(rev.tags, F.array().cast("array<string>")).alias("tags"),
        F.lit(collected_at).cast("string").alias("collected_at"),
    ).to(BRONZE)


def _strip(text):
    """Without white space of any kind at both ends."""
    return F.trim(text, F.lit(" \t\n\r\x0b\x0c"))


def _with_page(chunks: DataFrame) -> DataFrame:
    """Give every revision chunk the page it belongs to.

    Only the first revision of a page follows the page's header, so headers are
    carried forward in file order: inside each input split by a window, and
    from split to split through one small row per split.
    """
    split = ["_file", "_start"]
    opens = F.contains("value", F.lit("<page>"))
    header = F.when(opens, F.concat(
        F.lit("<page>"),
        F.substring_index(F.substring_index("value", "<revision>", 1), "<page>", -1),
        F.lit("</page>")))
    # One pass over the headers; revisions are not parsed for it.
    ends = chunks.select(*split, "_at", header.alias("_header")).groupBy(*split).agg(
        F.max_by("_header", F.when(F.col("_header").isNotNull(), F.col("_at"))).alias("_header"))
    earlier = (Window.partitionBy("_file").orderBy("_start")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = ends.select(*split, F.from_xml(
        F.last("_header", ignorenulls=True).over(earlier), XML_PAGE).alias("_inherited"))
    revision = F.concat(F.lit("<revision>"), F.substring_index("value", "<revision>", -1),
                        F.lit("</revision>"))
    rows = chunks.filter(F.contains("value", F.lit("<revision>"))).select(
        *split, "_at", F.from_xml(header, XML_PAGE).alias("_page"),
        F.from_xml(revision, XML_REVISION, {"ignoreSurroundingSpaces": "false"}).alias("_rev"),
        # The parser gives nothing for a text of white space only.
        F.length(F.regexp_extract(revision, r"<text[^>]*>(\s*)</text>", 1)).alias("_blank"))
    rev = F.col("_rev")
    # Texts are replaced by their lengths before anything is shuffled.
    narrow = rows.select(
        *split, "_at", "_page", rev.dropFields("text").alias("_rev"),
        F.coalesce(F.length(rev.text["_VALUE"]), "_blank").alias("_chars"), rev.text["_bytes"].alias("_bytes"))
    carried = F.last("_page", ignorenulls=True).over(
        Window.partitionBy(*split).orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return narrow.join(starts, split, "left").withColumn(
        "_page", F.coalesce(carried, F.col("_inherited")))


def read_xml_dump(spark: SparkSession, path: str, *, byte_size: bool = False) -> DataFrame:
    """Revisions of XML history dumps, plain or bz2, as bronze records.

    The files are read in chunks that end with a revision, so one row is one
    revision however long a page's history is, and large files are split.
    ``size`` is the number of characters of the text; ``byte_size`` prefers the
    byte count stated in the dump. An unreadable revision id becomes NULL.
    """
    chunks = spark.read.option("lineSep", "</revision>").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"))
    page, rev = F.col("_page"), F.col("_rev")
    who = rev.contributor
    size = F.coalesce("_bytes", "_chars") if byte_size else F.col("_chars")
    name = _strip(F.coalesce(who.username, who.ip))
    return _with_page(chunks).select(
        _strip(page.title).alias("page_title"),
        F.coalesce(_strip(page.id).try_cast("bigint"), F.lit(0)).cast("string").alias("page_id"),
        F.lit(0).alias("page_watchers"),
        _strip(rev.id).try_cast("bigint").alias("revid"),
        F.coalesce(_strip(rev.parentid).try_cast("bigint"), F.lit(0)).alias("parentid"),
        F.coalesce(_strip(rev.timestamp), F.lit("")).alias("timestamp"),
        F.when(name != "", name).otherwise("Unknown").alias("user"),
        F.coalesce(_strip(who.id).try_cast("bigint"), F.lit(0)).alias("userid"),
        who.ip.isNotNull().alias("anon"),
        F.coalesce(size, F.lit(0)).cast("bigint").alias("size"),
        F.coalesce(_strip(rev.comment), F.lit("")).alias("comment"),
        rev.minor.isNotNull().alias("minor"),
        F.lit(False).alias("bot"),
        F.array().cast("array<string>").alias("tags"),
        F.lit(None).cast("string").alias("collected_at"),
    ).to(BRONZE)


def parse_manifest(lines: DataFrame, *, value_col: str = "value",
                   suffix: str = ".xml.bz2") -> DataFrame:
    """Dump files named in a checksum list: last token of lines that have at
    least two, with the wanted suffix."""
    tokens = F.split(_strip(value_col), r"\s+")
    return (
        lines.filter(F.size(tokens) >= 2)
        .select(F.element_at(tokens, -1).alias("relative_path"))
        .filter(F.col("relative_path").endswith(suffix))
    )
