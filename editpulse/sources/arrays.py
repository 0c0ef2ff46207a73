"""JSON arrays of records, cut at record boundaries in any split of a file.

A file is read as pieces that end with a closing brace, so a piece is never longer
than a record, and the splits of one file are read by many tasks. Where a record
ends is decided by the state in front of each piece: whether it lies inside a
string, and how deep. Both are sums (of quotes, and of brackets outside strings, for
either state at the start), so they are added up within each split and carried
from split to split by one small row per split. A record ends with a brace that leads
back to depth one. Records within a split are put together there; the two pieces of
a record that a split cuts are joined by themselves.

A file is an array if it reads ``[ record , record … ]`` and nothing else, every record
being one JSON object; as that is checked on the texts themselves, a file with a broken
string or bracket cannot pass, however its braces were counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editpulse.session import stored

_BLANK = " \t\r\n"
_ESCAPE = r"(?s)\\."
_QUOTED = r'"[^"]*("|$)'
_UP_TO_QUOTE = r'^[^"]*("|$)'
#: Files named one by one in a filter; more are joined.
FILES_IN_FILTER = 1000


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of the matching files, each without the brace that ends it (the last
    of a file may have none): value, file, size, start of its split, order."""
    return spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))


def of_files(rows: DataFrame, files: list[str], column: str = "file") -> DataFrame:
    """Rows of the named files; a short list reaches the listing, so that other
    files are not opened."""
    if len(files) <= FILES_IN_FILTER:
        return rows.filter(F.col(column).isin(files)) if files else rows.limit(0)
    return rows.join(rows.sparkSession.createDataFrame([(f,) for f in files], f"{column} string"), column, "left_semi")


def heads(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, from one scan: its first character that is not blank
    (NULL if there is none), its number of pieces, and whether a line ends between
    its first and last such character."""
    value = F.col("value")
    left, right = F.ltrim(value, F.lit(_BLANK)), F.rtrim(value, F.lit(_BLANK))
    marked = pieces(spark, path).select(
        "file", F.struct("start", "at").alias("place"), value.contains("\n").alias("nl"),
        F.struct(F.substring(left, 1, 1).alias("begin"), left.contains("\n").alias("nl_after"), F.btrim(value, F.lit(_BLANK)).contains("\n").alias("nl_within")).alias("as_first"),
        right.contains("\n").alias("nl_before"))
    found = marked.groupBy("file").agg(
        F.count("*").alias("pieces"), F.count_if("nl").alias("n"),
        F.min_by(F.struct("nl", "as_first"), "place").alias("first"), F.max_by(F.struct("nl", "nl_before"), "place").alias("last"))
    many = F.col("pieces") > 1
    between = F.col("n") - F.col("first.nl").cast("int") - F.col("last.nl").cast("int") > 0
    first = F.col("first.as_first")
    return found.select(
        "file", "pieces", F.nullif(first.begin, F.lit("")).alias("begin"),
        F.when(many, between | first.nl_after | F.col("last.nl_before")).otherwise(first.nl_within).alias("lines"))


def _depth(text: Column) -> Column:
    """Opening less closing brackets."""
    return F.length(F.translate(text, "}]", "")) - F.length(F.translate(text, "{[", ""))


def _measured(rows: DataFrame) -> DataFrame:
    """Pieces with their quotes, and their change of depth if they start outside a
    string (``outside``) or within one (``inside``); the closing brace is not counted."""
    bare = F.regexp_replace("value", _ESCAPE, "")
    quotes = F.length(bare) - F.length(F.translate(bare, '"', ""))
    inside = F.regexp_replace(F.regexp_replace(bare, _UP_TO_QUOTE, ""), _QUOTED, "")
    return rows.select("*", quotes.alias("quotes"), _depth(F.regexp_replace(bare, _QUOTED, "")).alias("outside"), _depth(inside).alias("inside"))


def _changes(starts_inside: Column, quotes_before: Column) -> Column:
    """Depth added by a piece and its brace, given the state at the start of its split."""
    within = (F.when(starts_inside, 1).otherwise(0) + quotes_before) % 2 == 1
    ends_within = within != (F.col("quotes") % 2 == 1)
    return F.when(within, F.col("inside")).otherwise(F.col("outside")) - F.when(ends_within | F.col("bare_end"), 0).otherwise(1)


def _within_split(last: int):
    """A split's pieces in order, up to the one before (-1) or with (0) the current."""
    return Window.partitionBy("file", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, last)


def _carried(rows: DataFrame) -> DataFrame:
    """One row per split: the state (inside a string, depth) in front of it."""
    before = F.coalesce(F.sum("quotes").over(_within_split(-1)), F.lit(0))
    totals = rows.select("file", "start", "quotes", _changes(F.lit(False), before).alias("d0"), _changes(F.lit(True), before).alias("d1")).groupBy("file", "start").agg(
        F.sum("quotes").alias("quotes"), F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    known = totals.withColumn("within", within).withColumn("change", F.when(F.col("within"), F.col("d1")).otherwise(F.col("d0")))
    return known.select("file", "start", "within", F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("base"))


def elements(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """(file, text, closed) of everything between record ends in the named files:
    records with what stands before them, and one rest per file, not closed. A file
    whose last brace ends no record gives one row without a text."""
    base = stored(_measured(of_files(pieces(spark, path), files)), "array-pieces")
    sizes = base.groupBy("file", "size").agg(F.sum(F.octet_length("value") + 1).alias("read"), F.max(F.struct("start", "at")).alias("last"))
    # One byte short: the file's last piece has no brace.
    tails = sizes.filter("read = size + 1").select(F.col("last.at").alias("at"), F.lit(True).alias("tail"))
    rows = base.join(F.broadcast(tails) if len(files) <= FILES_IN_FILTER else tails, "at", "left").withColumn("bare_end", F.col("tail").isNotNull()).drop("tail")
    carried = stored(_carried(rows.drop("value", "size")), "array-splits")
    run = rows.drop("size").join(carried, ["file", "start"])
    before = F.coalesce(F.sum("quotes").over(_within_split(-1)), F.lit(0))
    run = run.withColumn("change", _changes(F.col("within"), before)).withColumn("depth", F.col("base") + F.sum("change").over(_within_split(0)))
    # A brace inside a string adds nothing, so it ends a record only if the piece changed the depth back to one.
    within = (F.when(F.col("within"), 1).otherwise(0) + before + F.col("quotes")) % 2 == 1
    run = run.withColumn("ends", (F.col("depth") == 1) & ~within & ~F.col("bare_end"))
    run = run.withColumn("record", F.coalesce(F.sum(F.col("ends").cast("int")).over(_within_split(-1)), F.lit(0)))
    text = F.concat("value", F.when(F.col("bare_end"), "").otherwise("}"))
    whole = run.groupBy("file", "start", "record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", text.alias("text")))), lambda p: p.text), "").alias("text"), F.max("ends").alias("closed"))
    fragment = ~F.col("closed") | (F.col("record") == 0)
    # Narrow: does the last brace of each file end a record?
    last = base.filter("start IS NOT NULL").join(tails, "at", "left_anti").groupBy("file").agg(F.max(F.struct("start", "at")).alias("last")).select(F.col("last.at").alias("at"))
    sound = run.select("file", "at", "ends").join(last, "at").filter("ends").select("file")
    found = stored(whole.join(sound, "file", "left_semi"), "array-records")
    order = Window.partitionBy("file").orderBy("start", "record").rowsBetween(Window.unboundedPreceding, -1)
    cut = found.filter(fragment).withColumn("chain", F.coalesce(F.sum(F.col("closed").cast("int")).over(order), F.lit(0)))
    joined = cut.groupBy("file", "chain").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record", "text"))), lambda p: p.text), "").alias("text"), F.max("closed").alias("closed"),
        F.min(F.struct("start", "record")).alias("place"))
    first = found.groupBy("file").agg(F.min(F.struct("start", "record")).alias("first"))
    every = found.filter(~fragment).select("file", F.struct("start", "record").alias("place"), "text", "closed").unionByName(joined.select("file", "place", "text", "closed"))
    return every.join(first, "file").select("file", "text", "closed", (F.col("place") == F.col("first")).alias("first"))


def array_records(spark: SparkSession, path: str, files: list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(file, r) of every record of those named files that are arrays, and the
    names of these files."""
    lead = F.when(F.col("first"), r"^[ \t\r\n]*\[[ \t\r\n]*(?=\{)").otherwise(r"^[ \t\r\n]*,[ \t\r\n]*(?=\{)")
    led = F.regexp_replace("text", lead, F.lit(""))
    rows = elements(spark, path, files).select(
        "file", "closed", F.when(F.col("closed"), led).alias("object"), (F.octet_length(led) < F.octet_length("text")).alias("led"),
        (~F.col("closed") & F.col("text").rlike(r"^[ \t\r\n]*\][ \t\r\n]*$")).alias("rest"))
    parsed = stored(rows.withColumn("r", F.from_json(F.concat(F.lit("["), "object", F.lit("]")), T.ArrayType(schema))).select(
        "file", "closed", "rest", (F.col("led") & F.coalesce(F.size("r") == 1, F.lit(False))).alias("ok"), F.get("r", F.lit(0)).alias("r")), "array-parsed")
    arrays = parsed.groupBy("file").agg(F.min(F.when(F.col("closed"), F.col("ok")).otherwise(F.col("rest"))).alias("ok"), F.count_if(~F.col("closed")).alias("rests")).filter(
        "ok AND rests = 1").select("file")
    return parsed.filter("closed").join(arrays, "file", "left_semi").select("file", "r"), arrays
