"""Structured Streaming runs over the given tables, against their batch twins."""

from pyspark.sql import functions as F

from editpulse.catalog.base import BRONZE, EDITS, STAMP, rounded, with_
from editpulse.catalog.sources import fields
from editpulse.plans import edits as E
from editpulse.session import scratch_dir
from editpulse.sources.bronze import write_batches
from editpulse.streaming import compaction as CO
from editpulse.streaming import events as SE
from editpulse.streaming import late as LT
from editpulse.streaming import sinks as SK


def live_edits(spark, d):
    """The events table as a stream of edits."""
    schema = E.table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    return E.edits_of(stream).withColumnRenamed("size_bytes", "size")


def flat(counts):
    return counts.select(
        F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        *[c for c in counts.columns if c != "window"])


def batch_counts(spark, d):
    edits = E.edits(spark, d).withColumnRenamed("size_bytes", "size")
    return flat(SE.page_counts(edits)).select("window_start", "page_title", "edit_count", "unique_editors")


def update_counts(spark, d):
    """Update mode: changed (window, page, user) rows are stored per batch and
    rolled up on read."""
    path = scratch_dir(spark, "updates")
    SK.run_available(SK.update_writer(
        SE.editor_counts(live_edits(spark, d)), f"{path}/rows", f"{path}/checkpoint"))
    return flat(SK.current_page_counts(spark, f"{path}/rows"))


PARTS = 4


def arriving(spark, d):
    """The events in the order of their times, in PARTS deliveries; the errors of the
    first part come last, long after the watermark has passed their windows."""
    events = E.table(spark, d, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    part = F.least(F.lit(PARTS - 1), F.floor((at - low) * PARTS / F.lit(max((high or 0) - (low or 0), 1)))).cast("int")
    late = (part == 0) & (F.col("event_type") == "error")
    dealt = events.withColumn("part", F.when(late, PARTS).otherwise(part))
    return [dealt.filter(F.col("part") == i).drop("part") for i in range(PARTS + 1)]


def delivered(spark, d, label, writer):
    """One run of the stream per delivery, each going on from the checkpoint of the
    run before; returns the folder of the rows."""
    path = scratch_dir(spark, label)
    schema = E.table(spark, d, "events").schema
    for i, part in enumerate(arriving(spark, d)):
        part.write.parquet(f"{path}/in/part={i}")
        stream = spark.readStream.schema(schema).parquet(f"{path}/in/part=*")
        edits = E.edits_of(stream).withColumnRenamed("size_bytes", "size")
        SK.run_available(writer(edits, f"{path}/rows", f"{path}/checkpoint"))
    return f"{path}/rows"


def resumed_updates(spark, d):
    rows = delivered(spark, d, "resumed", lambda edits, *at: SK.update_writer(SE.editor_counts(edits), *at))
    return flat(SK.current_page_counts(spark, rows))


def resumed_append(spark, d):
    rows = delivered(spark, d, "resumed", lambda edits, *at: SK.append_writer(SE.page_counts(edits), *at))
    return flat(spark.read.parquet(rows))


def append_counts(spark, d):
    """Append mode: windows the watermark has closed, each exactly once."""
    path = scratch_dir(spark, "appended")
    SK.run_available(SK.append_writer(
        SE.page_counts(live_edits(spark, d)), f"{path}/rows", f"{path}/checkpoint"))
    return flat(spark.read.parquet(f"{path}/rows"))


def alerts(spark, d):
    """Half-day windows, since the edits are sparse."""
    path = scratch_dir(spark, "alerts")
    SK.run_available(SK.update_writer(
        SE.editor_counts(live_edits(spark, d), window="12 hours"), f"{path}/rows", f"{path}/checkpoint"))
    return flat(SE.edit_war_alerts(SK.current_page_counts(spark, f"{path}/rows")))


#: Micro-batches of a replay, however large the table is.
REPLAY_BATCHES = 20


def replayed(spark, d):
    """Stored bronze files replayed as JSON events and parsed on the stream."""
    path = scratch_dir(spark, "replay")
    write_batches(E.bronze(spark, d), f"{path}/files", batch_size=5_000)
    events = SE.parse_events(SE.replay_source(spark, f"{path}/files", 2, max_batches=REPLAY_BATCHES))
    SK.run_available(SK.append_writer(events, f"{path}/rows", f"{path}/checkpoint"))
    return rounded(spark.read.parquet(f"{path}/rows"))


def replay_total(spark, d):
    """Stored files fed into a stream, two per micro-batch, or more where there are many."""
    path = scratch_dir(spark, "replay")
    write_batches(E.bronze(spark, d), f"{path}/files", batch_size=5_000)
    SK.run_available(SK.append_writer(
        SE.replay_source(spark, f"{path}/files", 2, max_batches=REPLAY_BATCHES), f"{path}/rows", f"{path}/checkpoint"))
    return fields(spark.read.parquet(f"{path}/rows"))


def unpacked(spark, d):
    """JSON text to a struct to columns."""
    events = E.table(spark, d, "events")
    return events.select("event_id", F.from_json("props", "k int").alias("data")).select("event_id", "data.*")


def unique_editors(spark, d):
    """Exact distinct editors per hour and page, without sets."""
    edits = E.edits(spark, d).withColumnRenamed("size_bytes", "size")
    return flat(SE.page_counts(edits, window="1 hour")).select("window_start", "page_title", "unique_editors")


def sketched(spark, d):
    """Sketches of five-minute windows from a stream, rolled up to hours and then
    days; the estimates beside exact counts of the same windows."""
    path = scratch_dir(spark, "sketches")
    SK.run_available(SK.append_writer(SE.page_sketches(live_edits(spark, d)), f"{path}/rows", f"{path}/checkpoint"))
    closed = spark.read.parquet(f"{path}/rows")
    days = SE.sketch_estimates(SE.merged_sketches(SE.merged_sketches(closed, "1 hour"), "1 day"))
    edits = E.edits(spark, d).withColumn("five", F.window("timestamp", "5 minutes")).join(
        closed.select(F.col("window").alias("five"), "page_title"), ["five", "page_title"], "left_semi")
    exact = edits.groupBy(F.window("timestamp", "1 day").alias("window"), "page_title").agg(F.count_distinct("user").alias("unique_editors"))
    both = days.join(exact, ["window", "page_title"], "full")
    right = SE.within_error(F.col("approx_editors"), F.col("unique_editors"))
    return flat(both.withColumn("within_error", F.coalesce(right, F.lit(False))).drop("approx_editors"))


def approximate(spark, d):
    """One-step counts for update mode: the estimate within its stated error."""
    edits = E.edits(spark, d)
    approx = SE.page_counts_approx(edits, window="1 day", rsd=0.02)
    exact = edits.groupBy(F.window("timestamp", "1 day").alias("window"), "page_title").agg(F.count_distinct("user").alias("unique_editors"))
    near = F.abs(F.col("approx_editors") - F.col("unique_editors")) <= F.ceil(3 * 0.02 * F.col("unique_editors"))
    return flat(approx.join(exact, ["window", "page_title"], "full").withColumn("within_error", F.coalesce(near, F.lit(False))).drop("approx_editors"))


def compacted(spark, d):
    """The update store folded after each of five deliveries, the last one late."""
    path = scratch_dir(spark, "compacted")
    schema, keys = E.table(spark, d, "events").schema, ["window", "page_title", "user"]
    shape = SE.editor_counts(E.edits(spark, d).withColumnRenamed("size_bytes", "size")).schema
    for i, part in enumerate(arriving(spark, d)):
        part.write.parquet(f"{path}/in/part={i}")
        edits = E.edits_of(spark.readStream.schema(schema).parquet(f"{path}/in/part=*")).withColumnRenamed("size_bytes", "size")
        query = SK.run_available(SK.update_writer(SE.editor_counts(edits), f"{path}/rows", f"{path}/checkpoint"))
        CO.compact_updates(spark, f"{path}/rows", f"{path}/store", shape, CO.watermark_of(query), keys=keys)
    return flat(SE.roll_up(CO.compacted_updates(spark, f"{path}/rows", f"{path}/store", shape, keys=keys)))


def late_kept(spark, d):
    """Every row of five deliveries, marked late or not, and the counts observed."""
    path = scratch_dir(spark, "late")
    schema = E.table(spark, d, "events").schema
    for i, part in enumerate(arriving(spark, d)):
        part.write.parquet(f"{path}/in/part={i}")
        edits = E.edits_of(spark.readStream.schema(schema).parquet(f"{path}/in/part=*"))
        SK.run_available(LT.late_writer(edits, f"{path}/out", f"{path}/checkpoint"))
    rows = LT.late_rows(spark, f"{path}/out").select("revid", F.lit(1).alias("is_late")).unionByName(
        LT.late_rows(spark, f"{path}/out", late=False).select("revid", F.lit(0).alias("is_late")))
    seen = LT.seen_batches(spark, f"{path}/out").agg(F.sum("n_rows").alias("counted"), F.sum("n_late").alias("counted_late"))
    return rows.crossJoin(F.broadcast(seen))


def bounded(spark, d):
    """A run that ends by itself after a time, and one that goes on from there."""
    path = scratch_dir(spark, "bounded")
    writer = lambda: SK.update_writer(SE.editor_counts(live_edits(spark, d)), f"{path}/rows", f"{path}/checkpoint")
    SK.run_bounded(writer(), 8)
    SK.run_available(writer())
    return flat(SK.current_page_counts(spark, f"{path}/rows"))


_WINDOWS = EDITS + """, windows AS (
  SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
         time_bucket(INTERVAL 5 MINUTE, ts) AS w, page_title, count(*) AS edit_count,
         count(DISTINCT usr) AS unique_editors, max(size_bytes) - min(size_bytes) AS size_swing
  FROM edits GROUP BY ALL)"""

_ON_TIME = EDITS + """, bounds AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events), on_time AS (
  SELECT edits.* FROM edits, bounds
  WHERE NOT (is_anon = 1 AND floor((epoch_us(ts) - low) * 4 / greatest(high - low, 1)::double) = 0)), windows AS (
  SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
         time_bucket(INTERVAL 5 MINUTE, ts) AS w, page_title, count(*) AS edit_count,
         count(DISTINCT usr) AS unique_editors, max(size_bytes) - min(size_bytes) AS size_swing
  FROM on_time GROUP BY ALL)"""

_COUNTS = "window_start, page_title, edit_count, unique_editors"

QUERIES = {
    "replay_source": (replay_total, with_(BRONZE, "SELECT revid, comment FROM bronze")),
    "json_to_struct": (unpacked, "SELECT event_id, cast(json_extract(props, '$.k') AS int) AS k FROM events"),
    "tumbling_unique_editors": (unique_editors, with_(EDITS, """
        SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, page_title,
               count(DISTINCT usr) AS unique_editors FROM edits GROUP BY ALL""")),
    "tumbling_page_counts": (batch_counts, with_(_WINDOWS, f"SELECT {_COUNTS} FROM windows")),
    "stream_sink": (update_counts, with_(_WINDOWS, f"SELECT {_COUNTS}, size_swing FROM windows")),
    "stream_append": (append_counts, with_(_WINDOWS, f"""SELECT {_COUNTS}, size_swing FROM windows
        WHERE w + INTERVAL 5 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE""")),
    "late_data": (resumed_updates, with_(_ON_TIME, f"SELECT {_COUNTS}, size_swing FROM windows")),
    "late_data_append": (resumed_append, with_(_ON_TIME, f"""SELECT {_COUNTS}, size_swing FROM windows
        WHERE w + INTERVAL 5 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) FROM on_time) - INTERVAL 10 MINUTE""")),
    "live_edit_war_alerts": (alerts, with_(EDITS, """
        SELECT strftime(time_bucket(INTERVAL 12 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, page_title,
               count(*) AS edit_count, count(DISTINCT usr) AS unique_editors,
               max(size_bytes) - min(size_bytes) AS size_swing
        FROM edits GROUP BY ALL
        HAVING count(*) >= 3 AND count(DISTINCT usr) >= 2 AND max(size_bytes) - min(size_bytes) >= 500""")),
    "parse_stream": (replayed, with_(BRONZE, f"""
        SELECT page_title, usr AS "user", {STAMP} AS "timestamp", size, minor, bot,
               CASE WHEN minor THEN 1 ELSE 0 END AS is_minor, CASE WHEN bot THEN 1 ELSE 0 END AS is_bot
        FROM bronze""")),
    "tumbling_counts_sketched": (sketched, with_(EDITS, """
        SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, page_title,
               count(*) AS edit_count, count(DISTINCT usr) AS unique_editors, true AS within_error
        FROM edits WHERE time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <=
          (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE
        GROUP BY ALL""")),
    "tumbling_counts_approx": (approximate, with_(EDITS, """
        SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, page_title,
               count(*) AS edit_count, count(DISTINCT usr) AS unique_editors, true AS within_error FROM edits GROUP BY ALL""")),
    "update_store_compaction": (compacted, with_(_ON_TIME, f"SELECT {_COUNTS}, size_swing FROM windows")),
    "late_rows_kept": (late_kept, with_(_ON_TIME, """
        SELECT revid, CASE WHEN revid IN (SELECT revid FROM on_time) THEN 0 ELSE 1 END AS is_late,
               (SELECT count(*) FROM edits) AS counted,
               (SELECT count(*) FROM edits) - (SELECT count(*) FROM on_time) AS counted_late FROM edits""")),
    "bounded_run": (bounded, with_(_WINDOWS, f"SELECT {_COUNTS}, size_swing FROM windows")),
}
