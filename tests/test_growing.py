"""The compacted update store, late rows, sketches and monthly partials."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from editpulse.operators import aggregates as A
from editpulse.operators import kpis as K
from editpulse.operators import partials as P
from editpulse.sources import deliveries as D
from editpulse.sources import tables as TB
from editpulse.streaming import compaction as CO
from editpulse.streaming import events as SE
from editpulse.streaming import late as LT
from editpulse.streaming import sinks as SK
from test_streaming import event, replay, write

KEYS = ["window", "page_title", "user"]


def rows_of(df):
    return sorted((str(r.window.start), r.page_title, r.user, r.edits) for r in df.collect())


def run(spark, tmp_path, number, *events):
    write(tmp_path / "in", number, *events)
    return SK.run_available(SK.update_writer(SE.editor_counts(replay(spark, tmp_path / "in")), str(tmp_path / "rows"), str(tmp_path / "cp")))


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def test_compaction_keeps_the_newest_versions(spark, tmp_path, monkeypatch):
    rows, store = str(tmp_path / "rows"), str(tmp_path / "store")
    shape = SE.editor_counts(SE.parse_events(spark.createDataFrame([], "value string"))).schema
    read = lambda: CO.compacted_updates(spark, rows, store, shape, keys=KEYS)
    query = run(spark, tmp_path, 1, event("A", "x", "2024-01-01T00:00:10Z"), event("A", "x", "2024-01-01T00:31:00Z"))
    before = rows_of(SK.latest_updates(spark, rows, KEYS))
    assert rows_of(read()) == before  # nothing folded yet
    assert CO.compact_updates(spark, rows, store, shape, CO.watermark_of(query), keys=KEYS) == 1  # 00:21 is past the first window
    query = run(spark, tmp_path, 2, event("A", "x", "2024-01-01T00:32:00Z"), event("B", "y", "2024-01-01T02:00:00Z"))
    with monkeypatch.context() as m:  # the step before the commit is the last to be lost
        m.setattr(D, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            CO.compact_updates(spark, rows, store, shape, at("2024-01-01 01:50:00"), keys=KEYS)
    whole = [("2024-01-01 00:00:00", "A", "x", 1), ("2024-01-01 00:30:00", "A", "x", 2), ("2024-01-01 02:00:00", "B", "y", 1)]
    assert rows_of(read()) == whole
    assert CO.compact_updates(spark, rows, store, shape, at("2024-01-01 01:50:00"), keys=KEYS) == 1
    assert rows_of(read()) == whole
    query = run(spark, tmp_path, 3, event("B", "y", "2024-01-01T02:01:00Z"), event("A", "late", "2024-01-01T00:00:20Z"))
    whole[2] = ("2024-01-01 02:00:00", "B", "y", 2)
    assert rows_of(read()) == whole
    assert "PartitionFilters: [isnotnull(batch_id" in plan_of(read())  # batches folded before are not read
    assert CO.compact_updates(spark, rows, store, shape, CO.watermark_of(query), keys=KEYS) == 0  # only the open window is left
    assert rows_of(read()) == whole


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    out = str(tmp_path / "out")
    for number, events in enumerate([
            [event("A", "x", "2024-01-01T02:00:10Z"), event("A", "early", "2024-01-01T00:00:10Z")],  # no watermark yet
            [event("B", "late", "2024-01-01T01:44:59Z"), event("B", "border", "2024-01-01T01:50:00Z"), event("B", "y", "2024-01-01T02:00:00Z"), "not json"],
            [event("C", "late too", "2024-01-01T00:00:00Z")]], 1):
        write(tmp_path / "in", number, *events)
        SK.run_available(LT.late_writer(replay(spark, tmp_path / "in"), out, str(tmp_path / "cp")))
        SK.run_available(SK.update_writer(SE.editor_counts(replay(spark, tmp_path / "in")), str(tmp_path / "rows"), str(tmp_path / "cp2")))
    late = sorted(str(r.user) for r in LT.late_rows(spark, out).collect())
    assert late == ["None", "late", "late too"]
    assert sorted(r.user for r in LT.late_rows(spark, out, late=False).collect()) == ["border", "early", "x", "y"]
    seen = LT.seen_batches(spark, out).agg(F.sum("n_rows"), F.sum("n_late"), F.count("*")).first()
    assert tuple(seen) == (7, 3, 3)
    # The aggregation drops the same rows, but for those without a time.
    kept = {r.user for r in SK.latest_updates(spark, str(tmp_path / "rows"), KEYS).filter("window IS NOT NULL").collect()}
    assert kept == {"border", "early", "x", "y"}


def test_sketches_merge(spark):
    """Editors who come back in later windows are counted once, within the error."""
    edits = spark.range(30_000).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 86_400).alias("timestamp"), F.lit("A").alias("page_title"),
        F.concat(F.lit("u"), F.col("id") % 7_000).alias("user"))
    five = SE.page_sketches(edits)
    day = SE.sketch_estimates(SE.merged_sketches(SE.merged_sketches(five, "1 hour"), "1 day")).first()
    assert day.edit_count == 30_000 and abs(day.approx_editors - 7_000) <= 3 * 1.04 / 64 * 7_000
    assert sum(r.approx_editors for r in SE.sketch_estimates(five).collect()) > 20_000
    marked = spark.createDataFrame([(100, 100), (104, 100), (106, 100), (0, 0)], "e long, n long").select(SE.within_error(F.col("e"), F.col("n")).alias("ok"))
    assert [r.ok for r in marked.collect()] == [True, True, False, True]


def test_sketches_hold_their_error_in_every_window(spark):
    """Over many windows the farthest estimate keeps half of the stated bound."""
    day = F.col("id") % 40
    edits = spark.range(480_000).select(
        F.timestamp_seconds(1_704_067_200 + day * 86_400 + (F.col("id") / 40).cast("bigint") % 2 * 3600).alias("timestamp"), F.lit("A").alias("page_title"),
        F.concat(F.lit("user_"), "id").alias("user"))
    days = SE.sketch_estimates(SE.merged_sketches(SE.page_sketches(edits, window="1 hour"), "1 day")).collect()
    assert len(days) == 40 and all(r.edit_count == 12_000 for r in days)
    assert max(abs(r.approx_editors - 12_000) for r in days) <= 1.5 * 1.04 / 64 * 12_000


def test_partials_of_months_give_the_whole(spark, tmp_path):
    rows = [("P" if i % 3 else None, f"u{i % 4}", i, f"2024-0{1 + i % 3}-0{1 + i % 9} 00:00:00", None if i % 5 == 0 else 10 * i, None if i % 7 == 0 else i - 20, i % 2, i % 3 == 0, 0) for i in range(40)]
    edits = spark.createDataFrame(rows, "page_title string, user string, revid bigint, time string, size_bytes bigint, size_change bigint, is_bot int, anon boolean, is_minor int").select(
        "*", F.to_timestamp("time").alias("timestamp"), F.col("anon").cast("int").alias("is_anon"), F.abs("size_change").alias("size_change_abs"),
        F.lit(4).alias("comment_length"), F.year("time").alias("year"), F.month("time").alias("month"))
    path = str(tmp_path / "partials")
    for month in (1, 2, 3, 2):  # a month again replaces itself
        TB.write_by_month(P.monthly_partials(edits.filter(F.col("month") == month)), path, increment=True)
    partials = spark.read.parquet(path)
    for merged, whole in ((P.merged_user_stats(partials), A.user_stats(edits)), (P.merged_page_stats(partials), A.page_stats(edits)),
                          (P.merged_dataset_kpis(partials), K.dataset_kpis(edits)), (P.merged_summary(partials), A.silver_summary(edits).crossJoin(A.date_range(edits)))):
        names = sorted(whole.columns)
        assert sorted(merged.columns) == names
        assert sorted(map(str, merged.select(names).collect())) == sorted(map(str, whole.select(names).collect()))
    assert "PartitionFilters: [isnotnull(month" in plan_of(P.merged_summary(partials.filter("month = 2")))
