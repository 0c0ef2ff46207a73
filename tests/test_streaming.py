"""Streams against their batch twins."""

import json
import os

import pytest
from pyspark.sql import functions as F

from editpulse.streaming import events as SE
from editpulse.streaming import sinks as SK


def event(page, user, time, size=10):
    return json.dumps({"page_title": page, "user": user, "timestamp": time, "size": size,
                       "minor": True, "bot": False})


def write(folder, number, *events):
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.json"
    path.write_text("\n".join(events) + "\n")
    # The file source takes files by age; files of one instant have no order.
    os.utime(path, (1_700_000_000 + number * 10,) * 2)


def replay(spark, folder):
    return SE.parse_events(SE.replay_source(spark, str(folder), 1))


def flat(df):
    return sorted((str(r.window.start), r.page_title, r.edit_count, r.unique_editors)
                  for r in df.collect())


@pytest.fixture
def files(tmp_path):
    d = tmp_path / "in"
    write(d, 1, event("A", "x", "2024-01-01T00:00:10Z"), event("A", "x", "2024-01-01T00:01:00Z", 900),
          event("A", "y", "2024-01-01T00:04:59Z"), event("B", None, "2024-01-01T00:05:00Z"))
    write(d, 2, event("A", "y", "2024-01-01T00:03:00Z"), event("A", "z", "2024-01-01T00:06:00Z"))
    write(d, 3, "not json", event("B", "q", "2024-01-01T00:30:00Z"))
    return d


def test_update_mode_equals_batch(spark, tmp_path, files):
    SK.run_available(SK.update_writer(
        SE.editor_counts(replay(spark, files)), str(tmp_path / "out"), str(tmp_path / "cp")))
    streamed = SK.current_page_counts(spark, str(tmp_path / "out"))
    batch = SE.page_counts(SE.parse_events(spark.read.text(str(files))))
    assert flat(streamed.filter("window is not null")) == flat(batch.filter("window is not null"))
    assert ("2024-01-01 00:00:00", "A", 4, 2) in flat(streamed)
    assert ("2024-01-01 00:05:00", "B", 1, 0) in flat(streamed)
    alerts = SE.edit_war_alerts(streamed)
    assert [r.page_title for r in alerts.collect()] == ["A"]


def test_append_mode_emits_closed_windows_once(spark, tmp_path, files):
    SK.run_available(SK.append_writer(
        SE.page_counts(replay(spark, files)), str(tmp_path / "out"), str(tmp_path / "cp")))
    out = flat(spark.read.parquet(str(tmp_path / "out")))
    assert out == [("2024-01-01 00:00:00", "A", 4, 2), ("2024-01-01 00:05:00", "A", 1, 1),
                   ("2024-01-01 00:05:00", "B", 1, 0)]


def test_late_event_is_dropped(spark, tmp_path):
    d = tmp_path / "in"
    for i, time in enumerate(["00:00", "02:00", "02:30", "00:01", "03:00"]):
        write(d, i, event("A", f"u{i}", f"2024-01-01T{time}:00Z"))
    SK.run_available(SK.update_writer(
        SE.editor_counts(replay(spark, d)), str(tmp_path / "out"), str(tmp_path / "cp")))
    users = {r.user for r in SK.latest_updates(
        spark, str(tmp_path / "out"), ["window", "page_title", "user"]).collect()}
    assert users == {"u0", "u1", "u2", "u4"}


def test_restart_continues_where_it_stopped(spark, tmp_path, files):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    SK.run_available(SK.update_writer(SE.editor_counts(replay(spark, files)), out, cp))
    write(files, 4, event("A", "n", "2024-01-01T00:31:00Z"))
    SK.run_available(SK.update_writer(SE.editor_counts(replay(spark, files)), out, cp))
    counts = flat(SK.current_page_counts(spark, out).filter("window is not null"))
    assert ("2024-01-01 00:30:00", "A", 1, 1) in counts and ("2024-01-01 00:00:00", "A", 4, 2) in counts


def test_bounded_run_stops(spark, tmp_path, files):
    query = SK.run_bounded(SK.update_writer(
        SE.editor_counts(replay(spark, files)), str(tmp_path / "o"), str(tmp_path / "c")), 6)
    assert not query.isActive


def test_replay_batches_do_not_grow_with_the_files(spark, tmp_path):
    for files, batches in ((6, 3), (30, 5)):
        path = str(tmp_path / f"in{files}")
        spark.range(files).select(F.col("id").cast("string").alias("value")).repartitionByRange(files, "value").write.text(path)
        query = SK.run_available(SK.append_writer(SE.replay_source(spark, path, 2, max_batches=5), f"{path}-out", f"{path}-cp"))
        assert len([p for p in query.recentProgress if p["numInputRows"]]) == batches
        assert spark.read.parquet(f"{path}-out").count() == files


def test_flags_and_sketch(spark, files):
    events = SE.parse_events(spark.read.text(str(files)))
    row = events.filter(F.col("user") == "z").first()
    assert (row.is_minor, row.is_bot) == (1, 0) and dict(events.dtypes)["timestamp"] == "timestamp"
    sketch = SE.page_counts_approx(events.filter("page_title is not null"))
    assert {(r.page_title, r.edit_count, r.approx_editors) for r in sketch.collect()} >= {("A", 4, 2)}


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        SE.kafka_source(spark, "localhost:9", "edits")
