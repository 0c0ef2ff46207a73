"""History extended by deliveries against one full build."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from editpulse.plans import history as H
from editpulse.sources import deliveries as D
from editpulse.sources import id_index as I


def revisions(spark, rows):
    return spark.createDataFrame(rows, "page_title string, user string, revid bigint, time string, size_bytes bigint").select(
        "page_title", "user", "revid", F.to_timestamp("time").alias("timestamp"), "size_bytes")


def same(a, b):
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    assert sorted(map(str, a.select(names).collect())) == sorted(map(str, b.select(names).collect()))


def random_rows(rng, n, first):
    return [(f"p{rng.randrange(4)}", f"u{rng.randrange(3)}", first + i, None if rng.random() < 0.05 else f"2024-01-{rng.randrange(1, 4):02d} 00:00:{rng.randrange(60):02d}",
             rng.choice([None, 5, 100, 2000])) for i in range(n)]


@pytest.mark.parametrize("max_rows", [None, 6])
def test_deliveries_in_any_order_equal_one_build(spark, tmp_path, max_rows):
    rng = random.Random(max_rows or 1)
    path, seen = str(tmp_path / "history"), []
    for i, n in enumerate((25, 10, 0)):
        rows = random_rows(rng, n, 100 * i) + rng.sample(seen, min(len(seen), 5))  # some ids again
        assert H.extend_history(spark, path, revisions(spark, rows), max_rows=max_rows, buckets=4) == i
        seen += rows
        same(H.history_features(spark, path), H.rebuilt(revisions(spark, seen), max_rows=None))


def test_only_late_keys_are_computed_again(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = [(f"p{i}", f"u{i % 5}", i, f"2024-01-01 00:{i:02d}:00", 10 * i) for i in range(40)]
    H.extend_history(spark, path, revisions(spark, rows))
    more = [("p1", "u1", 100, "2024-01-02 00:00:00", 7), ("p2", "u2", 101, "2024-01-01 00:00:30", 8)]
    H.extend_history(spark, path, revisions(spark, more))
    again = {s.name: {r[0] for r in D.read_parts(spark, path, f"{s.name}-again", f"{s.key} string, bucket int", [1]).collect()} for s in (H.PAGES, H.USERS)}
    assert again == {"pages": {"p2"}, "users": {"u2"}}
    written = D.read_parts(spark, path, "pages", H.PAGES.schema, [1])
    assert sorted((r.page_title, r.revid, r.page_edit_sequence, r.size_change) for r in written.collect()) == [("p1", 100, 2, -3), ("p2", 2, 2, 12), ("p2", 101, 1, 8)]
    same(H.history_features(spark, path), H.rebuilt(revisions(spark, rows + more)))
    carries = H._carries(spark, path, H.PAGES, revisions(spark, more).select("page_title"), [1, 2], [0, 1])
    assert "PartitionFilters: [bucket" in plan_of(carries) and "bucket#" in plan_of(carries)


def test_broken_delivery_changes_nothing(spark, tmp_path, monkeypatch):
    """A delivery that ends before its commit is not seen, and written again."""
    path = str(tmp_path / "history")
    a = [("p", "u", i, f"2024-01-01 00:00:0{i}", i) for i in range(5)]
    b = [("p", "u", 10 + i, f"2024-01-01 00:00:0{i}", i) for i in range(5)]
    H.extend_history(spark, path, revisions(spark, a))
    with monkeypatch.context() as m:
        m.setattr(D, "commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            H.extend_history(spark, path, revisions(spark, b))
    same(H.history_features(spark, path), H.rebuilt(revisions(spark, a)))
    H.extend_history(spark, path, revisions(spark, b))
    same(H.history_features(spark, path), H.rebuilt(revisions(spark, a + b)))
    assert D.committed(spark, path) == [0, 1] and D.committed(spark, str(tmp_path / "none")) == []


def test_id_index(spark, tmp_path):
    """Ids on both sides of bucket and folder borders, negative and far ones."""
    path = str(tmp_path / "index")
    stored = [0, 1, -1, 32768, 32769, -32768, 5 * I.FOLDER * 32768, 2**62, -(2**62), 7]
    ids = lambda values: spark.createDataFrame([(v, "x") for v in values], "revid bigint, page_title string")
    assert I.not_indexed(ids(stored), path).count() == len(stored)
    I.add_ids(ids(stored[:6] + [None]), path, 0)
    D.commit(spark, path, 0)
    I.add_ids(ids(stored[6:]), path, 1)
    assert sorted(r.revid for r in I.not_indexed(ids(stored), path).collect()) == sorted(stored[6:])  # not committed yet
    D.commit(spark, path, 1)
    asked = stored + [2, -2, 32767, 32770, 2**62 + 1, None, 2, 5 * I.FOLDER * 32768 + 1]
    found = I.not_indexed(ids(asked), path)
    assert sorted(map(str, (r.revid for r in found.collect()))) == sorted(map(str, {2, -2, 32767, 32770, 2**62 + 1, None, 5 * I.FOLDER * 32768 + 1}))
    assert found.columns == ["revid", "page_title"]
    near = I.stored_bits(spark, path, [0])
    assert near.count() == 3 and "PartitionFilters" in plan_of(near)
    files = lambda folders: [f for f in D.read_parts(spark, path, "ids", I._SCHEMA, [0, 1]).filter(F.col("folder").isin(folders)).select(F.input_file_name().alias("f")).distinct().collect()]
    assert len(files([0])) < len(files([0, -1, 5, 2**62 // 32768 // I.FOLDER]))
