"""Stored layouts: equal rows, fewer files, fewer shuffles."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from editpulse.operators import features as FE
from editpulse.plans import edits as E
from editpulse.sources import layout as L


@pytest.fixture(scope="module")
def edits(spark):
    mix = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    return spark.range(4000).select(
        F.col("id").alias("revid"),
        F.when(mix % 3 == 0, "hot").when(mix % 50 != 1, F.concat(F.lit("p"), (mix % 40).cast("string"))).alias("page_title"),
        F.when(mix % 97 != 0, F.timestamp_seconds(1_700_000_000 + mix * 20)).alias("timestamp"))


@pytest.fixture(scope="module")
def clustered(edits, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "edits")
    L.write_clustered(edits, path, bits=3)
    return path


def ids(df):
    return sorted(r.revid for r in df.collect())


def files_read(df):
    """Files the scan opened, from its metrics after it ran."""
    node = df._jdf.queryExecution().executedPlan()
    node.executeCollect()
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numFiles").value()


READS = [dict(pages=["hot"]), dict(pages=["p7", "p9", "none"]), dict(since="2023-11-20", until="2024-01-01"),
         dict(pages=["hot"], since="2024-01-10 10:00:00"), dict(until="2000-01-01"), dict(pages=[]), {}]


@pytest.mark.parametrize("read", READS, ids=str)
def test_clustered_reads_equal_filters(spark, edits, clustered, read):
    want = edits
    if "pages" in read:
        want = want.filter(F.col("page_title").isin(read["pages"]))
    if "since" in read:
        want = want.filter(F.col("timestamp") >= F.lit(read["since"]).cast("timestamp"))
    if "until" in read:
        want = want.filter(F.col("timestamp") < F.lit(read["until"]).cast("timestamp"))
    assert ids(L.read_clustered(spark, clustered, **read)) == ids(want)


def test_clustered_reads_open_few_files(spark, clustered):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole = files_read(L.read_clustered(spark, clustered))
        page = files_read(L.read_clustered(spark, clustered, pages=["p7"]))
        week = files_read(L.read_clustered(spark, clustered, since="2023-12-01", until="2023-12-08"))
        both = files_read(L.read_clustered(spark, clustered, pages=["p7"], since="2023-12-01", until="2023-12-08"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert page <= whole / 4 and week <= whole / 3 and both <= whole / 16


def test_clustered_empty_table(spark, edits, tmp_path):
    path = str(tmp_path / "none")
    L.write_clustered(edits.filter("revid < 0"), path, bits=2)
    for read in READS:
        none = L.read_clustered(spark, path, **read)
        assert none.columns == edits.columns and ids(none) == []


def test_zones_interleave():
    assert len({L.interleaved(p, t, 3) for p in range(8) for t in range(8)}) == 64
    assert L.interleaved(0b101, 0b011, 3) == 0b100111


def test_bucketed_features_shuffle_once(spark, sf_dir, tmp_path):
    path, name = str(tmp_path / "by_user"), "layout_test_edits"
    rows = E.edits_with_change(spark, sf_dir)
    L.write_bucketed(rows, name, path, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = L.read_bucketed(spark, name, path)
        plan = plan_of(FE.features(table, trailing=True, max_rows=None))
        plain = plan_of(FE.features(spark.read.parquet(path), trailing=True, max_rows=None))
        assert "hashpartitioning(user" in plain
        # by page for the rows; what is left belongs to the page statistics
        assert plan.count("Exchange hashpartitioning") <= plain.count("Exchange hashpartitioning") - 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")
    L.register_bucketed(spark, name, path, buckets=4)
    try:
        found = FE.user_sequence(L.read_bucketed(spark, name, path), max_rows=None)
        want = FE.user_sequence(rows, max_rows=None)
        assert "Exchange" not in plan_of(found)
        assert found.exceptAll(want.select(found.columns)).count() == 0 and found.count() == want.count()
        assert "Bucketed: true" not in plan_of(L.read_bucketed(spark, name, path, max_rows=1))
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "ROWS_PER_BUCKET", 100)
    assert [L.buckets_for(spark.range(n)) for n in (0, 800, 801, 36_000)] == [8, 8, 9, 360]
