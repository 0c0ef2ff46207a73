"""Splitting hot keys must not change any result."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from editpulse.functions.scalars import epoch_seconds
from editpulse.operators import clean as C
from editpulse.operators import features as FE
from editpulse.operators.keysplit import SEGMENT, split_hot_keys
from editpulse.plans import edits as E
from conftest import plan_of


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 6,000 edits on one page and a third by one user, in bursts;
    some rows have no time."""
    n = F.col("id")
    mix = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    burst = F.when(mix % 4 == 0, mix % 60).otherwise(mix)
    rows = spark.range(6000).select(
        n.alias("revid"),
        F.when(mix % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (mix % 400).cast("string"))).alias("page_title"),
        F.when(mix % 3 == 1, "robot").otherwise(F.concat(F.lit("u"), (mix % 300).cast("string"))).alias("user"),
        F.when(mix % 97 != 0, F.timestamp_seconds(burst)).alias("timestamp"),
        F.when(mix % 13 != 0, mix % 5000).alias("size_bytes"),
        F.when(mix % 5 == 0, 1).otherwise(0).alias("is_minor"),
        F.lit(0).alias("is_bot"), F.lit(0).alias("is_anon"), F.lit("words").alias("comment"))
    return C.comment_columns(C.time_columns(rows)).cache()


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("limit", [60, 1500])
def test_split_equals_plain(skewed, limit):
    plain = C.size_change(skewed, keep_prev=True, max_rows=None)
    assert same(plain, C.size_change(skewed, keep_prev=True, max_rows=limit))
    silver = C.size_change(skewed, max_rows=None)
    assert same(FE.features(silver, max_rows=None), FE.features(silver, max_rows=limit))


@pytest.mark.parametrize("limit", [150, 1000, None])
def test_trailing_counts_equal_range_frames(skewed, limit):
    found = FE.trailing_edit_counts(skewed, max_rows=limit)
    sec = epoch_seconds("timestamp")
    for name, length in (("edits_last_hour", FE.HOUR), ("edits_last_7_days", FE.WEEK)):
        w = Window.partitionBy("user").orderBy(sec).rangeBetween(-length, 0)
        wrong = found.withColumn("_want", F.count("*").over(w)).filter(F.col(name) != F.col("_want"))
        assert wrong.count() == 0
    assert found.count() == skewed.count()
    silver = C.size_change(skewed, max_rows=None)
    inside = FE.features(silver, trailing=True, max_rows=limit).select("revid", *FE.TRAILING)
    assert same(inside, found.select("revid", *FE.TRAILING))


def test_a_hot_null_key_is_split_too(skewed):
    rows = C.size_change(skewed.withColumns({
        "page_title": F.when(F.col("page_title") != "hot", F.col("page_title")),
        "user": F.when(F.col("user") != "robot", F.col("user"))}), max_rows=None)
    split = split_hot_keys(rows, "user", 100)
    assert [r.user for r in split.hot.collect()] == [None]
    assert same(FE.features(rows, max_rows=None), FE.features(rows, max_rows=100))
    assert same(FE.trailing_edit_counts(rows, max_rows=None), FE.trailing_edit_counts(rows, max_rows=300))


TIMES = {
    "even": "timestamp_seconds(id * 1000)",
    "burst": "timestamp_seconds(if(id < 50, id * 10000000, id % 3000))",
    "one_second": "timestamp_seconds(7)",
    "no_time": "cast(null AS timestamp)",
}


@pytest.mark.parametrize("shape", TIMES)
def test_no_segment_passes_twice_the_limit(spark, shape):
    """However the times lie, segments are bounded and nothing changes."""
    limit = 500
    rows = spark.range(4_000).select(
        F.col("id").alias("revid"), F.lit("hot").alias("page_title"), F.lit("robot").alias("user"),
        F.expr(TIMES[shape]).alias("timestamp"), F.pmod(F.xxhash64("id"), F.lit(900)).alias("size_bytes"))
    placed = split_hot_keys(rows, "page_title", limit).place(rows, ["timestamp", "revid"])
    sizes = [r["count"] for r in placed.groupBy(SEGMENT).count().collect()]
    assert max(sizes) <= 2 * limit and sum(sizes) == 4_000
    assert same(C.size_change(rows, max_rows=None), C.size_change(rows, max_rows=limit))
    assert same(FE.user_sequence(rows, max_rows=None), FE.user_sequence(rows, max_rows=limit))
    assert same(FE.trailing_edit_counts(rows, max_rows=None), FE.trailing_edit_counts(rows, max_rows=limit))


def test_tied_positions_are_cut_by_contents(spark):
    rows = spark.range(4000).select(
        F.lit(1).cast("bigint").alias("revid"), F.lit("hot").alias("page_title"),
        F.lit(None).cast("timestamp").alias("timestamp"), F.col("id").alias("size_bytes"))
    split = split_hot_keys(rows, "page_title", 200)
    sizes = [r["count"] for r in split.place(rows, ["timestamp", "revid"]).groupBy(SEGMENT).count().collect()]
    assert max(sizes) <= 400
    # Ties may fall in any order, but each row is somebody's predecessor once.
    prev = C.size_change(rows, keep_prev=True, max_rows=200).select("prev_size")
    assert prev.filter("prev_size is null").count() == 1 and prev.distinct().count() == 4000


def test_ordinary_keys_get_an_ordinary_window(skewed):
    plan = plan_of(C.size_change(skewed, max_rows=1_000_000))
    assert "hashpartitioning(page_title" in plan and "_segment" not in plan
    hot = plan_of(C.size_change(skewed, max_rows=100))
    assert "hashpartitioning(page_title" in hot and "_segment" in hot
    assert "NestedLoop" not in hot and "Cartesian" not in hot


def test_hot_silver(spark, sf_dir):
    bronze = E.bronze(spark, sf_dir)
    assert same(C.silver(bronze, max_rows=None), C.silver(bronze, max_rows=5))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.one_of(st.none(), st.integers(0, 99))),
                min_size=1, max_size=60), st.integers(1, 9))
def test_any_small_table(spark, rows, limit):
    data = [(i, f"p{k}", t, s) for i, (k, t, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "revid bigint, page_title string, at bigint, size_bytes bigint")
    df = df.select("revid", "page_title", "size_bytes", F.timestamp_seconds("at").alias("timestamp"))
    found = {r.revid: r.size_change for r in C.size_change(df, max_rows=limit).collect()}
    last = {}
    want = {}
    for revid, page, _, size in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        before = last.get(page)
        want[revid] = None if size is None else size - (before or 0)
        last[page] = size
    assert found == want
