"""Hand-checked rows through cleaning and features."""

import pytest
from pyspark.sql import functions as F

from editpulse.operators import clean as C
from editpulse.operators import features as FE
from editpulse.operators.aggregates import duplicate_count, null_counts, page_stats, retention
from editpulse.schemas import ALL_FEATURES, SILVER_COLUMNS


@pytest.fixture(scope="module")
def silver(golden):
    return C.silver(golden).cache()


@pytest.fixture(scope="module")
def rows(silver):
    full = FE.trailing_edit_counts(FE.features(silver))
    return {r.revid: r for r in full.collect()}


def test_silver_shape(silver):
    assert silver.columns == SILVER_COLUMNS
    assert dict(silver.dtypes) == {
        "page_title": "string", "page_id": "string", "page_watchers": "int", "revid": "bigint",
        "parentid": "bigint", "timestamp": "timestamp", "year": "int", "month": "int",
        "day": "int", "hour": "int", "day_of_week": "int", "day_name": "string",
        "user": "string", "userid": "bigint", "is_anon": "int", "is_bot": "int",
        "size_bytes": "bigint", "size_change": "bigint", "size_change_abs": "bigint",
        "is_minor": "int", "comment": "string", "comment_length": "int", "has_comment": "int",
        "tags": "array<string>"}
    assert silver.count() == 7


# revid: change, abs, magnitude, gap, rapid, revert, user_seq, page_seq, weekday, efficiency, hour
EXPECTED = {
    1: (1000, 1000, "large", 0, 0, 0, 1, 1, 7, 200.0, 1),
    2: (-950, 950, "medium", 0, 0, 1, 1, 2, 7, 950.0, 1),
    3: (950, 950, "medium", 45, 1, 0, 2, 3, 7, 0.0, 2),
    4: (-700, 700, "medium", 219570, 0, 0, 2, 4, 2, 13.461538461538462, 1),
    5: (20, 20, "small", 20, 1, 0, 3, 1, 2, 4.0, 2),
    6: (None, None, "large", 221355, 0, 0, 3, 2, 2, 0.0, 1),
    7: (100, 100, "medium", 19800, 0, 0, 4, 3, 3, 50.0, 1),
}


@pytest.mark.parametrize("revid", sorted(EXPECTED))
def test_golden_features(rows, revid):
    r = rows[revid]
    found = (r.size_change, r.size_change_abs, r.edit_magnitude, r.time_since_last_edit_sec,
             r.user_is_rapid_editor, r.is_revert_candidate, r.user_edit_sequence,
             r.page_edit_sequence, r.day_of_week, r.edit_efficiency, r.edits_last_hour)
    assert found == EXPECTED[revid]


def test_page_stats(silver):
    found = {r.page_title: tuple(r)[1:] for r in page_stats(silver).collect()}
    assert found == {"A": (4, 2, 900.0, 2, 2, 0.008), "B": (3, 2, 60.0, 2, 0, 0.006)}


def test_features_have_no_nulls(silver):
    counts = null_counts(FE.features(silver), ALL_FEATURES).first()
    assert len(ALL_FEATURES) == 28
    assert set(counts) == {0}


def test_cleaning_reports(golden, silver):
    assert duplicate_count(golden).first().duplicate_rows == 1
    assert tuple(retention(golden, silver).first()) == (9, 7, 2, 77.78)


def test_dedup_is_idempotent_and_prefers_the_earliest(spark, golden):
    once = C.dedup_revisions(golden)
    twice = C.dedup_revisions(once.unionByName(golden))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    late = golden.filter("revid = 2").withColumn("timestamp", F.lit("2025-01-01T00:00:00Z"))
    kept = C.dedup_revisions(late.unionByName(golden)).filter("revid = 2").first()
    assert kept.timestamp.startswith("2024")


def test_bad_time_is_null_not_an_error(spark, golden):
    bad = golden.filter("revid = 2").withColumn("timestamp", F.lit("soon"))
    row = C.silver(bad).first()
    assert row.timestamp is None and row.year is None and row.size_change == 50


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_partitioning_does_not_change_features(silver, parts):
    base = FE.features(silver)
    other = FE.features(silver.repartition(parts)).select(base.columns)
    assert base.exceptAll(other).count() == 0
