"""Every registered query with SQL gives the SQL's rows; plans look right."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import plan_of
from editpulse.functions.scalars import months_between_filter
from editpulse.operators import aggregates as A
from editpulse.operators import clean as C
from editpulse.operators import features as FE
from editpulse.operators import kpis as K
from editpulse.operators import topk as T
from editpulse.plans import edits as E
from editpulse.sources.tables import write_silver
from tools.compare import bag

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    result = db.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == bag(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_no_python_in_plans(spark, sf_dir):
    for df in (E.edit_features(spark, sf_dir), C.silver(E.bronze(spark, sf_dir)),
               FE.trailing_edit_counts(E.edits(spark, sf_dir))):
        plan = plan_of(df)
        assert "Python" not in plan and "Pandas" not in plan


def test_dedup_limits_groups_before_the_shuffle(spark, sf_dir):
    plan = plan_of(C.dedup_revisions(E.bronze(spark, sf_dir)))
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("trailing", [False, True])
def test_features_shuffle_whole_rows_twice(spark, sf_dir, tmp_path, trailing):
    path = str(tmp_path / "silver")
    C.silver(E.bronze(spark, sf_dir)).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(FE.features(spark.read.parquet(path), trailing=trailing, max_rows=None))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one by user, one by page for the rows; the rest belongs to the statistics
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 2 + 4


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(C.silver(E.bronze(spark, sf_dir)), path)
    table = spark.read.parquet(path)
    plan = plan_of(T.top_pages(table.filter("is_bot = 1")))
    assert "EqualTo(is_bot,1)" in plan and "ReadSchema: struct<page_title:string,is_bot:int>" in plan
    pruned = plan_of(table.filter(months_between_filter((2024, 1), (2024, 3))).select("revid"))
    assert "PartitionFilters: [((year" in pruned
    assert "TakeOrderedAndProject" in plan_of(T.top_pages(table))


def test_invariants(spark, sf_dir):
    f = E.edit_features(spark, sf_dir).cache()
    n = f.count()
    users = A.user_stats(f)
    assert users.agg(F.sum("user_total_edits")).first()[0] == n
    bad = f.groupBy("page_title").agg(
        F.max("page_edit_sequence").alias("last"), F.count("*").alias("n"),
        F.max(F.col("page_additions") + F.col("page_deletions")).alias("moves"))
    assert bad.filter("last != n or moves > n").count() == 0
    assert set(K.edit_war_kpis(f)) == {"top_velocity_pages", "reverts", "top_revert_pages"}
    assert set(K.edit_war_kpis(f.drop("is_revert_candidate"))) == {"top_velocity_pages"}
