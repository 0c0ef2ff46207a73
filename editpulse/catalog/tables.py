"""The same operators on the order tables, which are larger."""

from pyspark.sql import functions as F

from editpulse.catalog.base import rounded
from editpulse.functions.scalars import flag
from editpulse.operators import aggregates as A
from editpulse.operators import clean as C
from editpulse.operators import features as FE
from editpulse.operators import kpis as K
from editpulse.operators import topk as T
from editpulse.plans import edits as E


def lines_as_edits(spark, d):
    """Order lines read as edits: part = page, supplier = user."""
    line = E.table(spark, d, "lineitem")
    rows = line.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber") * 10).alias("line"),
        F.col("l_partkey").cast("string").alias("page_title"),
        F.col("l_suppkey").cast("string").alias("user"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.floor("l_extendedprice").cast("bigint").alias("size_bytes"),
        flag(F.col("l_returnflag") == "R").alias("is_minor"))
    return rows


def velocity(spark, d):
    return rounded(T.top_velocity_pages(lines_as_edits(spark, d)))


def stats(spark, d):
    rows = lines_as_edits(spark, d).withColumns({
        "size_change_abs": F.col("size_bytes"), "size_change": F.col("size_bytes") - 40_000})
    return rounded(A.page_stats(rows))


def monthly(spark, d):
    orders = E.table(spark, d, "orders")
    return rounded(K.daily_trend(orders, "o_orderdate"))


def order_sequence(spark, d):
    """Orders per customer: position and gap to the order before."""
    rows = E.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("revid"), F.col("o_custkey").alias("user"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"))
    return FE.user_sequence(rows)


def price_change(spark, d):
    """Order price against the customer's order before."""
    rows = E.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("at"),
        F.floor("o_totalprice").cast("bigint").alias("price"))
    return C.size_change(rows, page_col="o_custkey", ts_col="at", id_col="o_orderkey",
                         size_col="price").drop("at")


QUERIES = {
    "part_velocity": (velocity, """
        SELECT page_title, edits, round(days, 6) AS days, round(edits / days, 6) AS edits_per_day FROM (
          SELECT cast(l_partkey AS varchar) AS page_title, count(*) AS edits,
                 (floor(epoch(max(l_shipdate))) - floor(epoch(min(l_shipdate)))) / 86400.0::double AS days
          FROM lineitem GROUP BY 1) WHERE days > 1
        ORDER BY edits / days DESC, page_title LIMIT 10"""),
    "part_stats": (stats, """
        SELECT cast(l_partkey AS varchar) AS page_title, count(*) AS page_total_edits,
               count(DISTINCT l_suppkey) AS page_unique_editors,
               round(avg(floor(l_extendedprice)), 6) AS page_avg_edit_size,
               count(*) FILTER (floor(l_extendedprice) > 40000) AS page_additions,
               count(*) FILTER (floor(l_extendedprice) < 40000) AS page_deletions,
               round(count(*) * count(DISTINCT l_suppkey) / 1000.0::double, 6) AS page_controversy_score
        FROM lineitem GROUP BY 1"""),
    "order_trend": (monthly, """
        SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS edits FROM orders GROUP BY 1 ORDER BY 1"""),
    "order_sequence": (lambda spark, d: rounded(order_sequence(spark, d)), """
        SELECT *, CASE WHEN time_since_last_edit_sec BETWEEN 1 AND 60 THEN 1 ELSE 0 END AS user_is_rapid_editor FROM (
          SELECT o_orderkey AS revid, o_custkey AS "user", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
               row_number() OVER w AS user_edit_sequence,
               coalesce(cast(floor(epoch(o_orderdate)) - lag(floor(epoch(o_orderdate))) OVER w AS bigint), 0)
                 AS time_since_last_edit_sec
          FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""),
    "price_change": (price_change, """
        SELECT *, abs(size_change) AS size_change_abs FROM (
          SELECT o_orderkey, o_custkey, cast(floor(o_totalprice) AS bigint) AS price,
               cast(floor(o_totalprice) AS bigint) - coalesce(lag(cast(floor(o_totalprice) AS bigint)) OVER (
                 PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 0) AS size_change FROM orders)"""),
}
