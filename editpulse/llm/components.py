"""Connected components of an edge list, by alternating large and small stars.

Every round links each node to the least node it knows, writes the edges to the
shared folder (so lineage stays short and lost executors cost one round), and
ends when the edges no longer change. Edges stay linear in their first number:
no group is gathered in a task and no pairs inside a group are made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.session import remove_stored, stored


def _largest(edges: DataFrame) -> DataFrame:
    """Greater neighbours of each node move to its least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _smallest(edges: DataFrame) -> DataFrame:
    """Lesser neighbours of each node, and itself, move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint) other than the
    roots themselves; root is the least node of the component."""
    now, before = stored(edges.filter("a <> b").select("a", "b").distinct(), label), None
    while True:
        last, now = now, stored(_smallest(_largest(now)).distinct(), label)
        remove_stored(last)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
