"""Samples, splits and class weights that depend only on row ids.

A row's place is decided by the md5 of its id, so reruns, partition counts and
lost executors give the same sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.functions.scalars import hash_bucket, hash_text

# Above this many strata the cut table is joined instead of broadcast.
MAX_BROADCAST_STRATA = 10_000


def random_sample(df: DataFrame, percent: int = 10, id_col: str = "revid") -> DataFrame:
    return df.filter(hash_bucket(id_col) < percent)


def split_train_test(df: DataFrame, train_percent: int = 80,
                     id_col: str = "revid") -> tuple[DataFrame, DataFrame]:
    bucket = hash_bucket(id_col)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def _cuts(df: DataFrame, stratum: str, wanted: Column, prefix: Column) -> DataFrame:
    """Per stratum: the hash prefix in which the wanted number of rows is
    reached, and how many rows of that prefix still belong."""
    per_prefix = df.groupBy(F.col(stratum), prefix.alias("_prefix")).agg(
        F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(stratum)
    running = F.sum("_n").over(w.orderBy("_prefix"))
    return (
        per_prefix
        .select(stratum, "_prefix", "_n", running.alias("_through"),
                F.sum("_n").over(w).alias("_total"))
        .withColumn("_want", F.least(F.col("_total"), wanted).cast("bigint"))
        .filter((F.col("_through") >= F.col("_want"))
                & (F.col("_through") - F.col("_n") < F.col("_want")))
        .select(stratum, F.col("_prefix").alias("_cut"),
                (F.col("_want") - F.col("_through") + F.col("_n")).alias("_rest"))
    )


def _size_checked(cuts: DataFrame) -> DataFrame:
    """Broadcast the cut table only when it is small; it has a row per stratum."""
    rows = cuts.limit(MAX_BROADCAST_STRATA + 1).collect()
    if len(rows) > MAX_BROADCAST_STRATA:
        return cuts
    return F.broadcast(cuts.sparkSession.createDataFrame(rows, cuts.schema))


def mark_first_by_hash(df: DataFrame, stratum: str, wanted: Column, *,
                       id_col: str = "revid", mark: str = "_in") -> DataFrame:
    """Mark exactly ``wanted`` rows of each stratum, those with least md5(id).

    ``wanted`` may use ``_total``, the stratum's size. Ranking a whole stratum
    would put it into one task; instead the rows are counted per hash prefix,
    and only the rows of the one prefix in which the count is reached are
    ranked, about 1/65536 of the stratum.
    """
    prefix = F.substring(hash_text(id_col), 1, 4)
    cuts = _size_checked(_cuts(df, stratum, wanted, prefix))
    placed = df.withColumn("_prefix", prefix).join(cuts, stratum, "left")
    cut = F.coalesce("_cut", F.lit(""))
    clear = placed.filter(F.col("_prefix") != cut).withColumn(mark, F.col("_prefix") < cut)
    w = Window.partitionBy(stratum).orderBy(hash_text(id_col), id_col)
    ranked = placed.filter(F.col("_prefix") == cut).withColumn(
        mark, F.row_number().over(w) <= F.col("_rest"))
    return clear.unionByName(ranked).drop("_prefix", "_cut", "_rest")


def stratified_split(df: DataFrame, label: str, train_fraction: float = 0.8, *,
                     id_col: str = "revid") -> DataFrame:
    """Column ``split``: exactly ceil(fraction * n) train rows in each class."""
    marked = mark_first_by_hash(
        df, label, F.ceil(F.col("_total") * F.lit(train_fraction)), id_col=id_col)
    return marked.withColumn(
        "split", F.when(F.col("_in"), "train").otherwise("test")).drop("_in")


def balanced_sample(df: DataFrame, label: str, per_class: int = 50_000, *,
                    id_col: str = "revid") -> DataFrame:
    """At most ``per_class`` rows of each class, always the same ones."""
    return mark_first_by_hash(
        df, label, F.lit(per_class), id_col=id_col).filter("_in").drop("_in")


def class_weights(df: DataFrame, label: str, positive: int = 1,
                  weight_col: str = "weight") -> DataFrame:
    """Positives weigh negatives / max(positives, 1), all others 1."""
    is_positive = F.col(label) == positive
    ratio = df.agg(
        (F.count_if(~is_positive) / F.greatest(F.count_if(is_positive), F.lit(1)))
        .alias("ratio")).scalar()
    return df.withColumn(weight_col, F.when(is_positive, ratio).otherwise(F.lit(1.0)))
