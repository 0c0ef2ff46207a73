"""Key figures and report tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editpulse.functions.scalars import epoch_seconds, percent, safe_round
from editpulse.operators.aggregates import confusion_matrix, n_rows, total
from editpulse.operators.topk import edits_by_hour, top_revert_pages, top_velocity_pages


def dataset_kpis(df: DataFrame) -> DataFrame:
    """Totals, shares and average size, one pass over silver."""
    return df.agg(
        n_rows().alias("total_edits"),
        F.count_distinct("page_title").alias("total_pages"),
        F.count_distinct("user").alias("total_users"),
        total("is_bot").alias("bot_edits"),
        total("is_anon").alias("anon_edits"),
        total("is_minor").alias("minor_edits"),
        safe_round(F.avg("size_bytes"), 1).alias("avg_edit_size"),
    ).withColumns({
        "bot_pct": percent("bot_edits", "total_edits"),
        "anon_pct": percent("anon_edits", "total_edits"),
        "minor_pct": percent("minor_edits", "total_edits"),
    })


def revert_kpis(features: DataFrame) -> DataFrame:
    return features.agg(
        n_rows().alias("total_edits"), total("is_revert_candidate").alias("revert_candidates"),
    ).withColumn("revert_rate", F.round(F.try_divide("revert_candidates", "total_edits"), 4))


def velocity_kpis(df: DataFrame, n: int = 10) -> DataFrame:
    return top_velocity_pages(df, n).select(
        "page_title", "edits", safe_round("edits_per_day", 1).alias("edits_per_day"))


def edit_war_kpis(features: DataFrame) -> dict[str, DataFrame]:
    """Edit-war tables; the revert parts only where the column exists."""
    tables = {"top_velocity_pages": velocity_kpis(features)}
    if "is_revert_candidate" in features.columns:
        tables["reverts"] = revert_kpis(features)
        tables["top_revert_pages"] = top_revert_pages(features)
    return tables


def edit_composition(df: DataFrame) -> DataFrame:
    """Edits by bots, by anonymous users and by everyone else."""
    sums = df.agg(total("is_bot").alias("bot"), total("is_anon").alias("anonymous"),
                  n_rows().alias("_n"))
    parts = sums.select("bot", "anonymous",
                        (F.col("_n") - F.col("bot") - F.col("anonymous")).alias("registered"))
    return parts.unpivot([], ["bot", "anonymous", "registered"], "kind", "edits")


def peak_hour(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Busiest hour of the day; the earlier one on a tie."""
    best = F.max(F.struct("edits", (-F.col("hour")).alias("_h"))).alias("_best")
    return edits_by_hour(df, ts_col).agg(best).select(
        (-F.col("_best._h")).cast("int").alias("hour"), F.col("_best.edits").alias("edits"))


def top_users_with_bot_flag(df: DataFrame, n: int = 10) -> DataFrame:
    return (df.groupBy("user").agg(n_rows().alias("edits"), F.max("is_bot").alias("is_bot"))
            .orderBy(F.desc("edits"), "user").limit(n))


def controversy_matrix(features: DataFrame, n: int = 10, ts_col: str = "timestamp") -> DataFrame:
    """Half reverts, half velocity, each relative to the maximum, over the
    ``n`` pages with most reverts. One aggregation yields both measures; the
    window sees at most ``n`` rows."""
    days = (epoch_seconds(F.max(ts_col)) - epoch_seconds(F.min(ts_col))) / F.lit(86400.0)
    pages = (features.groupBy("page_title")
             .agg(total("is_revert_candidate").alias("reverts"),
                  F.coalesce(F.try_divide(n_rows(), days), F.lit(0.0)).alias("edits_per_day"))
             .orderBy(F.desc("reverts"), "page_title").limit(n))
    everything = Window.partitionBy()
    share = [F.coalesce(F.try_divide(F.col(c), F.max(c).over(everything)), F.lit(0.0)) * 0.5
             for c in ("reverts", "edits_per_day")]
    return pages.withColumn("score", share[0] + share[1])


def cluster_fingerprint(profiles: DataFrame, columns: list[str]) -> DataFrame:
    """Cluster averages scaled by the largest cluster average; the table has
    one row per cluster."""
    everything = Window.partitionBy()
    return profiles.withColumns({
        c: F.when(F.max(c).over(everything) > 0, F.col(c) / F.max(c).over(everything))
        .otherwise(0.0) for c in columns})


def cluster_share(clustered: DataFrame, cluster: str = "prediction") -> DataFrame:
    """Users per cluster and their share; the window runs over the clusters."""
    sizes = clustered.groupBy(cluster).agg(n_rows().alias("users"))
    return sizes.withColumn(
        "users_pct", percent("users", F.sum("users").over(Window.partitionBy())))


def fnr_cells(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """TP, FN, FP, TN and the false-negative rate of a binary classifier."""
    cm = confusion_matrix(pred, label, prediction)

    def cell(actual, predicted):
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).cast("bigint")

    return cm.agg(cell(1, 1).alias("tp"), cell(1, 0).alias("fn"),
                  cell(0, 1).alias("fp"), cell(0, 0).alias("tn")).withColumn(
        "fnr", F.try_divide("fn", F.col("fn") + F.col("tp")))


def daily_trend(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return (df.groupBy(F.to_date(F.col(ts_col)).alias("day"))
            .agg(n_rows().alias("edits")).orderBy("day"))


def summary_card(dataset: DataFrame, bots: DataFrame | None = None,
                 edit_type: DataFrame | None = None, clusters: DataFrame | None = None,
                 reverts: DataFrame | None = None) -> DataFrame:
    """Text lines for a report header, built from one-row KPI tables."""
    lines = [dataset.select(
        F.lit(1).alias("position"),
        F.format_string(
            "Dataset: %d edits, %d pages, %d users; %.2f%% bot, %.2f%% anonymous, %.2f%% minor",
            "total_edits", "total_pages", "total_users",
            "bot_pct", "anon_pct", "minor_pct").alias("line"))]
    if bots is not None:
        lines.append(bots.select(F.lit(2), F.format_string(
            "Bot detection: AUC-ROC %.4f, AUC-PR %.4f, F1 %.4f, accuracy %.4f",
            "auc_roc", "auc_pr", "f1_score", "accuracy")))
    if edit_type is not None:
        lines.append(edit_type.select(F.lit(3), F.format_string(
            "Edit type: accuracy %.4f, F1 %.4f, precision %.4f, recall %.4f",
            "accuracy", "f1_score", "precision", "recall")))
    if clusters is not None:
        lines.append(clusters.select(F.lit(4), F.format_string(
            "Clusters: silhouette %.4f, k = %d", "silhouette_score", "num_clusters")))
    if reverts is not None:
        lines.append(reverts.select(F.lit(5), F.format_string(
            "Edit wars: %.2f%% reverts, %d candidates",
            F.col("revert_rate") * 100, "revert_candidates")))
    return reduce(DataFrame.union, lines)
