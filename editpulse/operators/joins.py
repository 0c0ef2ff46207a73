"""Joins beyond the per-key statistics, which live with the features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from editpulse.operators.clean import dedup_revisions


def join_cluster_labels(edits: DataFrame, clustered: DataFrame, *, user_col: str = "user",
                        cluster: str = "prediction") -> DataFrame:
    """Give each edit its user's cluster; users without a cluster drop out."""
    return edits.join(clustered.select(user_col, cluster), user_col)


def new_revisions(incoming: DataFrame, existing: DataFrame, *,
                  id_col: str = "revid") -> DataFrame:
    """Incoming revisions whose id is not stored yet, each id once.

    De-duplicating first keeps repeated deliveries of one id out of the join.
    """
    return dedup_revisions(incoming, id_col=id_col).join(
        existing.select(id_col), id_col, "left_anti")
