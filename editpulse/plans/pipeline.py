"""The staged batch pipeline: each step reads and writes a table.

Between steps the rows lie in Parquet, so every later pass reads only the
columns it needs, and a lost executor never forces an earlier step again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from editpulse.ml import models as M
from editpulse.operators.clean import silver
from editpulse.operators.features import features
from editpulse.operators.joins import new_revisions
from editpulse.operators.kpis import summary_card
from editpulse.plans.reports import kpi_tables, model_tables
from editpulse.sources import tables as TB
from editpulse.sources.bronze import read_bronze, write_batches


def land(spark: SparkSession, incoming: DataFrame, bronze_path: str, *,
         known: DataFrame | None = None, first: bool = False, batch_size: int = 100_000) -> None:
    """Append revisions that are not in bronze yet.

    ``known`` may name a table with the ids collected so far, such as silver,
    whose id column is far cheaper to read than the JSON files.
    """
    if first:
        rows = incoming
    else:
        rows = new_revisions(incoming, read_bronze(spark, bronze_path) if known is None else known)
    write_batches(rows, bronze_path, batch_size=batch_size)


def build_silver(spark: SparkSession, bronze_path: str, silver_path: str) -> DataFrame:
    TB.write_silver(silver(read_bronze(spark, bronze_path), parse_once=True), silver_path)
    return TB.read_table(spark, silver_path)


def build_features(spark: SparkSession, silver_path: str, features_path: str, *,
                   trailing: bool = True, silver_table: DataFrame | None = None) -> DataFrame:
    """``silver_table`` may be the same rows read by buckets of the user
    (``sources.layout``), which saves the user step its shuffle."""
    rows = TB.read_table(spark, silver_path) if silver_table is None else silver_table
    TB.write_features(features(rows, trailing=trailing), features_path)
    return TB.read_table(spark, features_path)


def build_gold(spark: SparkSession, silver_path: str, gold_path: str) -> DataFrame:
    TB.write_gold(M.gold_segmentation(TB.read_table(spark, silver_path)), gold_path)
    return TB.read_table(spark, gold_path)


def model_paths(models_path: str) -> dict[str, str]:
    return {name: f"{models_path}/{name}" for name in ("bot", "edit_type", "edit_type_labels", "clusters")}


def build_models(spark: SparkSession, features_path: str, models_path: str) -> DataFrame:
    """Train and save the three models and the label indexer, and audit what was
    saved. A label with a single class, or too few users, gives no model."""
    rows, paths = TB.read_table(spark, features_path), model_paths(models_path)
    if bot := M.train_bot_model(rows):
        M.save_model(bot[0], paths["bot"])
    if edit_type := M.train_edit_type_model(rows):
        model, indexer, _ = edit_type
        M.save_model(indexer, paths["edit_type_labels"])
        M.save_model(model, paths["edit_type"])
    if clusters := M.train_user_clusters(rows):
        M.save_model(clusters[0], paths["clusters"])
    return M.audit_models(spark, {k: p for k, p in paths.items() if k != "edit_type_labels"})


def build_kpis(spark: SparkSession, silver_path: str, features_path: str, kpi_path: str,
               models_path: str | None = None) -> None:
    """Each KPI table in a folder of its own, the summary card, and one nested
    document of all of them. The document is put together from the written tables,
    so nothing is computed twice."""
    features = TB.read_table(spark, features_path)
    plain = kpi_tables(TB.read_table(spark, silver_path), features)
    wars = [n for n in plain if n in ("top_velocity_pages", "reverts", "top_revert_pages")]
    sections = {"dataset": {n: t for n, t in plain.items() if n not in wars}, "edit_wars": {n: plain[n] for n in wars}}
    if models_path is not None:
        sections |= model_tables(features, model_paths(models_path))
    written = {}
    for section, tables in sections.items():
        folder = {n: n if n in plain else f"{section}_{n}" for n in tables}
        TB.write_kpis({folder[n]: t for n, t in tables.items()}, kpi_path)
        written[section] = {n: spark.read.schema(t.schema).json(f"{kpi_path}/{folder[n]}") for n, t in tables.items()}
    metrics = {s: written[s]["metrics"] if s in written else None for s in ("bot_detection", "edit_type", "user_clustering")}
    card = summary_card(written["dataset"]["dataset"], metrics["bot_detection"], metrics["edit_type"],
                        metrics["user_clustering"], written["edit_wars"].get("reverts"))
    TB.write_kpis({"summary_card": card}, kpi_path)
    TB.nested_document(written).write.mode("overwrite").text(f"{kpi_path}/document")
