"""Reports that combine several operators."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.ml import evaluation as EV
from editpulse.ml import models as M
from editpulse.operators.aggregates import (
    date_range, duplicate_count, retention, silver_summary, user_profiles,
)
from editpulse.operators.kpis import dataset_kpis, edit_war_kpis
from editpulse.operators.quality import null_report
from editpulse.operators.sampling import balanced_sample
from editpulse.operators.topk import edits_by_hour, top_pages, top_users


def quality_report(bronze: DataFrame, silver: DataFrame) -> dict[str, DataFrame]:
    """Everything the cleaning step reports, one table per question."""
    return {
        "nulls": null_report(bronze),
        "duplicates": duplicate_count(bronze),
        "retention": retention(bronze, silver),
        "summary": silver_summary(silver),
        "date_range": date_range(silver),
        "top_pages": top_pages(silver),
    }


def kpi_tables(silver: DataFrame, features: DataFrame) -> dict[str, DataFrame]:
    """The model-free part of the KPI document."""
    return {
        "dataset": dataset_kpis(silver),
        "top_pages": top_pages(silver),
        "top_users": top_users(silver),
        "edits_by_hour": edits_by_hour(silver),
        **edit_war_kpis(features),
    }


def model_tables(features: DataFrame, paths: dict[str, str]) -> dict[str, dict[str, DataFrame]]:
    """The model sections of the KPI document, by models read from ``paths``. A
    model that cannot be read has no section."""
    audit = M.audit_models(features.sparkSession, {k: paths[k] for k in ("bot", "edit_type", "clusters")})
    readable = {r.model for r in audit.collect() if r.status == "LOADED"}
    sections = {}
    if "bot" in readable:
        model = M.load_model(paths["bot"])
        sample = balanced_sample(M.bot_rows(features), "is_bot")
        sections["bot_detection"] = EV.bot_kpis(model, M.score(model, sample))
    if "edit_type" in readable:
        scored = M.score(M.load_model(paths["edit_type"]), M.edit_type_rows(features), M.load_indexer(paths["edit_type_labels"]))
        sections["edit_type"] = EV.edit_type_kpis(scored)
    if "clusters" in readable:
        model = M.load_model(paths["clusters"])
        sections["user_clustering"] = EV.cluster_kpis(model, M.score(model, user_profiles(features, 5)))
    return sections


def _seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def bench_partitions(df: DataFrame, counts: tuple[int, ...] = (1, 4, 8, 16)) -> DataFrame:
    """Time of a full pass over the table at several partition counts."""
    rows = [(n, _seconds(df.repartition(n))) for n in counts]
    return df.sparkSession.createDataFrame(rows, "partitions int, seconds double")


def bench_cache(df: DataFrame, condition: str = "is_bot = 1") -> DataFrame:
    """Time of a filtered count without, while filling, and with the cache."""
    plain = _seconds(df.filter(condition).agg(F.count("*")))
    held = df.persist()
    try:
        fill = _seconds(held.filter(condition).agg(F.count("*")))
        warm = _seconds(held.filter(condition).agg(F.count("*")))
    finally:
        held.unpersist()
    return df.sparkSession.createDataFrame(
        [(plain, fill, warm, plain / warm)],
        "no_cache double, filling double, cached double, speedup double")
