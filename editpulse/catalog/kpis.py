"""Key figures."""

from pyspark.sql import functions as F

from editpulse.catalog import models as MO
from editpulse.catalog.aggregates import GUESSES, PROFILES, changed, guesses, plain, segments
from editpulse.catalog.base import DATASET_KPIS, EDITS, FEATURES, rounded, with_
from editpulse.operators import aggregates as A
from editpulse.operators import features as FE
from editpulse.operators import kpis as K
from editpulse.plans import edits as E
from editpulse.sources.tables import kpi_document


def reverting(fn):
    return changed(lambda df: fn(FE.page_sequence(df)))


def fingerprint(df):
    profiles = A.cluster_profiles(segments(A.user_profiles(df)))
    return K.cluster_fingerprint(profiles, ["avg_edits", "avg_pages", "avg_size"])


def card(spark, d):
    """All five lines; those of models from given scores and segments."""
    changed_edits = E.edits_with_change(spark, d)
    metrics = MO.multiclass(spark, d)
    return K.summary_card(
        K.dataset_kpis(changed_edits), MO.areas(spark, d).crossJoin(metrics), metrics,
        MO.silhouette(spark, d).select(F.col("silhouette").alias("silhouette_score"), F.lit(3).alias("num_clusters")),
        K.revert_kpis(FE.page_sequence(changed_edits)))


_REVERTS = """SELECT count(*) AS total_edits, cast(sum(is_revert_candidate) AS bigint) AS revert_candidates,
  round(sum(is_revert_candidate) / count(*)::double, 4) AS revert_rate FROM features"""

QUERIES = {
    "dataset_kpis": (plain(K.dataset_kpis), with_(EDITS, DATASET_KPIS)),
    "revert_kpis": (reverting(K.revert_kpis), with_(FEATURES, _REVERTS)),
    "velocity_kpis": (plain(K.velocity_kpis), with_(EDITS, """
        SELECT page_title, edits, round(edits / days, 1) AS edits_per_day
        FROM (SELECT page_title, count(*) AS edits, (max(sec) - min(sec)) / 86400.0::double AS days
              FROM edits GROUP BY page_title) WHERE days > 1
        ORDER BY edits / days DESC, page_title LIMIT 10""")),
    "edit_composition": (plain(K.edit_composition), with_(EDITS, """
        SELECT 'bot' AS kind, cast(sum(is_bot) AS bigint) AS edits FROM edits
        UNION ALL SELECT 'anonymous', cast(sum(is_anon) AS bigint) FROM edits
        UNION ALL SELECT 'registered', cast(count(*) - sum(is_bot) - sum(is_anon) AS bigint) FROM edits""")),
    "peak_hour": (plain(K.peak_hour), with_(EDITS, """
        SELECT hour, count(*) AS edits FROM edits GROUP BY hour ORDER BY edits DESC, hour LIMIT 1""")),
    "top_users_with_bot_flag": (plain(K.top_users_with_bot_flag), with_(EDITS, """
        SELECT usr AS "user", count(*) AS edits, max(is_bot) AS is_bot FROM edits
        GROUP BY usr ORDER BY edits DESC, usr LIMIT 10""")),
    "controversy_matrix": (reverting(K.controversy_matrix), with_(FEATURES + """, pages10 AS (
        SELECT page_title, cast(sum(is_revert_candidate) AS bigint) AS reverts,
               count(*) / ((max(sec) - min(sec)) / 86400.0::double) AS epd
        FROM features GROUP BY page_title ORDER BY reverts DESC, page_title LIMIT 10)""", """
        SELECT page_title, reverts, round(epd, 6) AS edits_per_day,
               round(0.5::double * reverts / max(reverts) OVER () + 0.5::double * epd / max(epd) OVER (), 6) AS score
        FROM pages10""")),
    "cluster_fingerprint": (changed(fingerprint), with_(PROFILES + """, means AS (
        SELECT prediction, count(*) AS users, avg(total_edits) AS e, avg(pages_edited) AS p,
               avg(avg_edit_size) AS s, avg(minor_edits) AS m, avg(is_bot_flag) AS b
        FROM clustered GROUP BY prediction)""", """
        SELECT prediction, users, round(e / max(e) OVER (), 6) AS avg_edits, round(p / max(p) OVER (), 6) AS avg_pages,
               round(s / max(s) OVER (), 6) AS avg_size, round(m, 6) AS avg_minor, round(b, 6) AS avg_bot_edits
        FROM means""")),
    "cluster_share": (changed(lambda df: K.cluster_share(segments(A.user_profiles(df)))), with_(PROFILES, """
        SELECT prediction, count(*) AS users,
               round(100.0::double * count(*) / sum(count(*)) OVER (), 2) AS users_pct
        FROM clustered GROUP BY prediction""")),
    "fnr_cells": (plain(lambda df: K.fnr_cells(guesses(df))), with_(GUESSES, """
        SELECT tp, fn, fp, tn, round(fn / (fn + tp)::double, 6) AS fnr FROM (
          SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp,
                 count(*) FILTER (label = 1 AND prediction = 0) AS fn,
                 count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                 count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM guesses)""")),
    "daily_trend": (plain(K.daily_trend), with_(EDITS, """
        SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS edits FROM edits GROUP BY 1 ORDER BY 1""")),
    "summary_card": (card, with_(FEATURES + f""", d AS ({DATASET_KPIS}), r AS ({_REVERTS})""", """
        SELECT 1 AS position, printf('Dataset: %d edits, %d pages, %d users; %.2f%% bot, %.2f%% anonymous, %.2f%% minor',
          total_edits, total_pages, total_users, bot_pct, anon_pct, minor_pct) AS line FROM d
        UNION ALL SELECT 5, printf('Edit wars: %.2f%% reverts, %d candidates', revert_rate * 100, revert_candidates)
        FROM r
        UNION ALL SELECT 2, printf('Bot detection: AUC-ROC %.4f, AUC-PR %.4f, F1 %.4f, accuracy %.4f', auc_roc, auc_pr, f1_score, accuracy)
        FROM (""" + MO.QUERIES["eval_binary"][1] + ") a, (" + MO.QUERIES["eval_multiclass"][1] + """) m
        UNION ALL SELECT 3, printf('Edit type: accuracy %.4f, F1 %.4f, precision %.4f, recall %.4f', accuracy, f1_score, "precision", recall)
        FROM (""" + MO.QUERIES["eval_multiclass"][1] + """) m
        UNION ALL SELECT 4, printf('Clusters: silhouette %.4f, k = %d', silhouette, 3) FROM (""" + MO.QUERIES["eval_silhouette"][1] + ") s")),
    "kpi_document": (
        lambda spark, d: kpi_document(
            K.edit_composition(E.edits(spark, d)).groupBy().pivot(
                "kind", ["anonymous", "bot", "registered"]).sum("edits"), "composition"),
        with_(EDITS, """SELECT 'composition' AS kpi,
        '{"anonymous":' || sum(is_anon) || ',"bot":' || sum(is_bot) || ',"registered":'
        || (count(*) - sum(is_bot) - sum(is_anon)) || '}' AS document FROM edits""")),
}
