"""Model training, scoring and evaluation."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from editpulse.catalog.aggregates import GUESSES, PROFILES, guesses, segments
from editpulse.catalog.base import BUCKET, CHANGED, EDITS, FEATURES, long_table, rounded, with_
from editpulse.ml import evaluation as EV
from editpulse.ml import models as M
from editpulse.operators import aggregates as A
from editpulse.operators import features as FE
from editpulse.plans import edits as E
from editpulse.schemas import BOT_INPUTS, CLUSTER_INPUTS
from editpulse.session import scratch_dir
from editpulse.sources.tables import write_gold


def unpacked(df, vector, names):
    values = vector_to_array(vector)
    return [F.round(values[i], 6).alias(n) for i, n in enumerate(names)]


def assembled(spark, d):
    rows = M.assemble(BOT_INPUTS).transform(M.bot_rows(E.edit_features(spark, d)))
    return rows.select("revid", *unpacked(rows, "features_raw", BOT_INPUTS))


def scaled(spark, d):
    profiles = M.assemble(CLUSTER_INPUTS).transform(A.user_profiles(E.edits_with_change(spark, d)))
    rows = M.scale().fit(profiles).transform(profiles)
    return rows.select("user", *unpacked(rows, "features", CLUSTER_INPUTS))


def indexed(spark, d):
    rows = FE.edit_features(E.edits_with_change(spark, d)).select("revid", "edit_magnitude")
    return M.index_label(rows).transform(rows).select("revid", F.col("label").cast("int").alias("label"))


def _given_scores(spark, d):
    """A given score with few distinct values and many ties."""
    return E.edits(spark, d).select(
        "is_bot", (F.col("hour") + F.col("is_bot") * 3 + F.col("is_minor")).cast("double").alias("score"))


def areas(spark, d):
    roc, pr = EV.binary_areas(_given_scores(spark, d), "is_bot", "score")
    return spark.createDataFrame([(round(roc, 6), round(pr, 6))], "auc_roc double, auc_pr double")


def curve(spark, d):
    """A score that is different in nearly every row."""
    rows = E.edits_with_change(spark, d).select(
        "is_bot", (F.col("size_change") * 1000 + F.col("revid") % 1000).cast("double").alias("score"))
    return EV.score_curve(rows, "is_bot", "score")


def multiclass(spark, d):
    return rounded(EV.multiclass_metrics(guesses(E.edits(spark, d))))


def silhouette(spark, d):
    users = segments(A.user_profiles(E.edits_with_change(spark, d)))
    rows = M.assemble(["total_edits", "pages_edited"], "features").transform(users)
    value = EV.silhouette(rows.withColumn("prediction", F.col("prediction").cast("double")))
    return spark.createDataFrame([(round(value, 6),)], "silhouette double")


def _cells(tables):
    """Report tables with the cells of the confusion matrix named by one column."""
    matrix = tables["confusion"]
    label, guess = matrix.columns[:2]
    return tables | {"confusion": matrix.withColumn("cell", F.concat_ws(" as ", label, guess)).drop(label, guess)}


def bot_scores(spark, d):
    _, pred = M.train_bot_model(E.bot_features(spark, d))
    return pred.select("revid", "is_bot", F.col("prediction").cast("int").alias("prediction"))


def bot_metrics(spark, d):
    model, pred = M.train_bot_model(E.bot_features(spark, d))
    return long_table(_cells(EV.bot_kpis(model, pred)), {"confusion": "cell", "top_features": "feature"})


def top_features(spark, d):
    model, _ = M.train_bot_model(E.bot_features(spark, d))
    return rounded(EV.feature_importances(model))


def edit_type_scores(spark, d):
    _, _, pred = M.train_edit_type_model(E.feature_table(spark, d))
    return long_table(_cells(EV.edit_type_kpis(pred)), {"confusion": "cell", "predicted": "prediction"})


def edit_type_predictions(spark, d):
    """Whole feature table scored with the label indexer and the model."""
    features = E.feature_table(spark, d)
    model, indexer, _ = M.train_edit_type_model(features)
    return M.score(model, M.edit_type_rows(features), indexer).select(
        "revid", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


def edit_type_test_rows(spark, d):
    _, _, pred = M.train_edit_type_model(E.feature_table(spark, d))
    return pred.select("revid", F.col("label").cast("int").alias("label"),
                       F.col("prediction").cast("int").alias("prediction"))


def _sound(pred, classes):
    """Whether the probabilities of a row sum to 1 and its class is the likeliest."""
    p = vector_to_array("probability")
    return ((F.size(p) == classes) & (F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9)
            & (F.element_at(p, F.col("prediction").cast("int") + 1) == F.array_max(p))).alias("sound")


def bot_test_rows(spark, d):
    """The rows held out of training, each soundly scored."""
    _, pred = M.train_bot_model(E.bot_features(spark, d))
    return pred.select("revid", "is_bot", _sound(pred, 2))


def edit_type_labels(spark, d):
    """Held-out rows with their class number by falling frequency; the model has
    one class more, for values unseen in training."""
    _, indexer, pred = M.train_edit_type_model(E.feature_table(spark, d))
    return pred.select("revid", F.col("label").cast("int").alias("label"), _sound(pred, len(indexer.labels) + 1))


def importances(spark, d):
    model, _ = M.train_bot_model(E.bot_features(spark, d))
    return rounded(EV.feature_importances(model, None))


def clusters(spark, d):
    _, users = M.train_user_clusters(E.edits_with_change(spark, d))
    return rounded(A.cluster_profiles(users))


def cluster_metrics(spark, d):
    model, users = M.train_user_clusters(E.edits_with_change(spark, d))
    tables = EV.cluster_kpis(model, users)
    tables["centers"] = tables["centers"].withColumn("cluster", F.concat_ws(" ", "cluster", "feature")).drop("feature")
    return long_table(tables, {"sizes": "prediction", "profiles": "prediction", "centers": "cluster"})


def centers(spark, d):
    model, _ = M.train_user_clusters(E.edits_with_change(spark, d))
    return rounded(EV.cluster_centers(model))


def gold(spark, d):
    """Segments written by cluster and read back."""
    path = scratch_dir(spark, "gold")
    write_gold(M.gold_segmentation(E.edits(spark, d)), path)
    return rounded(spark.read.parquet(path))


def stored_model(spark, d):
    """Predictions of a model before saving and after loading."""
    path = scratch_dir(spark, "model")
    model, users = M.train_user_clusters(E.edits_with_change(spark, d))
    M.save_model(model, path)
    again = M.score(M.load_model(path), users.drop("features_raw", "features", "prediction"))
    both = users.select("user", F.col("prediction").alias("before")).join(
        again.select("user", F.col("prediction").alias("after")), "user")
    return both.agg(F.count("*").alias("users"), F.count_if(F.col("before") != F.col("after")).alias("changed"))


def audit(spark, d):
    path = scratch_dir(spark, "model")
    model, _ = M.train_user_clusters(E.edits_with_change(spark, d))
    M.save_model(model, path)
    return M.audit_models(spark, {"clusters": path, "missing": f"{path}-missing"}).drop("path")


def _total(df, column):
    return df.agg(F.sum(column)).first()[0]


def _right(tables):
    """Whether the share of the matrix's diagonal is the accuracy."""
    matrix = tables["confusion"]
    hits = matrix.filter(F.col(matrix.columns[0]) == F.col(matrix.columns[1]))
    return abs(_total(hits, "n") / _total(matrix, "n") - tables["metrics"].first().accuracy) < 1e-9


def report_totals(spark, d):
    """What the tables of the three reports must add up to."""
    features = E.feature_table(spark, d)
    bots = EV.bot_kpis(*M.train_bot_model(features))
    edit_type = EV.edit_type_kpis(M.train_edit_type_model(features)[2])
    groups = EV.cluster_kpis(*M.train_user_clusters(E.edits_with_change(spark, d)))
    return spark.createDataFrame([
        ("bot rows", _total(bots["confusion"], "n"), _right(bots)),
        ("bot inputs", bots["top_features"].count(), abs(_total(bots["top_features"], "importance") - 1) < 1e-9),
        ("edit type rows", _total(edit_type["confusion"], "n"), _right(edit_type)),
        ("edit types guessed", _total(edit_type["predicted"], "edits"), True),
        ("users in clusters", _total(groups["sizes"], "users"), groups["sizes"].count() == groups["metrics"].first().num_clusters),
        ("users in profiles", _total(groups["profiles"], "users"), groups["profiles"].count() == groups["sizes"].count()),
    ], "figure string, total bigint, holds boolean")


def importance_totals(fn):
    """Number of inputs and the sum of their importances, which is 1."""
    return lambda spark, d: fn(spark, d).agg(F.count("*").alias("inputs"), F.count_if(F.col("importance") < 0).alias("negative"), F.round(F.sum("importance"), 4).alias("total"))


def separable(spark, d):
    """Trained on rows that two inputs tell apart, the model knows every held-out row."""
    told = E.bot_features(spark, d).withColumns({"is_minor": F.col("is_bot"), "comment_length": F.col("is_bot") * 40})
    return M.train_bot_model(told)[1].select("revid", "is_bot", F.col("prediction").cast("int").alias("prediction"))


def reloaded_edit_type(spark, d):
    """Scores of the edit-type model and its label indexer before saving and after loading."""
    path = scratch_dir(spark, "edit-type")
    features = E.feature_table(spark, d)
    model, indexer, _ = M.train_edit_type_model(features)
    M.save_model(model, f"{path}/model")
    M.save_model(indexer, f"{path}/labels")
    rows = M.edit_type_rows(features)
    before = M.score(model, rows, indexer).select("revid", F.col("label").alias("l"), F.col("prediction").alias("p"))
    after = M.score(M.load_model(f"{path}/model"), rows, M.load_indexer(f"{path}/labels")).select("revid", "label", "prediction")
    return before.join(after, "revid").agg(F.count("*").alias("edits"), F.count_if((F.col("l") != F.col("label")) | (F.col("p") != F.col("prediction"))).alias("changed"))


def nearest(spark, d):
    """Every user stands in the cluster whose centre is nearest to its scaled profile."""
    model, users = M.train_user_clusters(E.edits_with_change(spark, d))
    names = model.stages[0].getInputCols()
    pairs = F.arrays_zip(F.array(*map(F.lit, names)).alias("feature"), vector_to_array("features").alias("x"))
    long = users.select("user", "prediction", F.inline(pairs))
    away = long.join(F.broadcast(EV.cluster_centers(model)), "feature").groupBy("user", "prediction", "cluster").agg(F.sum((F.col("x") - F.col("value")) ** 2).alias("distance"))
    own = F.when(F.col("cluster") == F.col("prediction"), F.col("distance"))
    return away.groupBy("user").agg((F.min("distance") >= F.min(own) - 1e-9).alias("is_nearest"))


def gold_totals(spark, d):
    """Every complete edit once, and every user in one of three segments."""
    users = M.gold_segmentation(E.edits(spark, d)).groupBy("user").agg(
        F.count("*").alias("edits"), F.count_distinct("prediction").alias("segments"), F.max("prediction").alias("last"))
    return users.select("user", "edits", "segments", F.col("last").between(0, 2).alias("known"))


def guard(spark, d):
    rows = E.edits(spark, d).filter("is_bot = 0")
    return rows.agg(F.count("*").alias("edits")).withColumn("trainable", F.lit(M.trainable(rows, "is_bot")))


_STD = "round({0} / (SELECT stddev_samp({0}) FROM profiles), 6) AS {0}"

QUERIES = {
    "assemble": (assembled, with_(FEATURES, "SELECT revid, " + ", ".join(
        f"round(cast({c} AS double), 6) AS {c}" for c in BOT_INPUTS) + " FROM features")),
    "scale": (scaled, with_(PROFILES, 'SELECT usr AS "user", ' + ", ".join(
        _STD.format(c) for c in CLUSTER_INPUTS) + " FROM profiles")),
    "index_label": (indexed, with_(FEATURES, """
        SELECT revid, label FROM features JOIN (
          SELECT edit_magnitude, cast(row_number() OVER (ORDER BY count(*) DESC, edit_magnitude) - 1 AS int) AS label
          FROM features GROUP BY edit_magnitude) USING (edit_magnitude)""")),
    "eval_binary": (areas, with_(CHANGED + """, scores AS (
          SELECT cast(hour + is_bot * 3 + is_minor AS double) AS score, count(*) FILTER (is_bot = 1) AS p,
                 count(*) FILTER (is_bot = 0) AS n FROM changed GROUP BY 1), running AS (
          SELECT score, sum(p) OVER (ORDER BY score DESC)::double AS tp, sum(n) OVER (ORDER BY score DESC)::double AS fp,
                 (SELECT sum(p) FROM scores)::double AS pos, (SELECT sum(n) FROM scores)::double AS neg
          FROM scores), points AS (
          SELECT score, fp / neg AS fpr, tp / pos AS tpr, tp / (tp + fp) AS prec,
                 coalesce(lag(fp / neg) OVER w, 0) AS fpr0, coalesce(lag(tp / pos) OVER w, 0) AS tpr0,
                 coalesce(lag(tp / (tp + fp)) OVER w, tp / (tp + fp)) AS prec0
          FROM running WINDOW w AS (ORDER BY score DESC))""", """
        SELECT round(sum((fpr - fpr0) * (tpr + tpr0) / 2), 6) AS auc_roc,
               round(sum((tpr - tpr0) * (prec + prec0) / 2), 6) AS auc_pr FROM points""")),
    "eval_score_curve": (curve, with_(CHANGED + """, scores AS (
          SELECT cast(size_change * 1000 + revid % 1000 AS double) AS score, count(*) FILTER (is_bot = 1) AS n_pos,
                 count(*) FILTER (is_bot = 0) AS n_neg FROM changed GROUP BY 1)""", """
        SELECT score, n_pos, n_neg, cast(sum(n_pos) OVER (ORDER BY score DESC) AS bigint) AS tp,
               cast(sum(n_neg) OVER (ORDER BY score DESC) AS bigint) AS fp FROM scores WHERE score IS NOT NULL""")),
    "eval_multiclass": (multiclass, with_(GUESSES + """, classes AS (
          SELECT c, (SELECT count(*) FROM guesses WHERE label = c AND prediction = c)::double AS tp,
                 (SELECT count(*) FROM guesses WHERE label = c)::double AS actual,
                 (SELECT count(*) FROM guesses WHERE prediction = c)::double AS predicted
          FROM (SELECT DISTINCT label AS c FROM guesses))""", """
        SELECT round(sum(tp) / sum(actual), 6) AS accuracy,
               round(sum(actual * 2 * (tp / predicted) * (tp / actual) / (tp / predicted + tp / actual)) / sum(actual), 6) AS f1_score,
               round(sum(actual * tp / predicted) / sum(actual), 6) AS "precision",
               round(sum(actual * tp / actual) / sum(actual), 6) AS recall FROM classes""")),
    "eval_silhouette": (silhouette, with_(PROFILES + """, pts AS (
          SELECT usr, prediction, total_edits::double AS x, pages_edited::double AS y FROM clustered), own AS (
          SELECT a.usr, a.prediction AS mine, b.prediction AS other, count(*) AS n,
                 sum((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS total
          FROM pts a, pts b GROUP BY ALL), parts AS (
          SELECT usr, max(CASE WHEN mine = other THEN total / greatest(n - 1, 1) END) AS a,
                 min(CASE WHEN mine <> other THEN total / n END) AS b,
                 max(CASE WHEN mine = other THEN n END) AS n FROM own GROUP BY usr)""", """
        SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6)
          AS silhouette FROM parts""")),
    "skip_if_single_class": (guard, with_(CHANGED, """
        SELECT count(*) AS edits, false AS trainable FROM changed WHERE is_bot = 0""")),
    # Trained models: no SQL equivalent.
    "train_bot_model": (bot_scores, None),
    "bot_kpis": (bot_metrics, None),
    "top_features": (top_features, None),
    "feature_importances": (importances, None),
    "train_edit_type_model": (edit_type_test_rows, None),
    "score": (edit_type_predictions, None),
    "edit_type_kpis": (edit_type_scores, None),
    "train_user_clusters": (clusters, None),
    "cluster_kpis": (cluster_metrics, None),
    "cluster_centers": (centers, None),
    "gold_segmentation": (gold, None),
    "audit_models": (audit, """
        SELECT 'clusters' AS model, 'LOADED' AS status, 'KMeansModel' AS detail
        UNION ALL SELECT 'missing', 'ERROR', 'AnalysisException'"""),
    "bot_test_rows": (bot_test_rows, with_(EDITS, """
        SELECT revid, is_bot, true AS sound FROM (SELECT revid, is_bot,
          row_number() OVER (PARTITION BY is_bot ORDER BY md5(cast(revid AS varchar)), revid) AS rn,
          ceil(count(*) OVER (PARTITION BY is_bot) * 0.8::double) AS cut FROM edits) WHERE rn > cut""")),
    "edit_type_test_labels": (edit_type_labels, with_(FEATURES, f"""
        SELECT revid, label, true AS sound FROM features JOIN (
          SELECT edit_magnitude, cast(row_number() OVER (ORDER BY count(*) DESC, edit_magnitude) - 1 AS int) AS label
          FROM features GROUP BY edit_magnitude) USING (edit_magnitude) WHERE {BUCKET} >= 80""")),
    "model_report_totals": (report_totals, with_(FEATURES + """, bots AS (SELECT revid, row_number() OVER (PARTITION BY is_bot ORDER BY md5(cast(revid AS varchar)), revid) AS rn,
          ceil(count(*) OVER (PARTITION BY is_bot) * 0.8::double) AS cut FROM edits),
        profiled AS (SELECT count(*) AS n FROM (SELECT usr FROM edits GROUP BY usr HAVING count(*) >= 5))""", f"""
        SELECT 'bot rows' AS figure, count(*) AS total, true AS holds FROM bots WHERE rn > cut
        UNION ALL SELECT 'bot inputs', {len(BOT_INPUTS)}, true
        UNION ALL SELECT 'edit type rows', count(*), true FROM features WHERE {BUCKET} >= 80
        UNION ALL SELECT 'edit types guessed', count(*), true FROM features WHERE {BUCKET} >= 80
        UNION ALL SELECT 'users in clusters', n, true FROM profiled UNION ALL SELECT 'users in profiles', n, true FROM profiled""")),
    "top_feature_totals": (importance_totals(top_features), f"SELECT {len(BOT_INPUTS)} AS inputs, 0 AS negative, 1.0::double AS total FROM (SELECT count(*) FROM events)"),
    "importance_totals": (importance_totals(importances), f"SELECT {len(BOT_INPUTS)} AS inputs, 0 AS negative, 1.0::double AS total FROM (SELECT count(*) FROM events)"),
    "separable_bot_rows": (separable, with_(EDITS, """
        SELECT revid, is_bot, is_bot AS prediction FROM (SELECT revid, is_bot,
          row_number() OVER (PARTITION BY is_bot ORDER BY md5(cast(revid AS varchar)), revid) AS rn,
          ceil(count(*) OVER (PARTITION BY is_bot) * 0.8::double) AS cut FROM edits) WHERE rn > cut""")),
    "save_load_edit_type": (reloaded_edit_type, "SELECT count(*) AS edits, cast(0 AS bigint) AS changed FROM events"),
    "cluster_nearest_center": (nearest, with_(EDITS, 'SELECT usr AS "user", true AS is_nearest FROM edits GROUP BY usr HAVING count(*) >= 5')),
    "gold_segment_totals": (gold_totals, with_(EDITS, 'SELECT usr AS "user", count(*) AS edits, 1 AS segments, true AS known FROM edits GROUP BY usr')),
    "save_load_model": (stored_model, with_(PROFILES, """
        SELECT count(*) AS users, cast(0 AS bigint) AS changed FROM profiles""")),
}
