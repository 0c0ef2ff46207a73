"""Splits, training, evaluation, persistence."""

import json

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from conftest import plan_of
from editpulse.ml import evaluation as EV
from editpulse.ml import models as M
from editpulse.operators import kpis as K
from editpulse.operators import sampling as SA
from editpulse.plans import edits as E
from editpulse.plans import pipeline as PL
from editpulse.sources import tables as TB


@pytest.fixture(scope="module")
def feats(spark, sf_dir):
    return E.edit_features(spark, sf_dir).cache()


def ids(df):
    return sorted(r.revid for r in df.select("revid").collect())


def test_splits_ignore_partitioning(feats):
    for fn in (lambda d: SA.split_train_test(d)[0], SA.random_sample,
               lambda d: SA.stratified_split(d, "is_bot").filter("split = 'train'"),
               lambda d: SA.balanced_sample(d, "is_bot", 50)):
        assert ids(fn(feats)) == ids(fn(feats.repartition(9)))


def test_stratified_split_is_exact(feats):
    split = SA.stratified_split(feats, "edit_magnitude")
    for r in split.groupBy("edit_magnitude").agg(
            F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("k")).collect():
        assert r.k == -(-r.n * 8 // 10)
    assert split.count() == feats.count()


@pytest.mark.parametrize("wanted", [0, 1, 37, 10_000])
def test_balanced_sample_sizes(feats, wanted):
    sizes = {r.is_bot: r["count"] for r in feats.groupBy("is_bot").count().collect()}
    got = {r.is_bot: r["count"] for r in SA.balanced_sample(feats, "is_bot", wanted).groupBy("is_bot").count().collect()}
    assert {k: got.get(k, 0) for k in sizes} == {k: min(v, wanted) for k, v in sizes.items()}


def test_many_strata_are_joined_not_broadcast(feats, monkeypatch):
    want = ids(SA.balanced_sample(feats, "page_title", 3))
    monkeypatch.setattr(SA, "MAX_BROADCAST_STRATA", 2)
    assert ids(SA.balanced_sample(feats, "page_title", 3)) == want


def test_class_weights(feats):
    n = {r.is_bot: r["count"] for r in feats.groupBy("is_bot").count().collect()}
    found = {r.is_bot: r.weight for r in SA.class_weights(feats, "is_bot").select("is_bot", "weight").distinct().collect()}
    assert found == {0: 1.0, 1: n[0] / n[1]}


def test_bot_model(spark, feats, tmp_path):
    model, pred = M.train_bot_model(feats, trees=5, depth=4)
    tables = EV.bot_kpis(model, pred)
    m = tables["metrics"].first()
    assert 0.5 <= m.auc_roc <= 1 and 0 < m.auc_pr <= 1
    for ours, theirs in (("accuracy", "accuracy"), ("f1_score", "f1"),
                         ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        want = MulticlassClassificationEvaluator(
            labelCol="is_bot", predictionCol="prediction", metricName=theirs).evaluate(pred)
        assert m[ours] == pytest.approx(want, abs=1e-9)
    top = [r.importance for r in tables["top_features"].collect()]
    assert top == sorted(top, reverse=True) and sum(top) == pytest.approx(1)
    path = str(tmp_path / "bot")
    M.save_model(model, path)
    again = M.score(M.load_model(path), pred.select("revid", "is_bot", *M.BOT_INPUTS))
    assert again.select("revid", "prediction").exceptAll(pred.select("revid", "prediction")).count() == 0
    audit = {r.model: (r.status, r.detail) for r in M.audit_models(
        spark, {"bot": path, "none": path + "x"}).collect()}
    assert audit["bot"] == ("LOADED", "RandomForestClassificationModel")
    assert audit["none"][0] == "ERROR"


def test_edit_type_model(feats):
    model, indexer, pred = M.train_edit_type_model(feats, max_iter=5)
    assert len(indexer.labels) == 3
    assert {r.label for r in pred.select("label").distinct().collect()} <= {0.0, 1.0, 2.0}
    scored = M.score(model, M.edit_type_rows(feats), indexer)
    assert scored.count() == feats.count()
    assert EV.edit_type_kpis(pred)["metrics"].first().accuracy > 0.3


def test_clusters_and_card(feats):
    model, users = M.train_user_clusters(feats, min_edits=2)
    tables = EV.cluster_kpis(model, users)
    assert -1 <= tables["metrics"].first().silhouette_score <= 1
    assert tables["sizes"].agg(F.sum("users")).first()[0] == users.count()
    assert tables["centers"].count() == 25
    card = K.summary_card(
        K.dataset_kpis(feats), clusters=tables["metrics"], reverts=K.revert_kpis(feats),
        edit_type=feats.limit(1).select(*[F.lit(0.5).alias(c) for c in ("accuracy", "f1_score", "precision", "recall")]))
    assert [r.position for r in card.collect()] == [1, 3, 4, 5]


def test_models_and_report_from_storage(spark, feats, tmp_path):
    """Models are saved, read back in the report, and all sections are in one document."""
    path = lambda n: str(tmp_path / n)
    TB.write_features(feats, path("features"))
    audit = PL.build_models(spark, path("features"), path("models"))
    assert {(r.model, r.status) for r in audit.collect()} == {("bot", "LOADED"), ("edit_type", "LOADED"), ("clusters", "LOADED")}
    PL.build_kpis(spark, path("features"), path("features"), path("kpis"), path("models"))
    document = json.loads(spark.read.text(path("kpis/document")).first().value)
    assert sorted(document) == ["bot_detection", "dataset", "edit_type", "edit_wars", "user_clustering"]
    assert document["dataset"]["dataset"][0]["total_edits"] == feats.count()
    assert sum(r["n"] for r in document["edit_type"]["confusion"]) == feats.count()
    assert 0 <= document["bot_detection"]["metrics"][0]["auc_roc"] <= 1 and document["user_clustering"]["sizes"]
    assert sorted(r.position for r in spark.read.json(path("kpis/summary_card")).collect()) == [1, 2, 3, 4, 5]
    PL.build_kpis(spark, path("features"), path("features"), path("bare"), path("nowhere"))
    assert sorted(json.loads(spark.read.text(path("bare/document")).first().value)) == ["dataset", "edit_wars"]


def test_guards(feats):
    assert M.train_bot_model(feats.filter("is_bot = 0")) is None
    assert M.train_edit_type_model(feats.filter("edit_magnitude = 'small'")) is None
    assert M.train_user_clusters(feats, min_edits=10_000) is None


def test_gold(feats):
    gold = M.gold_segmentation(feats)
    assert gold.columns == ["user", "size_bytes", "timestamp", "hour", "day", "prediction"]
    assert gold.count() == feats.count()
    assert gold.groupBy("user").agg(F.count_distinct("prediction").alias("n")).filter("n > 1").count() == 0


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


@pytest.mark.parametrize("distinct", [1, 2, 7, 100_000])
def test_areas_by_segments(spark, distinct):
    """Ties, and scores over many segments, against the evaluator's whole curve."""
    score = (F.pmod(F.xxhash64("id"), F.lit(distinct)) / distinct).alias("score")
    rows = spark.range(150_000, numPartitions=8).select((F.rand(3) < 0.2 + score * 0.5).cast("int").alias("label"), score).cache()
    for area, metric in zip(EV.binary_areas(rows, "label", "score"), ("areaUnderROC", "areaUnderPR")):
        whole = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", metricName=metric, numBins=0)
        assert area == pytest.approx(whole.evaluate(rows), abs=1e-9)
    curve = EV.score_curve(rows, "label", "score")
    last = curve.orderBy("score").first()
    assert (last.tp, last.tp + last.fp) == (rows.filter("label = 1").count(), 150_000) and curve.count() == rows.select("score").distinct().count()


def test_areas_of_odd_tables(spark):
    assert EV.binary_areas(scored(spark, []), "label", "score") == (None, None)
    assert EV.binary_areas(scored(spark, [(1, 0.5), (1, 0.7)]), "label", "score") == (1.0, 1.0)
    assert EV.binary_areas(scored(spark, [(0, 0.5), (0, 0.7)]), "label", "score") == (0.0, 0.0)
    rows = [(1, 0.9), (0, 0.1), (None, 0.5), (1, None), (0, 0.1)]
    assert EV.binary_areas(scored(spark, rows), "label", "score") == (1.0, 1.0)


def test_curve_orders_no_range_in_one_task(spark):
    plan = EV.score_curve(spark.range(10).selectExpr("1 AS label", "double(id) AS score"), "label", "score")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line and "score#" in line]
    assert windows and all("windowspecdefinition(segment#" in line for line in windows)


def test_bot_inputs_are_computed_once(spark):
    """The split, the weights, the fit and the test rows all read stored inputs."""
    from editpulse.schemas import BOT_INPUTS
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x
    pass_on = F.udf(counted, "bigint").asNondeterministic()
    rows = spark.range(400).select(F.col("id").alias("revid"), (F.col("id") % 4 == 0).cast("int").alias("is_bot"), *[
        (pass_on("id") if c == BOT_INPUTS[0] else F.col("id") % (i + 3)).alias(c) for i, c in enumerate(BOT_INPUTS)])
    model, pred = M.train_bot_model(rows, trees=3, depth=3)
    assert pred.count() == 80 and seen.value == 400
    assert model.stages[-1].getOrDefault("cacheNodeIds")


def test_rows_are_scored_in_order_of_inputs(feats):
    """Inside a task neighbours pass the same nodes; all held-out rows are scored, and no rows are shuffled for it."""
    from editpulse.schemas import BOT_INPUTS
    _, pred = M.train_bot_model(feats, trees=2, depth=2)
    held = pred.select(F.spark_partition_id().alias("task"), "revid", *BOT_INPUTS, "prediction").collect()
    keys = [(r.task, *r[2:-1]) for r in held]
    assert keys == sorted(keys) and "Exchange" not in plan_of(pred)
    split = SA.stratified_split(M.bot_rows(feats), "is_bot")
    assert sorted(r.revid for r in held) == ids(split.filter("split = 'test'"))


def test_forest_rows_are_dealt_by_id(spark, feats, monkeypatch):
    """Tasks of the forest hold even shares, in the same order wherever the rows came from."""
    seen = []
    kept = M.kept

    def watched(df, *level):
        seen.append([(r.task, r.revid) for r in df.select(F.spark_partition_id().alias("task"), "revid").collect()])
        return kept(df, *level)
    monkeypatch.setattr(M, "kept", watched)
    monkeypatch.setattr(M, "FOREST_TASK_ROWS", 90, raising=False)
    rows = M.bot_rows(feats)
    for given in (rows.repartition(1), rows.repartitionByRange(5, "user_total_edits")):
        M.train_bot_model(given, trees=2, depth=2)
    assert seen[0] == seen[1]
    sizes = {t: sum(task == t for task, _ in seen[0]) for t, _ in seen[0]}
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes) == cores * -(-len(seen[0]) // (90 * cores)) > -(-len(seen[0]) // 90) and max(sizes.values()) < 120


def test_bot_inputs_without_the_page_step(spark, sf_dir, feats):
    """The narrow features hold what the model reads, value by value, and join no page."""
    narrow = E.bot_features(spark, sf_dir)
    ours, whole = M.bot_rows(narrow), M.bot_rows(feats)
    assert ours.count() == whole.count() and ours.schema == whole.schema
    assert ours.exceptAll(whole).count() == whole.exceptAll(ours).count() == 0
    plan = ours._jdf.queryExecution().optimizedPlan().toString()
    assert "page_total_edits" not in plan and plan.count("Join") == 1
