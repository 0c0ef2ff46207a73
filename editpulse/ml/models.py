"""Spark ML pipelines for bots, edit types and user segments.

Training reads only the label and the model's input columns. The input is kept
in memory and on disk while a model iterates over it, and released afterwards.
Per-user and per-page statistics are computed on all rows, so they contain the
test rows too.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.functions.scalars import iso_day, parse_timestamp
from editpulse.operators.aggregates import label_class_check, user_profiles, user_size_profile
from editpulse.operators.joins import join_cluster_labels
from editpulse.operators.sampling import class_weights, split_train_test, stratified_split
from editpulse.schemas import BOT_INPUTS, CLUSTER_INPUTS, EDIT_TYPE_INPUTS, GOLD_INPUTS
from editpulse.session import remove_stored, stored

# Rows of one task of the forest at most, about: the rows it holds carry two numbers a tree.
FOREST_TASK_ROWS = 500_000


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist for the duration of an iterative fit."""
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()


def assemble(inputs: list[str], output: str = "features_raw") -> VectorAssembler:
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep")


def scale(source: str = "features_raw", output: str = "features") -> StandardScaler:
    """Unit standard deviation, mean left in place."""
    return StandardScaler(inputCol=source, outputCol=output, withStd=True, withMean=False)


def index_label(df: DataFrame, column: str = "edit_magnitude",
                output: str = "label") -> StringIndexerModel:
    """Class numbers by falling frequency; unseen values get one extra class."""
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid="keep").fit(df)


def dealt(df: DataFrame, inputs: list[str], id_col: str = "revid") -> DataFrame:
    """Rows dealt evenly over all cores, in as many rounds of tasks as the rows need.

    Inside a task rows are ordered by inputs, so that neighbours count into the same
    nodes, which are then at hand. Task and place follow from a row's id and inputs: a
    forest, which draws its bags by task and place, draws the same ones wherever the
    rows came from, and when a lost task is repeated."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, -(-df.count() // (FOREST_TASK_ROWS * cores)))
    return df.repartition(rounds * cores, id_col).sortWithinPartitions(*inputs, id_col)


def trainable(df: DataFrame, label: str) -> bool:
    return bool(label_class_check(df, label).first().ok)


def bot_rows(features: DataFrame) -> DataFrame:
    return features.select("revid", "is_bot", *BOT_INPUTS).fillna(0)


def edit_type_rows(features: DataFrame) -> DataFrame:
    rows = features.select("revid", "edit_magnitude", *EDIT_TYPE_INPUTS).fillna(0)
    return rows.fillna("small", subset=["edit_magnitude"])


def train_bot_model(features: DataFrame, *, trees: int = 100, depth: int = 10,
                    seed: int = 42) -> tuple[PipelineModel, DataFrame] | None:
    """Random forest with class weights. Returns the model and the scored test
    rows, or None when there is only one class. The label and inputs are stored, as
    the split reads them again, and ``features`` may be lazy; so is the split, for the
    weights, the training and the test rows. The forest holds its own form of the
    training rows and reads ours only before it grows, so they wait on disk; the node
    a row has reached in each tree is held, and not written out as a checkpoint."""
    rows = stored(bot_rows(features), "bot-rows")
    if not trainable(rows, "is_bot"):
        return None
    split = stored(stratified_split(rows, "is_bot"), "bot-split")
    remove_stored(rows)
    train = class_weights(split.filter("split = 'train'"), "is_bot")
    # Neighbours by inputs pass the same nodes of the trees.
    test = split.filter("split = 'test'").withColumn("weight", F.lit(1.0)).sortWithinPartitions(*BOT_INPUTS)
    forest = RandomForestClassifier(
        labelCol="is_bot", featuresCol="features", weightCol="weight",
        numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True,
        checkpointInterval=-1)
    with kept(dealt(train, BOT_INPUTS), StorageLevel.DISK_ONLY) as held:
        model = Pipeline(stages=[assemble(BOT_INPUTS), scale(), forest]).fit(held)
    return model, model.transform(test)


def train_edit_type_model(
        features: DataFrame, *, max_iter: int = 100, reg: float = 0.01,
) -> tuple[PipelineModel, StringIndexerModel, DataFrame] | None:
    """Multinomial logistic regression over the size class of an edit."""
    rows = edit_type_rows(features)
    if not trainable(rows, "edit_magnitude"):
        return None
    indexer = index_label(rows)
    train, test = split_train_test(indexer.transform(rows))
    regression = LogisticRegression(
        labelCol="label", featuresCol="features", maxIter=max_iter, regParam=reg,
        family="multinomial")
    with kept(train) as held:
        model = Pipeline(stages=[assemble(EDIT_TYPE_INPUTS), scale(), regression]).fit(held)
    return model, indexer, model.transform(test)


def train_user_clusters(features: DataFrame, *, k: int = 5, max_iter: int = 50, seed: int = 42,
                        min_edits: int = 5) -> tuple[PipelineModel, DataFrame] | None:
    """K-means over user profiles; None with fewer users than five."""
    table = stored(user_profiles(features, min_edits), "profiles")
    with kept(table) as profiles:
        users = profiles.count()
        if users < 5:
            return None
        means = KMeans(featuresCol="features", k=min(k, users), seed=seed, maxIter=max_iter)
        model = Pipeline(stages=[assemble(CLUSTER_INPUTS), scale(), means]).fit(profiles)
    return model, model.transform(table)


def gold_rows(silver: DataFrame) -> DataFrame:
    """User, size, time, hour and day of complete rows."""
    ts = F.col("timestamp")
    if dict(silver.dtypes)["timestamp"] == "string":
        ts = parse_timestamp(ts)
    return (silver.select("user", "size_bytes", ts.alias("timestamp"))
            .withColumns({"hour": F.hour("timestamp"), "day": iso_day("timestamp")}).dropna())


def gold_segmentation(silver: DataFrame, *, k: int = 3, seed: int = 1) -> DataFrame:
    """Edits labelled with one of three user segments."""
    rows = gold_rows(silver)
    table = stored(user_size_profile(rows), "profiles")
    with kept(table) as profiles:
        means = KMeans(featuresCol="scaledFeatures", k=k, seed=seed)
        model = Pipeline(stages=[
            assemble(GOLD_INPUTS, "features"), scale("features", "scaledFeatures"), means,
        ]).fit(profiles)
    return join_cluster_labels(rows, model.transform(table))


def score(model: PipelineModel, rows: DataFrame,
          indexer: StringIndexerModel | None = None) -> DataFrame:
    """Apply a saved model; the label indexer is part of the scoring path."""
    return model.transform(indexer.transform(rows) if indexer is not None else rows)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_indexer(path: str) -> StringIndexerModel:
    return StringIndexerModel.load(path)


def audit_models(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Whether each saved model loads, and the type of its last stage."""
    rows = []
    for name, path in paths.items():
        try:
            stage = PipelineModel.load(path).stages[-1]
            rows.append((name, "LOADED", type(stage).__name__, path))
        except Exception as error:  # any unreadable model is a finding
            rows.append((name, "ERROR", type(error).__name__, path))
    return spark.createDataFrame(rows, "model string, status string, detail string, path string")
