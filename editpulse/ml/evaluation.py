"""Model metrics as one-row tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editpulse.operators.aggregates import cluster_profiles, cluster_sizes, confusion_matrix
from editpulse.operators.aggregates import value_distribution
from editpulse.session import remove_stored, stored


def multiclass_metrics(pred: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    """Accuracy, weighted F1, precision and recall from one confusion matrix.

    All four come from the same grouped counts: one pass over the predictions.
    """
    cm = confusion_matrix(pred.select(F.col(label).cast("double").alias("label"),
                                      F.col(prediction).cast("double").alias("prediction")))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = cm.select(F.explode(F.array(
        F.struct(F.col("label").alias("c"), hit.alias("tp"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted")),
    )).alias("s")).select("s.*")
    per_class = sides.groupBy("c").agg(
        F.sum("tp").alias("tp"), F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("tp", "predicted"), zero)
    recall = F.coalesce(F.try_divide("tp", "actual"), zero)
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero)

    def weighted(metric):
        return F.sum(metric * F.col("actual")) / F.sum("actual")

    return per_class.agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        weighted(f1).alias("f1_score"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"))


def _ranged_scores(pred: DataFrame, label: str, score: str) -> DataFrame:
    """Rows of each class per score, stored with the range of scores as segment."""
    if isinstance(pred.schema[score].dataType, VectorUDT):
        value = vector_to_array(score)[1]
    else:
        value = F.col(score).cast("double")
    rows = pred.select(F.col(label).cast("int").alias("y"), value.alias("score"))
    counts = rows.filter("y IS NOT NULL AND score IS NOT NULL").groupBy("score").agg(
        F.count_if(F.col("y") == 1).alias("n_pos"), F.count_if(F.col("y") != 1).alias("n_neg"))
    return stored(counts.repartitionByRange(F.desc("score")).withColumn(
        "segment", F.spark_partition_id()), "score-ranges")


def score_curve(pred: DataFrame, label: str, score: str = "rawPrediction") -> DataFrame:
    """score, n_pos, n_neg, tp, fp: every distinct score with the rows of each class
    at it, and the rows of each class at it or above it.

    Rows are counted per score, and the counts ranged by score and stored with their
    range as segment. A running sum stays inside its segment, and starts at the totals
    of the segments before it: one row per segment, and no range of scores is ever
    ordered in one task. Rows without a label or a score do not count.
    """
    return _curve(_ranged_scores(pred, label, score))


def _curve(ranged: DataFrame) -> DataFrame:
    totals = ranged.groupBy("segment").agg(F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n"))
    # One row per segment, as many as there are shuffle partitions at most.
    earlier = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("segment", *[
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("p", "n")])
    inside = Window.partitionBy("segment").orderBy(F.desc("score"))
    return ranged.join(F.broadcast(starts), "segment").select(
        "score", "n_pos", "n_neg",
        (F.col("p_before") + F.sum("n_pos").over(inside)).alias("tp"),
        (F.col("n_before") + F.sum("n_neg").over(inside)).alias("fp"))


def binary_areas(pred: DataFrame, label: str,
                 score: str = "rawPrediction") -> tuple[float | None, float | None]:
    """Areas under the ROC and precision-recall curves over all distinct scores, by
    trapezoids, from one curve. Without rows of class 1 both are 0; without rows of the
    other class both are 1; without rows there are none."""
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    tp0, fp0 = tp - F.col("n_pos"), fp - F.col("n_neg")
    precision = tp / (tp + fp)
    before = F.coalesce(F.try_divide(tp0, tp0 + fp0), precision)
    ranged = _ranged_scores(pred, label, score)
    r = _curve(ranged).agg(
        F.sum((fp - fp0) * (tp + tp0) / 2).alias("roc"), F.sum((tp - tp0) * (precision + before) / 2).alias("pr"),
        F.sum("n_pos").alias("p"), F.sum("n_neg").alias("n")).first()
    remove_stored(ranged)
    if r.p is None:
        return None, None
    if not r.p or not r.n:
        return (1.0, 1.0) if r.p else (0.0, 0.0)
    return r.roc / r.p / r.n, r.pr / r.p


def silhouette(clustered: DataFrame, features: str = "scaledFeatures",
               prediction: str = "prediction") -> float:
    """In the space the model was trained in: scaled, where that is given."""
    if features not in clustered.columns:
        features = "features"
    return ClusteringEvaluator(
        featuresCol=features, predictionCol=prediction, metricName="silhouette",
    ).evaluate(clustered)


def feature_importances(model: PipelineModel, n: int | None = 10) -> DataFrame:
    """Input columns by importance; as many rows as the model has inputs."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray().tolist()
    table = SparkSession.active().createDataFrame(
        list(zip(names, values)), "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked if n is None else ranked.limit(n)


def cluster_centers(model: PipelineModel) -> DataFrame:
    """Coordinates of each centre in the scaled feature space."""
    names = model.stages[0].getInputCols()
    rows = [(i, n, float(v)) for i, c in enumerate(model.stages[-1].clusterCenters())
            for n, v in zip(names, c)]
    return SparkSession.active().createDataFrame(rows, "cluster int, feature string, value double")


def bot_kpis(model: PipelineModel, pred: DataFrame, label: str = "is_bot") -> dict[str, DataFrame]:
    # Scored once; areas and counts read the stored scores.
    pred = stored(pred.select(label, "rawPrediction", "prediction"), "predictions")
    roc, pr = binary_areas(pred, label)
    return {
        "metrics": multiclass_metrics(pred, label).withColumns(
            {"auc_roc": F.lit(roc), "auc_pr": F.lit(pr)}),
        "confusion": confusion_matrix(pred, label),
        "top_features": feature_importances(model),
    }


def edit_type_kpis(pred: DataFrame) -> dict[str, DataFrame]:
    pred = stored(pred.select("label", "prediction"), "predictions")
    return {
        "metrics": multiclass_metrics(pred),
        "confusion": confusion_matrix(pred),
        "predicted": value_distribution(pred, "prediction"),
    }


def cluster_kpis(model: PipelineModel, clustered: DataFrame) -> dict[str, DataFrame]:
    clustered = stored(clustered, "clustered")
    k = len(model.stages[-1].clusterCenters())
    metrics = SparkSession.active().createDataFrame(
        [(silhouette(clustered), k)], "silhouette_score double, num_clusters int")
    return {
        "metrics": metrics,
        "sizes": cluster_sizes(clustered),
        "profiles": cluster_profiles(clustered),
        "centers": cluster_centers(model),
    }
