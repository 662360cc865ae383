"""Evaluation of scored rows."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classification_metrics(
    scored: DataFrame, label: str = "low_adherence", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs."""
    pairs = scored.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    # Each pair counts once towards its true class and once towards the predicted one.
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("class"), F.col("n").alias("support"),
                         F.lit(0).cast("long").alias("predicted"), hit.alias("tp")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"),
                         F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("tp", "predicted"), zero)
    recall = F.coalesce(F.try_divide("tp", "support"), zero)
    return (
        sides.groupBy("class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum("tp").alias("tp"),
        )
        .select(
            "class",
            precision.alias("precision"),
            recall.alias("recall"),
            F.coalesce(F.try_divide(precision * recall * 2, precision + recall), zero).alias("f1"),
            "support",
        )
        .orderBy("class")
    )


def roc_auc(
    scored: DataFrame, label: str = "low_adherence", score: str = "probability"
) -> float | None:
    """Area under the ROC curve over all distinct scores; None if only one class occurs."""
    classes = scored.agg(F.count_distinct(label).alias("n")).first()["n"]
    if classes < 2:
        return None
    plain = scored.select(F.col(label).cast("double"), F.col(score).cast("double").alias("_score"))
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="_score", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(plain)


def roc_auc_frame(
    scored: DataFrame, label: str = "low_adherence", score: str = "probability"
) -> DataFrame:
    """``roc_auc`` as a one-row DataFrame."""
    value = roc_auc(scored, label, score)
    return scored.sparkSession.createDataFrame([(value,)], "roc_auc double")
