"""Quality of a binary classifier's scored rows."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, class-weighted precision, recall and F1 as one row.

    One aggregation over the scored rows; the rest works on one row per pair
    of label and prediction.
    """
    cells = scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))
    n, none = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    classes = (
        cells.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("label").alias("class"),
                        n.alias("truth"),
                        none.alias("predicted"),
                        hit.alias("hits"),
                    ),
                    F.struct(
                        F.col("prediction").alias("class"),
                        none.alias("truth"),
                        n.alias("predicted"),
                        none.alias("hits"),
                    ),
                )
            )
        )
        .groupBy("class")
        .agg(F.sum("truth").alias("truth"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "truth"), F.lit(0.0))
    f1 = F.coalesce(
        F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0)
    )

    def weighted(value: str):
        return F.sum(F.col(value) * F.col("truth")) / F.sum("truth")

    return (
        classes.withColumn("p", precision)
        .withColumn("r", recall)
        .withColumn("f", f1)
        .agg(
            (F.sum("hits") / F.sum("truth")).alias("accuracy"),
            weighted("p").alias("precision"),
            weighted("r").alias("recall"),
            weighted("f").alias("f1"),
        )
    )


def classification_metrics(
    scored: DataFrame, places: int = 4, num_bins: int = 0
) -> DataFrame:
    """Five rounded metrics of ``label``, ``prediction`` and ``rawPrediction``.

    The area under the curve is exact: 0 bins keep every distinct score. A
    positive ``num_bins`` merges neighbouring scores where there are more.
    """
    auc = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", numBins=num_bins
    ).evaluate(scored)
    return (
        confusion_metrics(scored)
        .withColumn("auc", F.lit(auc))
        .unpivot([], ["accuracy", "precision", "recall", "f1", "auc"], "metric", "value")
        .select("metric", F.round("value", places).alias("value"))
    )
