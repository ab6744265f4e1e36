"""The six published outputs of the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.config import FEATURES, FOODS, Layout

# Names of the published outputs.
OUTPUTS = (
    "rf_model_metrics.json",
    "rf_predictions.csv",
    "gbt_model_metrics.json",
    "gbt_predictions.csv",
    "model_comparison.json",
    "query_timing.json",
)


def _one_object(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """Two columns of a handful of rows as one JSON object."""
    entries = F.sort_array(F.collect_list(F.struct(key, value)))
    return pairs.agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    _one_object(metrics, "metric", "value").coalesce(1).write.mode("overwrite").text(path)


def write_timing(timing: DataFrame, path: str) -> None:
    nested = timing.select("query", F.struct("elapsed_s").alias("timing"))
    _one_object(nested, "query", "timing").coalesce(1).write.mode("overwrite").text(path)


def write_comparison(comparison: DataFrame, path: str) -> None:
    """One object per model, metrics that a model lacks left out."""
    models = [c for c in comparison.columns if c != "metric"]
    objects = [
        F.map_from_entries(
            F.sort_array(F.collect_list(F.when(F.col(m).isNotNull(), F.struct("metric", m))))
        ).alias(m)
        for m in models
    ]
    comparison.agg(*objects).coalesce(1).write.mode("overwrite").json(path)


def prediction_rows(predictions: DataFrame, layout: Layout = FOODS) -> DataFrame:
    return predictions.select(
        layout.description, layout.category, "label", "prediction", *FEATURES
    )


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Executors write the CSV parts; nothing passes through the driver.

    Quotes inside a field are doubled, the form other CSV readers expect.
    """
    prediction_rows(predictions).write.mode("overwrite").csv(path, header=True, escape='"')


def check_outputs(spark: SparkSession, folder: str) -> list[str]:
    """Paths of all outputs; fails unless each is a committed write with data."""
    paths = [f"{folder}/{name}" for name in OUTPUTS]
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()  # readers hide the commit mark
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(settings)
        if not files.exists(place):
            raise FileNotFoundError(f"output missing: {path}")
        committed = files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"))
        if not committed or not files.getContentSummary(place).getLength():
            raise FileNotFoundError(f"output not committed or empty: {path}")
    return paths
