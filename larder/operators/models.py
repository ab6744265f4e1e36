"""Train, score and compare tree ensembles on labelled rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import FEATURES, FOODS, Layout
from larder.operators.evaluation import classification_metrics
from larder.sources.workspace import ensure_checkpoints

SEED = 42
# Training passes over its rows some thousand times: from so many rows on they are dealt to all cores,
ROWS_A_TASK = 20_000
# and no task holds more than so many.
MOST_ROWS_A_TASK = 500_000


def model_features(
    labeled: DataFrame, features: Sequence[str] = FEATURES, keep: Sequence[str] = ()
) -> DataFrame:
    """Features with missing values as 0.0, the label, and columns to keep."""
    return (
        labeled.where(F.col("label").isNotNull())
        .select(*keep, *features, "label")
        .fillna(0.0, subset=list(features))
    )


def in_training(key: str = FOODS.id, percent: int = 80) -> Column:
    """Whether a row trains, decided by a hash of its key.

    Unlike a random split this does not depend on the partitioning, and all
    documents of one food stay on one side.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return bucket < percent


def split_sizes(labeled: DataFrame, key: str = FOODS.id, percent: int = 80) -> DataFrame:
    """Rows and healthy rows of the training and the test part."""
    part = F.when(in_training(key, percent), "train").otherwise("test").alias("part")
    return labeled.groupBy(part).agg(
        F.count("*").alias("rows"), F.count_if(F.col("label") == 1.0).alias("healthy_rows")
    )


def spread(rows: DataFrame, n: float) -> DataFrame:
    """``n`` rows dealt evenly to as many tasks as there are cores, or to more if a task's share is too large.

    Labelled rows are small, so that a few files, and hence a few tasks, hold millions of them. Fewer
    than ``ROWS_A_TASK`` stay as they lie.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(ceil(n / ROWS_A_TASK), cores), ceil(n / MOST_ROWS_A_TASK))
    return rows.repartition(tasks) if tasks > 1 else rows


def _fit(classifier, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, classifier]).fit(train)


def fit_random_forest(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    *,
    num_trees: int = 100,
    max_depth: int = 8,
    seed: int = SEED,
) -> PipelineModel:
    classifier = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth, seed=seed
    )
    return _fit(classifier, train, features)


def fit_gradient_boosted_trees(
    train: DataFrame,
    features: Sequence[str] = FEATURES,
    *,
    max_iter: int = 100,
    max_depth: int = 8,
    step_size: float = 0.1,
    seed: int = SEED,
) -> PipelineModel:
    ensure_checkpoints(train.sparkSession)
    classifier = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step_size,
        seed=seed,
    )
    return _fit(classifier, train, features)


@dataclass
class Trained:
    """A model with its test predictions and a (metric, value) table.

    The predictions stay persisted for the outputs made from them; call
    :meth:`release` afterwards.
    """

    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    features: Sequence[str]

    @property
    def importances(self) -> DataFrame:
        """One row per feature, most important first."""
        weights = self.model.stages[-1].featureImportances.toArray()
        rows = [(name, float(weight)) for name, weight in zip(self.features, weights)]
        spark = self.predictions.sparkSession
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.desc("importance"), "feature"
        )

    def release(self) -> None:
        self.predictions.unpersist()


@dataclass(frozen=True)
class Fitted:
    """A model, and the settings, sizes and seconds of its fit."""

    model: PipelineModel
    facts: dict[str, float]


def fit_model(
    labeled: DataFrame,
    fit: Callable[..., PipelineModel],
    settings: dict[str, float],
    *,
    features: Sequence[str] = FEATURES,
    key: str = FOODS.id,
    percent: int = 80,
) -> Fitted:
    """Fit on the training part; ``settings`` goes to ``fit`` and into the facts."""
    data = model_features(labeled, features, (key,))
    sizes = {row["part"]: row["rows"] for row in split_sizes(data, key, percent).collect()}
    start = time.time()
    model = fit(spread(data.where(in_training(key, percent)), sizes.get("train", 0)), features, **settings)
    elapsed = time.time() - start
    facts = {
        "train_time_s": round(elapsed, 2),
        "train_size": sizes.get("train", 0),
        "test_size": sizes.get("test", 0),
        **settings,
    }
    return Fitted(model, facts)


def evaluate(
    fitted: Fitted,
    labeled: DataFrame,
    *,
    features: Sequence[str] = FEATURES,
    key: str = FOODS.id,
    percent: int = 80,
    layout: Layout = FOODS,
) -> Trained:
    """Score the test part."""
    data = model_features(labeled, features, (key, layout.description, layout.category))
    # The assembled vector repeats the feature columns, so it is not kept.
    test = spread(data.where(~in_training(key, percent)), fitted.facts.get("test_size", 0))
    scored = fitted.model.transform(test).drop("features")
    predictions = scored.persist(StorageLevel.MEMORY_AND_DISK)
    # Five numbers: kept as rows, so that they outlive the persisted predictions.
    rows = [(row["metric"], row["value"]) for row in classification_metrics(predictions).collect()]
    rows += [(name, float(value)) for name, value in fitted.facts.items()]
    metrics = labeled.sparkSession.createDataFrame(rows, "metric string, value double")
    return Trained(fitted.model, predictions, metrics, features)


def train_and_evaluate(
    labeled: DataFrame,
    fit: Callable[..., PipelineModel],
    settings: dict[str, float],
    *,
    features: Sequence[str] = FEATURES,
    key: str = FOODS.id,
    percent: int = 80,
    layout: Layout = FOODS,
) -> Trained:
    """Fit on the training part and evaluate on the rest."""
    fitted = fit_model(labeled, fit, settings, features=features, key=key, percent=percent)
    return evaluate(fitted, labeled, features=features, key=key, percent=percent, layout=layout)


def train_random_forest(
    labeled: DataFrame, *, num_trees: int = 100, max_depth: int = 8, **options
) -> Trained:
    settings = {"num_trees": num_trees, "max_depth": max_depth}
    return train_and_evaluate(labeled, fit_random_forest, settings, **options)


def train_gradient_boosted_trees(
    labeled: DataFrame, *, max_iter: int = 100, max_depth: int = 8, step_size: float = 0.1, **options
) -> Trained:
    settings = {"max_iter": max_iter, "max_depth": max_depth, "step_size": step_size}
    return train_and_evaluate(labeled, fit_gradient_boosted_trees, settings, **options)


def compare_models(random_forest: DataFrame, gradient_boosted_trees: DataFrame) -> DataFrame:
    """Two (metric, value) tables side by side, null where one has no value."""
    named = {
        "random_forest": random_forest,
        "gradient_boosted_trees": gradient_boosted_trees,
    }
    stacked = None
    for model, metrics in named.items():
        rows = metrics.withColumn("model", F.lit(model))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return (
        stacked.groupBy("metric")
        .agg(*[F.max(F.when(F.col("model") == m, F.col("value"))).alias(m) for m in named])
        .orderBy("metric")
    )
