"""Tables that the checked queries share, written once per session and folder.

A pipeline lands its raw and labelled tables once and then queries them, so
the checked queries do the same: the first that needs a table writes it from
the given test tables, later ones scan it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField

from checks.food_tables import food_documents, measurement_arrays
from larder.operators.models import Trained, train_gradient_boosted_trees, train_random_forest
from larder.plans.labelling import DOCUMENT_PATH, SPARK_PATH, LabelOptions, label_foods
from larder.sources.schemas import raw_schema
from larder.sources.tables import load_raw, scan_raw, write_labeled, write_table
from larder.sources.workspace import shared_folder

COPY = (StructField("copy", IntegerType()),)
RAW_SCHEMA = raw_schema(COPY)
SNAPSHOT_DATE = "2026-03-05"

_made: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]) -> object:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def folder(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "folder", lambda: shared_folder(spark))


def new_folder(spark: SparkSession) -> str:
    """A folder for one call, so that a later call leaves this one's rows alone."""
    return shared_folder(spark)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested documents of all sources."""

    def make() -> str:
        base = folder(spark, sf_dir)
        path = f"{base}/raw_foods"
        arrays = write_table(measurement_arrays(spark, sf_dir), f"{base}/measurement_arrays")
        load_raw(food_documents(spark, sf_dir, arrays), path, allow_empty=True)
        return path

    return scan_raw(spark, once(spark, sf_dir, "raw", make), RAW_SCHEMA)


def label_now(spark: SparkSession, sf_dir: str, options: LabelOptions) -> DataFrame:
    """Labelled rows computed from the raw table."""
    return label_foods(raw_table(spark, sf_dir), options, order_by=("copy",))


def _labeled(spark: SparkSession, sf_dir: str, name: str, options: LabelOptions) -> DataFrame:
    return once(
        spark,
        sf_dir,
        name,
        lambda: write_labeled(
            label_now(spark, sf_dir, options),
            f"{folder(spark, sf_dir)}/{name}",
            rebalance=not options.shuffles,
        ),
    )


def labeled_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labeled(spark, sf_dir, "labeled_document", DOCUMENT_PATH)


def labeled_by_spark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labeled(spark, sf_dir, "labeled_spark", SPARK_PATH)


def random_forest(spark: SparkSession, sf_dir: str) -> Trained:
    return once(
        spark, sf_dir, "forest", lambda: train_random_forest(labeled_by_spark(spark, sf_dir))
    )


def boosted_trees(spark: SparkSession, sf_dir: str) -> Trained:
    return once(
        spark,
        sf_dir,
        "boosted",
        lambda: train_gradient_boosted_trees(labeled_by_spark(spark, sf_dir)),
    )
