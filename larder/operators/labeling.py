"""Score and label wide rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.config import HEALTH_RULES, HEALTHY_MIN, REQUIRED, Rule
from larder.functions.scoring import score


def label(
    wide: DataFrame,
    rules: Sequence[Rule] = HEALTH_RULES,
    *,
    required: Sequence[str] = REQUIRED,
    minimum: int = HEALTHY_MIN,
    null_compare: str = "sql",
) -> DataFrame:
    """Drop rows that miss a required column, then add ``healthScore``,
    ``isHealthy`` and the numeric ``label``."""
    if required:
        wide = wide.where(reduce(and_, [F.col(name).isNotNull() for name in required]))
    return (
        wide.withColumn("healthScore", score(rules, null_compare))
        .withColumn("isHealthy", F.col("healthScore") >= minimum)
        .withColumn("label", F.col("isHealthy").cast("double"))
    )


def label_counts(labeled: DataFrame) -> DataFrame:
    """Total, healthy and unhealthy rows, in one pass."""
    return labeled.agg(
        F.count("*").alias("total"),
        F.count_if("isHealthy").alias("healthy"),
        F.count_if(~F.col("isHealthy")).alias("unhealthy"),
    )
