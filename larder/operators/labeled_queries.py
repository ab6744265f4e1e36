"""Queries over labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import FOODS, Layout


def _side() -> Column:
    return F.when(F.col("isHealthy"), "healthy").otherwise("unhealthy").alias("label")


def _listed(labeled: DataFrame, best_first: bool, limit: int, layout: Layout) -> DataFrame:
    fields = (layout.description, layout.category, "healthScore", "calories", layout.id)
    by_score = F.desc("healthScore") if best_first else F.asc("healthScore")
    ordered = labeled.select(*fields).orderBy(by_score, layout.id, *fields[:2], "calories")
    return ordered.limit(limit) if limit else ordered


def healthy_foods(labeled: DataFrame, limit: int = 0, layout: Layout = FOODS) -> DataFrame:
    """Healthy rows, best score first."""
    return _listed(labeled.where(F.col("isHealthy")), True, limit, layout)


def unhealthy_foods(labeled: DataFrame, limit: int = 0, layout: Layout = FOODS) -> DataFrame:
    """Unhealthy rows, worst score first."""
    return _listed(labeled.where(~F.col("isHealthy")), False, limit, layout)


def healthiest_and_least(labeled: DataFrame, n: int = 5, layout: Layout = FOODS) -> DataFrame:
    """The ``n`` best and the ``n`` worst rows over all sources."""
    fields = (layout.id, layout.description, "healthScore", "calories")

    def end(side: str, by_score: Column) -> DataFrame:
        ordered = labeled.select(*fields).orderBy(by_score, layout.id, layout.description, "calories")
        return ordered.limit(n).select(F.lit(side).alias("side"), *fields)

    return end("healthiest", F.desc("healthScore")).unionByName(
        end("least_healthy", F.asc("healthScore"))
    )


def healthy_by_category_long(labeled: DataFrame, layout: Layout = FOODS) -> DataFrame:
    """Rows per category and label."""
    return (
        labeled.groupBy(F.col(layout.category).alias("category"), _side())
        .agg(F.count("*").alias("count"))
        .orderBy("label", F.desc("count"), F.asc_nulls_first("category"))
    )


def avg_score_by_source(labeled: DataFrame, layout: Layout = FOODS) -> DataFrame:
    """Mean score and rows per label and source."""
    return (
        labeled.groupBy(_side(), layout.source)
        .agg(F.avg("healthScore").alias("avg_health_score"), F.count("*").alias("count"))
        .orderBy("label", F.desc("avg_health_score"), layout.source)
    )
