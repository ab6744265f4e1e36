"""All label counts from one scan: by category, by source, by label, and in all.

Rows are first added up by (category, source, label), which leaves a table as small
as its groups; the grouping sets then expand only that. ``level`` tells a set by
its ``grouping_id``, so a null category is a group of its own and not the total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import FOODS, Layout

MEANS = ("healthScore", "calories", "protein", "total_sugars")
# grouping_id has a bit for each key that is added up over, the first key's the highest.
LEVELS = {"category_label": 0b010, "category": 0b011, "source_label": 0b100, "source": 0b101, "all": 0b111}


def label_cube(labeled: DataFrame, means: tuple[str, ...] = MEANS, layout: Layout = FOODS) -> DataFrame:
    """``level category source isHealthy total healthy unhealthy`` and the mean of each measure."""
    keys = [F.col(layout.category).alias("category"), F.col(layout.source).alias("source"), F.col("isHealthy")]
    finest = labeled.groupBy(*keys).agg(
        F.count("*").alias("n"), *[f(m).alias(f"{name}_{m}") for m in means for name, f in (("sum", F.sum), ("count", F.count))]
    )
    category, source, label = (F.col(c) for c in ("category", "source", "isHealthy"))
    sets = [[category, label], [category], [source, label], [source], []]
    rolled = finest.groupingSets(sets, category, source, label).agg(
        F.grouping_id().alias("grouping"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(F.when(wanted, F.col("n"))), F.lit(0)).alias(name) for name, wanted in (("healthy", label), ("unhealthy", ~label))],
        *[F.try_divide(F.sum(f"sum_{m}"), F.sum(f"count_{m}")).alias(f"avg_{m}") for m in means],
    )
    level = F.coalesce(*[F.when(F.col("grouping") == bits, name) for name, bits in LEVELS.items()])
    return rolled.select(level.alias("level"), "category", "source", "isHealthy", "total", "healthy", "unhealthy", *[f"avg_{m}" for m in means])


def cube_results(cube: DataFrame, layout: Layout = FOODS) -> dict[str, DataFrame]:
    """The five answers that the cube holds, each in the form of the query that computes it alone."""

    def at(level: str) -> DataFrame:
        return cube.where(F.col("level") == level)

    side = F.when(F.col("isHealthy"), "healthy").otherwise("unhealthy").alias("label")

    def mean(measure: str, name: str) -> Column:
        return F.round(f"avg_{measure}", 2).alias(name)

    return {
        "healthy_by_category_long": at("category_label").select("category", side, F.col("total").alias("count")),
        "avg_score_by_source": at("source_label").select(
            side, F.col("source").alias(layout.source), F.col("avg_healthScore").alias("avg_health_score"), F.col("total").alias("count")
        ),
        "healthy_vs_unhealthy_by_category": at("category").select(
            F.col("category").alias(layout.category), F.col("healthy").alias("healthy_count"), F.col("unhealthy").alias("unhealthy_count"),
            mean("healthScore", "avg_health_score"),
        ),
        "cross_collection_comparison": at("source").select(
            F.col("source").alias(layout.source), "total", mean("calories", "avg_cal"), mean("protein", "avg_protein"),
            mean("total_sugars", "avg_sugars"), mean("healthScore", "avg_health_score"),
        ),
        "label_counts": at("all").select("total", "healthy", "unhealthy"),
    }
