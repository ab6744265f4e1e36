"""Named queries over labelled rows, and their timing.

The catalogue's own queries are functions of a DataFrame and named bounds. A
caller may add SQL texts that say ``{foods}`` for the labelled rows and
``:name`` for a bound. No query leaves a view behind, so two labelled sets can
be used side by side.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.config import FOODS

CATEGORY, SOURCE = FOODS.category, FOODS.source
Bounds = Mapping[str, float]
Query = Callable[[DataFrame, Bounds], DataFrame] | str

# Names of the queries' results and their columns, bounds and limits.
BOUNDS: dict[str, float] = {"limit": 10, "least_protein": 20, "most_fat": 5}
CATEGORY_MEANS = {"avg_calories": "calories", "avg_protein": "protein", "avg_fat": "total_fat", "avg_sugars": "total_sugars"}
SOURCE_MEANS = {"avg_cal": "calories", "avg_protein": "protein", "avg_sugars": "total_sugars", "avg_health_score": "healthScore"}
CALORIE_COLUMNS = ("description", CATEGORY, "calories", "protein", "total_fat")
PROTEIN_COLUMNS = ("description", CATEGORY, "protein", "total_fat", "calories")


def _means(columns: Mapping[str, str]) -> list[F.Column]:
    return [F.round(F.avg(column), 2).alias(name) for name, column in columns.items()]


def _by_category(result: DataFrame, first: str) -> DataFrame:
    return result.orderBy(F.desc(first), F.asc_nulls_first(CATEGORY))


def _largest(rows: DataFrame, column: str, columns: tuple[str, ...], bounds: Bounds) -> DataFrame:
    """Rows with the largest values; all returned columns break ties, so these cannot change the result."""
    others = [c for c in columns if c not in ("description", column)]
    order = [F.desc_nulls_last(column), FOODS.id, "description", *others]
    return rows.orderBy(*order).select(*columns).limit(int(bounds["limit"]))


def count_by_category(foods: DataFrame, bounds: Bounds) -> DataFrame:
    return _by_category(foods.groupBy(CATEGORY).agg(F.count("*").alias("count")), "count")


def avg_nutrients_by_category(foods: DataFrame, bounds: Bounds) -> DataFrame:
    return _by_category(foods.groupBy(CATEGORY).agg(*_means(CATEGORY_MEANS)), "avg_calories")


def highest_calorie(foods: DataFrame, bounds: Bounds) -> DataFrame:
    return _largest(foods, "calories", CALORIE_COLUMNS, bounds)


def healthy_by_category(foods: DataFrame, bounds: Bounds) -> DataFrame:
    counts = [
        F.count_if(wanted).alias(name)
        for name, wanted in (("healthy_count", F.col("isHealthy")), ("unhealthy_count", ~F.col("isHealthy")))
    ]
    result = foods.groupBy(CATEGORY).agg(*counts, *_means({"avg_health_score": "healthScore"}))
    return _by_category(result, "avg_health_score")


def by_source(foods: DataFrame, bounds: Bounds) -> DataFrame:
    return foods.groupBy(SOURCE).agg(F.count("*").alias("total"), *_means(SOURCE_MEANS))


def protein_without_fat(foods: DataFrame, bounds: Bounds) -> DataFrame:
    wanted = (F.col("protein") > bounds["least_protein"]) & (F.col("total_fat") < bounds["most_fat"])
    return _largest(foods.where(wanted), "protein", PROTEIN_COLUMNS, bounds)


CATALOG: dict[str, Query] = {
    "count_by_category": count_by_category,
    "avg_nutrients_by_category": avg_nutrients_by_category,
    "top_10_highest_calorie": highest_calorie,
    "healthy_vs_unhealthy_by_category": healthy_by_category,
    "cross_collection_comparison": by_source,
    "high_protein_low_fat": protein_without_fat,
}


def run_catalog(
    spark: SparkSession,
    labeled: DataFrame,
    catalog: Mapping[str, Query] = CATALOG,
    bounds: Bounds = BOUNDS,
) -> dict[str, DataFrame]:
    """Each query's result over these labelled rows, not yet computed."""
    bounds = {**BOUNDS, **bounds}

    def result(query: Query) -> DataFrame:
        if callable(query):
            return query(labeled, bounds)
        return spark.sql(query, args={k: v for k, v in bounds.items() if f":{k}" in query}, foods=labeled)

    return {name: result(query) for name, query in catalog.items()}


def time_queries(spark: SparkSession, results: Mapping[str, DataFrame]) -> DataFrame:
    """Run each query once, discarding its rows, and report the seconds."""
    seconds = []
    for name, result in results.items():
        start = time.time()
        result.write.format("noop").mode("overwrite").save()
        seconds.append((name, round(time.time() - start, 4)))
    return spark.createDataFrame(seconds, "query string, elapsed_s double")
