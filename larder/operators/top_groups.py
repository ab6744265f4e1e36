"""The first rows of every group at once.

``row_number() <= n`` lets Spark keep a group's first rows in each task before
anything is shuffled. A group that most tasks have rows of still sends n from each of
them to one task, so groups are split by a salt first: each part keeps its first
n, and the parts' rows meet in a second, smaller step.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.config import FOODS, NUTRIENT_IDS, Layout
from larder.operators.nested import unnest

SALTS = 32


def top_per_group(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, *, rank: str = "rank", salts: int = SALTS) -> DataFrame:
    """The first ``n`` rows of each group in an order that should be total, with their rank from 1."""
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in group]), F.lit(salts))
    split = rows.withColumn("_salt", salt)
    parts = Window.partitionBy(*group, "_salt").orderBy(*order)
    kept = split.withColumn("_part_rank", F.row_number().over(parts)).where(F.col("_part_rank") <= n).drop("_part_rank", "_salt")
    return kept.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)


def top_foods_by_every_nutrient(
    docs: DataFrame, ids: Iterable[int] = tuple(NUTRIENT_IDS.values()), top_n: int = 10, layout: Layout = FOODS
) -> DataFrame:
    """The ``top_n`` measurements with the largest values of every source and measurement id, from one scan."""
    attributes = (layout.source, layout.id, layout.description, layout.category)
    rows = unnest(docs.select(*attributes, layout.array), ids, layout=layout).select(
        *attributes, layout.measure_id, layout.measure_name, layout.value, F.col(layout.unit).alias("unit")
    )
    order = [F.desc_nulls_last(layout.value), *map(F.col, (layout.id, layout.description, layout.category, layout.measure_name, "unit"))]
    return top_per_group(rows, (layout.source, layout.measure_id), order, top_n)


def best_and_worst_by_group(labeled: DataFrame, group: str = FOODS.category, n: int = 5, layout: Layout = FOODS) -> DataFrame:
    """The ``n`` healthy rows of the highest and the ``n`` unhealthy rows of the lowest score in every group."""
    rows = labeled.select(
        F.when(F.col("isHealthy"), "healthy").otherwise("unhealthy").alias("label"), F.col(group).alias("group"),
        layout.id, layout.description, "healthScore", "calories",
    )
    best_first = F.when(F.col("label") == "healthy", -F.col("healthScore")).otherwise(F.col("healthScore"))
    order = [best_first, *map(F.col, (layout.id, layout.description, "calories"))]
    return top_per_group(rows, ("label", "group"), order, n)
