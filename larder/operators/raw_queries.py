"""Queries over the nested raw documents.

Every limit comes with a total order over the returned columns, so that a
result does not depend on how the rows were partitioned.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.config import COMPARED_IDS, FOODS, NUTRIENT_IDS, Layout
from larder.functions.nested import first_match
from larder.functions.rounding import rounded
from larder.operators.nested import unnest, zipped


def of_source(docs: DataFrame, source: str, layout: Layout = FOODS) -> DataFrame:
    """The documents of one source; prunes partitions on a raw table."""
    return docs.where(F.col(layout.source) == source)


def all_foods(docs: DataFrame, limit: int = 0, layout: Layout = FOODS) -> DataFrame:
    """Listed fields of every document, or of the first ``limit`` by id."""
    listed = docs.select(layout.id, layout.description, layout.category, layout.kind)
    return listed.orderBy(*listed.columns).limit(limit) if limit else listed


def foods_by_category(docs: DataFrame, category: str, layout: Layout = FOODS) -> DataFrame:
    return docs.where(F.col(layout.category) == category).select(
        layout.id, layout.description, layout.category
    )


def count_foods_by_category(docs: DataFrame, layout: Layout = FOODS) -> DataFrame:
    return (
        docs.groupBy(layout.category)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.asc_nulls_first(layout.category))
    )


def nutrition_summary(
    docs: DataFrame,
    ids: Iterable[int] = tuple(NUTRIENT_IDS.values()),
    *,
    ties: str = "even",
    layout: Layout = FOODS,
) -> DataFrame:
    """Per category, the mean and count of each measurement name as a list.

    ``nutrient_groups`` counts the names listed, ``food_count`` the documents
    behind them. A document is counted on its first wanted measurement, so one
    pass over the unnested rows gives both. A list has one entry per name of
    the wanted ids, however many documents there are.
    """
    ids = list(ids)
    # The first match is found in its own step: next to the generator it would
    # be evaluated once per measurement.
    first = first_match(F.col(layout.array)[layout.measure_id], ids)
    used = zipped(F.col(layout.array), _used(layout))
    rows = (
        docs.select(layout.category, used.alias("_used"), first.alias("_first"))
        .select(layout.category, "_first", F.posexplode("_used").alias("_pos", "_m"))
        .where(F.col("_m")[layout.measure_id].isin(ids))
    )
    per_name = rows.groupBy(
        layout.category, F.col("_m")[layout.measure_name].alias("nutrient")
    ).agg(
        F.avg(F.col("_m")[layout.value]).alias("mean"),
        F.count("*").alias("count"),
        F.count_if(F.col("_pos") + 1 == F.col("_first")).alias("foods"),
    )
    entry = F.struct("nutrient", rounded(F.col("mean"), 2, ties).alias("avg_value"), "count")
    return (
        per_name.groupBy(layout.category)
        .agg(
            F.sort_array(F.collect_list(entry)).alias("nutrients"),
            F.count("*").alias("nutrient_groups"),
            F.sum("foods").alias("food_count"),
        )
        .orderBy(F.desc("nutrient_groups"), F.asc_nulls_first(layout.category))
    )


def nutrition_summary_long(summary: DataFrame, layout: Layout = FOODS) -> DataFrame:
    """The listed measurements of :func:`nutrition_summary` as rows."""
    return summary.select(
        layout.category, F.inline("nutrients"), "nutrient_groups", "food_count"
    )


def _used(layout: Layout) -> tuple[str, ...]:
    return layout.measure_id, layout.measure_name, layout.value


def _means(docs: DataFrame, ids: Iterable[int], ties: str, layout: Layout) -> DataFrame:
    return (
        unnest(docs.select(layout.category, layout.array), ids, fields=_used(layout), layout=layout)
        .groupBy(layout.category, F.col(layout.measure_name).alias("nutrient"))
        .agg(rounded(F.avg(layout.value), 2, ties).alias("avg_value"))
    )


def avg_nutrients_long(
    docs: DataFrame,
    ids: Iterable[int] = COMPARED_IDS,
    *,
    ties: str = "even",
    layout: Layout = FOODS,
) -> DataFrame:
    """Mean of each measurement name per category, one row each."""
    return _means(docs, ids, ties, layout).orderBy(F.asc_nulls_first(layout.category), "nutrient")


def avg_nutrients_by_category(
    docs: DataFrame,
    ids: Iterable[int] = COMPARED_IDS,
    *,
    ties: str = "even",
    layout: Layout = FOODS,
) -> DataFrame:
    """Mean of each measurement name per category, as a list per category."""
    return (
        _means(docs, ids, ties, layout)
        .groupBy(layout.category)
        .agg(F.sort_array(F.collect_list(F.struct("nutrient", "avg_value"))).alias("nutrients"))
        .orderBy(F.asc_nulls_first(layout.category))
    )


def cross_source_comparison(
    docs: DataFrame, ids: Iterable[int] = COMPARED_IDS, layout: Layout = FOODS
) -> DataFrame:
    """Mean, extremes and count of each measurement name per source."""
    return (
        unnest(docs.select(layout.source, layout.array), ids, fields=_used(layout), layout=layout)
        .groupBy(layout.source, layout.measure_name)
        .agg(
            F.avg(layout.value).alias("avg_value"),
            F.min(layout.value).alias("min_value"),
            F.max(layout.value).alias("max_value"),
            F.count("*").alias("count"),
        )
        .orderBy(layout.source, layout.measure_name)
    )


def top_foods_by_nutrient(
    docs: DataFrame, nutrient_id: int, top_n: int = 10, layout: Layout = FOODS
) -> DataFrame:
    """The ``top_n`` measurements of one id with the largest values."""
    rows = unnest(
        docs.select(layout.id, layout.description, layout.category, layout.array),
        [nutrient_id],
        layout=layout,
    ).select(
        layout.id,
        layout.description,
        layout.category,
        layout.measure_name,
        layout.value,
        F.col(layout.unit).alias("unit"),
    )
    return rows.orderBy(
        F.desc_nulls_last(layout.value),
        layout.id,
        layout.description,
        layout.category,
        layout.measure_name,
        "unit",
    ).limit(top_n)
