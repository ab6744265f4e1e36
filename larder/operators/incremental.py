"""Summaries kept up to date by snapshot date.

Of each date the table holds mergeable states: sum, count, least and largest value
of every (source, category, measurement), and the documents behind them. Adding or
replacing a date computes and swaps that date's states alone, in one commit; sums and
counts could be taken back from a running total, but a minimum could not, so
the dates stay apart. Answers merge the states, whose number does not grow with the
documents.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.config import COMPARED_IDS, FOODS, NUTRIENT_IDS, Layout
from larder.functions.nested import first_match
from larder.functions.rounding import rounded
from larder.operators.nested import zipped
from larder.sources import versions

DATE = "snapshot_date"


def measure_states(docs: DataFrame, ids: Iterable[int] = tuple(NUTRIENT_IDS.values()), layout: Layout = FOODS) -> DataFrame:
    """Mergeable states by source, category and measurement of one date's documents."""
    ids = list(ids)
    used = zipped(F.col(layout.array), (layout.measure_id, layout.measure_name, layout.value))
    first = first_match(F.col(layout.array)[layout.measure_id], ids)
    rows = (
        docs.select(layout.source, layout.category, used.alias("_used"), first.alias("_first"))
        .select(layout.source, layout.category, "_first", F.posexplode("_used").alias("_pos", "_m"))
        .where(F.col("_m")[layout.measure_id].isin(ids))
    )
    m = F.col("_m")
    value = m[layout.value]
    return rows.groupBy(
        layout.source, layout.category, m[layout.measure_id].alias(layout.measure_id), m[layout.measure_name].alias(layout.measure_name)
    ).agg(
        F.count("*").alias("n"), F.count(value).alias("n_values"), F.sum(value).alias("total"), F.min(value).alias("least"),
        F.max(value).alias("largest"), F.count_if(F.col("_pos") + 1 == F.col("_first")).alias("foods"),
    )


def state_schema(layout: Layout = FOODS) -> StructType:
    return StructType.fromDDL(
        f"{layout.source} string, {layout.category} string, {layout.measure_id} int, {layout.measure_name} string, "
        f"n long, n_values long, total double, least double, largest double, foods long, {DATE} string"
    )


def put_date(docs: DataFrame, path: str, snapshot_date: str, ids: Iterable[int] = tuple(NUTRIENT_IDS.values()), layout: Layout = FOODS) -> versions.Version:
    """Add a date's documents to the summaries, in place of those the date had."""
    spark, base = docs.sparkSession, versions.version(docs.sparkSession, path)
    states = measure_states(docs, ids, layout).withColumn(DATE, F.lit(snapshot_date))
    commit, seen = versions.stage(states, path, [DATE])
    others = [p for p in base.of() if p.value != snapshot_date]
    own = [versions.Part(commit, snapshot_date, seen["rows"])] if seen["rows"] else []
    try:
        return versions.publish(spark, path, base, [*others, *own], DATE)
    except BaseException:
        versions.discard(spark, path, commit)
        raise


def drop_date(spark: SparkSession, path: str, snapshot_date: str) -> versions.Version:
    """Take a date out of the summaries; its states alone are dropped, nothing is computed."""
    base = versions.version(spark, path)
    return versions.publish(spark, path, base, [p for p in base.of() if p.value != snapshot_date], DATE)


def scan_states(spark: SparkSession, path: str, layout: Layout = FOODS) -> DataFrame:
    return versions.read(spark, path, state_schema(layout))


def _merged(states: DataFrame, keys: Iterable[str], layout: Layout) -> DataFrame:
    return states.groupBy(*keys, layout.measure_name).agg(
        F.try_divide(F.sum("total"), F.sum("n_values")).alias("mean"), F.min("least").alias("min_value"), F.max("largest").alias("max_value"),
        F.sum("n").alias("count"), F.sum("foods").alias("foods"),
    )


def nutrition_summary(states: DataFrame, *, ties: str = "even", layout: Layout = FOODS) -> DataFrame:
    """As the query of this name over the documents of all dates: per category a list of means and counts."""
    entry = F.struct(F.col(layout.measure_name).alias("nutrient"), rounded(F.col("mean"), 2, ties).alias("avg_value"), "count")
    return (
        _merged(states, [layout.category], layout)
        .groupBy(layout.category)
        .agg(F.sort_array(F.collect_list(entry)).alias("nutrients"), F.count("*").alias("nutrient_groups"), F.sum("foods").alias("food_count"))
        .orderBy(F.desc("nutrient_groups"), F.asc_nulls_first(layout.category))
    )


def avg_nutrients_long(states: DataFrame, ids: Iterable[int] = COMPARED_IDS, *, ties: str = "even", layout: Layout = FOODS) -> DataFrame:
    """As the query of this name over the documents of all dates: mean of each measurement name per category."""
    merged = _merged(states.where(F.col(layout.measure_id).isin(list(ids))), [layout.category], layout)
    return merged.select(layout.category, F.col(layout.measure_name).alias("nutrient"), rounded(F.col("mean"), 2, ties).alias("avg_value"))


def cross_source_comparison(states: DataFrame, ids: Iterable[int] = COMPARED_IDS, layout: Layout = FOODS) -> DataFrame:
    """As the query of this name over the documents of all dates: mean, extremes and count per source."""
    merged = _merged(states.where(F.col(layout.measure_id).isin(list(ids))), [layout.source], layout)
    return merged.select(layout.source, layout.measure_name, F.col("mean").alias("avg_value"), "min_value", "max_value", "count")
