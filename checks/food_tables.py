"""Food documents derived from the ``part`` and ``lineitem`` test tables.

Parts play the foods and line items the measurements (FIXTURES.md, section 3).
Line items are first reduced to one measurement per (part, slot, kind), seven
slots by twelve kinds, so that an array holds 84 entries at most however many
line items one part has, and a hot part shrinks before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 7
KINDS = 12

# Kind -> (measurement id, name, unit, divisor that turns a price
# into a plausible amount). Kinds 8 to 11 are all water, which no rule uses.
MEASURES = {
    0: (1008, "Energy", "KCAL", 180),
    1: (1003, "Protein", "G", 4000),
    2: (1004, "Total fat", "G", 2500),
    3: (2000, "Sugars", "G", 5000),
    4: (1093, "Sodium", "MG", 130),
    5: (1079, "Fiber", "G", 15000),
    6: (1258, "Saturated fat", "G", 10000),
    7: (1253, "Cholesterol", "MG", 500),
}
OTHER = (1051, "Water", "G", 1000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _of_kind(kind: Column, field: int) -> Column:
    entries = [MEASURES.get(number, OTHER)[field] for number in range(KINDS)]
    return F.get(F.array(*[F.lit(entry) for entry in entries]), kind)


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (part, slot, kind); ``price`` is null for an unread value."""
    unread = (F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.1)
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_partkey") % 50 != 7)
        .groupBy(
            "l_partkey",
            (F.col("l_linenumber") % SLOTS).alias("slot"),
            ((F.col("l_orderkey") + F.col("l_linenumber")) % KINDS).cast("int").alias("kind"),
        )
        .agg(F.max(F.when(unread, None).otherwise(F.col("l_extendedprice"))).alias("price"))
    )


def measurement_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One array of (position, price) per part, in order of slot and kind.

    Names and units follow from the position, so they are not shuffled.
    """
    entry = F.struct((F.col("slot") * KINDS + F.col("kind")).alias("pos"), "price")
    return (
        measurements(spark, sf_dir)
        .groupBy("l_partkey")
        .agg(F.sort_array(F.collect_list(entry)).alias("measured"))
    )


def food_documents(spark: SparkSession, sf_dir: str, arrays: DataFrame) -> DataFrame:
    """The nested documents, one row per (food, copy).

    ``arrays`` is the written table of :func:`measurement_arrays`. Joined from
    a table, both sides are plain shuffles, which lets adaptive execution split
    a part key that holds many rows.
    """
    key = F.col("p_partkey")
    survey, legacy = key % 20 < 11, key % 20 < 19
    copies = F.when(key % 40 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))

    def by_source(of_survey: str, of_legacy: str, of_foundation: str) -> Column:
        return F.when(survey, of_survey).when(legacy, of_legacy).otherwise(of_foundation)

    documents = table(spark, sf_dir, "part").select(
        key.alias("fdcId"),
        F.explode(copies).alias("copy"),
        F.col("p_name").alias("description"),
        by_source("Survey (FNDDS)", "SR Legacy", "Foundation").alias("dataType"),
        F.when(F.col("p_size") == 50, None).otherwise(F.col("p_type")).alias("foodCategory"),
        by_source("survey", "legacy", "foundation").alias("sourceCollection"),
    )
    # The second copy of a food holds the even slots only.
    held = F.when(F.col("copy") == 0, F.col("measured")).otherwise(
        F.filter("measured", lambda m: F.floor(m["pos"] / KINDS) % 2 == 0)
    )

    def measurement(entry: Column) -> Column:
        kind = entry["pos"] % KINDS
        return F.struct(
            _of_kind(kind, 0).alias("nutrientId"),
            _of_kind(kind, 1).alias("nutrientName"),
            _of_kind(kind, 2).alias("unitName"),
            (entry["price"] / _of_kind(kind, 3)).alias("value"),
        )

    measured = F.coalesce(F.transform(held, measurement), F.array())
    return documents.join(arrays, F.col("fdcId") == F.col("l_partkey"), "left").select(
        "fdcId", "copy", "description", "dataType", "foodCategory", "sourceCollection",
        measured.alias("foodNutrients"),
    )
