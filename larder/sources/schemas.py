"""Explicit schemas; nothing is inferred on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from larder.config import FEATURES, FOODS, Layout

Extra = Sequence[StructField]


def document_schema(extra: Extra = (), layout: Layout = FOODS) -> StructType:
    """A nested document as it lands, without its source."""
    measurement = StructType(
        [
            StructField(layout.measure_id, IntegerType()),
            StructField(layout.measure_name, StringType()),
            StructField(layout.unit, StringType()),
            StructField(layout.value, DoubleType()),
        ]
    )
    return StructType(
        [
            StructField(layout.id, LongType()),
            *extra,
            *[StructField(name, StringType()) for name in layout.attributes],
            StructField(layout.array, ArrayType(measurement)),
        ]
    )


def raw_schema(extra: Extra = (), layout: Layout = FOODS) -> StructType:
    """A nested document in the raw table, which is partitioned by source."""
    return StructType(
        [*document_schema(extra, layout).fields, StructField(layout.source, StringType())]
    )


def labeled_schema(extra: Extra = (), layout: Layout = FOODS) -> StructType:
    """A labelled row in its table, which is partitioned by ``isHealthy``."""
    return StructType(
        [
            StructField(layout.source, StringType()),
            StructField(layout.id, LongType()),
            *extra,
            *[StructField(name, StringType()) for name in layout.attributes],
            *[StructField(name, DoubleType()) for name in FEATURES],
            StructField("healthScore", IntegerType()),
            StructField("label", DoubleType()),
            StructField("isHealthy", BooleanType()),
        ]
    )
