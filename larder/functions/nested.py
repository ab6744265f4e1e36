"""Look measurements up in an array by their id.

Higher-order functions run interpreted, outside generated code, and measured
two to three times slower here, so measurements are found by position.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.config import FOODS, Layout


def first_match(ids: Column, wanted: Iterable[int]) -> Column:
    """1-based position of the first wanted id in an array, null without one."""
    places = [F.array_position(ids, key) for key in wanted]
    return F.array_min(F.array(*[F.when(place > 0, place) for place in places]))


def repeats_resolved(
    docs: DataFrame, dup: str, missing_value: float | None, layout: Layout = FOODS
) -> DataFrame:
    """Replace the array by parallel arrays ``_ids`` and ``_values`` in which
    the entry to use comes first among those of its id.

    ``dup="max"`` puts the largest value of a repeated id first, ``"last"`` the
    entry nearest to the end of the array.
    """
    others = [c for c in docs.columns if c != layout.array]
    ids = F.col(layout.array)[layout.measure_id]
    values = F.col(layout.array)[layout.value]
    if dup == "last":
        return docs.select(*others, F.reverse(ids).alias("_ids"), F.reverse(values).alias("_values"))
    if dup == "max":
        if missing_value is not None:
            values = F.transform(values, lambda v: F.coalesce(v, F.lit(missing_value)))
        pairs = F.sort_array(F.arrays_zip(ids.alias("id"), values.alias("value")), asc=False)
        return docs.select(*others, pairs.alias("_pairs")).select(
            *others, F.col("_pairs.id").alias("_ids"), F.col("_pairs.value").alias("_values")
        )
    raise ValueError(f"dup is 'max' or 'last', not {dup!r}")


def lookups(measures: Mapping[str, int], missing_value: float | None) -> list[Column]:
    """One column per measure: the value at the first position of its id.

    The expressions are kept short. A generated method over 8000 bytes is no
    longer compiled by the JVM, which made the labelling twenty times slower.
    """
    columns = []
    for name, key in measures.items():
        place = F.array_position("_ids", key)
        # An absent id has place 0, and index -1 gives null.
        value = F.get("_values", (place - 1).cast("int"))
        if missing_value is not None:
            value = F.when(place > 0, F.coalesce(value, F.lit(missing_value)))
        columns.append(value.alias(name))
    return columns
