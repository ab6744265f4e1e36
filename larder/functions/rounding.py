"""The two rounding modes of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, places: int = 2, ties: str = "even") -> Column:
    """Round to ``places`` digits; ``ties`` is ``"even"`` or ``"up"``."""
    if ties not in ("even", "up"):
        raise ValueError(f"ties is 'even' or 'up', not {ties!r}")
    return F.bround(value, places) if ties == "even" else F.round(value, places)
