"""Threshold rules as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.config import HEALTH_RULES, Rule


def point(rule: Rule, null_compare: str = "sql") -> Column:
    """1 when the rule holds, else 0.

    A value that is still missing fails every rule under ``"sql"``. Under
    ``"lowest"`` it sorts below all numbers, so it passes ``<`` rules.
    """
    if null_compare not in ("sql", "lowest"):
        raise ValueError(f"null_compare is 'sql' or 'lowest', not {null_compare!r}")
    value = F.col(rule.column)
    if rule.null_as is not None:
        value = F.coalesce(value, F.lit(float(rule.null_as)))
    bound = F.lit(float(rule.bound))
    holds = value < bound if rule.op == "<" else value > bound
    if null_compare == "lowest" and rule.op == "<" and rule.null_as is None:
        holds = value.isNull() | holds
    return F.when(holds, 1).otherwise(0)


def score(rules: Sequence[Rule] = HEALTH_RULES, null_compare: str = "sql") -> Column:
    return reduce(add, [point(rule, null_compare) for rule in rules])
