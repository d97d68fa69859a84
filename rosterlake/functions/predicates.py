"""Comparisons that say what a missing value means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_not(value: Column, wanted: str) -> Column:
    """True when the value is something else or missing."""
    return ~value.eqNullSafe(F.lit(wanted))


def differs_or_missing(left: Column, right: Column) -> Column:
    """Unequal, or at least one side missing: two missing values count as a difference."""
    return F.coalesce(left != right, F.lit(True))


def differs(left: Column, right: Column) -> Column:
    """Unequal, with two missing values taken as equal."""
    return ~left.eqNullSafe(right)
