"""Source records -> Bronze: one state's rows, retained columns, source text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions import clean_upper
from rosterlake.layout import (
    POSITION,
    REQUIRED_SOURCE_COLUMNS,
    RETAINED_COLUMNS,
    STATE,
    DirectoryProfile,
)
from rosterlake.operators.contracts import require_columns, taxonomy_slots


def quoted(name: str) -> Column:
    """A column by its literal name: source names hold spaces, parentheses and periods."""
    return F.col(f"`{name}`")


def retained_columns(columns: Sequence[str]) -> list[str]:
    """The columns Bronze keeps, in source order."""
    require_columns(columns, REQUIRED_SOURCE_COLUMNS, "The source file")
    slots = taxonomy_slots(columns, strict=True)
    keep = {*RETAINED_COLUMNS, *(s.code for s in slots), *(s.switch for s in slots)}
    return [name for name in columns if name in keep]


def in_state(profile: DirectoryProfile = DirectoryProfile()) -> Column:
    """the primary practice location lies in the profile's state."""
    return clean_upper(quoted(STATE)) == profile.state


def bronze_records(source: DataFrame, profile: DirectoryProfile = DirectoryProfile()) -> DataFrame:
    """In-state records as text; a blank stays a blank, never NULL.

    Position columns ride along when the source has them.
    """
    names = retained_columns(source.columns)
    position = [name for name in POSITION if name in source.columns]
    return source.where(in_state(profile)).selectExpr(
        *[f"coalesce(string(`{name}`), '') AS `{name}`" for name in names], *position
    )
