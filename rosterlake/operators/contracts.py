"""Contract checks on columns, slots, labels, keys and counts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.errors import ContractError, ReportError
from rosterlake.layout import SLOT_CODE_PREFIX, SLOT_SWITCH_PREFIX, SNAPSHOT_LABEL_PATTERN


class Slot(NamedTuple):
    """One numbered (code, switch) pair of source columns."""

    number: int
    code: str
    switch: str


def require_columns(columns: Sequence[str], required: Iterable[str], what: str) -> None:
    """V1, V3, V5: every required column is there; the error lists all that are not."""
    missing = [name for name in required if name not in columns]
    if missing:
        raise ContractError(f"{what} is missing required column(s): {', '.join(missing)}")


def taxonomy_slots(columns: Sequence[str], *, strict: bool = False) -> list[Slot]:
    """Numbered slots in numeric order, each with its switch column.

    `strict` (source headers) refuses a code column whose suffix is not a number; otherwise
    such a column is not a slot.
    """
    slots, odd, unpaired = [], [], []
    for code in columns:
        if not code.startswith(SLOT_CODE_PREFIX):
            continue
        suffix = code[len(SLOT_CODE_PREFIX) :]
        if not re.fullmatch(r"[0-9]+", suffix):
            odd.append(code)
            continue
        names = (f"{SLOT_SWITCH_PREFIX}{suffix}", f"{SLOT_SWITCH_PREFIX}{int(suffix)}")
        switch = next((name for name in names if name in columns), None)
        if switch is None:
            unpaired.append(code)
        else:
            slots.append(Slot(int(suffix), code, switch))
    if strict and odd:
        raise ContractError(f"Taxonomy column(s) without a slot number: {', '.join(odd)}")
    if unpaired:
        raise ContractError(
            f"Taxonomy column(s) without a primary-switch column: {', '.join(unpaired)}"
        )
    if not slots:
        raise ContractError(f"No '{SLOT_CODE_PREFIX}n' column was found")
    return sorted(slots)


def check_snapshot_label(label: str) -> str:
    """V10."""
    if not re.fullmatch(SNAPSHOT_LABEL_PATTERN, label):
        raise ReportError("A snapshot label may hold only letters, digits, '_' and '-'")
    return label


def key_violations(frame: DataFrame, key: str = "npi") -> DataFrame:
    """How many rows lack the key, and how many keys repeat.

    Rows are counted per key before the shuffle, so one key holding most rows is one
    partial row per task.
    """
    per_key = frame.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias(
            "missing_key_rows"
        ),
        F.count_if(F.col("k").isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
    )


def unusable_counts(report: DataFrame, keys: Iterable[str]) -> DataFrame:
    """V9: names of the counts that are absent or negative (types are the schema's concern)."""
    flags = [
        F.when(F.col(key).isNull() | (F.col(key) < 0), F.lit(key)) for key in keys
    ]
    return report.select(F.array_compact(F.array(*flags)).alias("unusable"))
