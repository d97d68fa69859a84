"""Column functions on edge values."""

import pytest
from pyspark.sql import functions as F

from rosterlake import functions as R
from rosterlake.functions.cleaning import WHITESPACE
from tests.fixtures import text_frame

PADDED = ["", " ", "a", " a ", "\ta b\n", "\xa0x\x85", "　é ", "\x1cq\x1f", "é", "!", "~", "\x7f", None]


def apply(spark, column, values):
    frame = text_frame(spark, ["i", "v"], [(str(i), v) for i, v in enumerate(values)])
    rows = frame.select(F.col("i").cast("int").alias("i"), column(F.col("v")).alias("r")).collect()
    return [row.r for row in sorted(rows)]


def test_whitespace_is_all_that_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@pytest.mark.parametrize("function", [R.strip, R.strip_tidy])
def test_strip(spark, function):
    values = PADDED + [c + "x" + c for c in WHITESPACE] + list(WHITESPACE)
    assert apply(spark, function, values) == [v if v is None else v.strip() for v in values]


@pytest.mark.parametrize("function", [R.clean_text, R.clean_key])
def test_clean_text(spark, function):
    expected = [(v.strip() or None) if v is not None else None for v in PADDED]
    assert apply(spark, function, PADDED) == expected


def test_has_text_is_clean_text_present(spark):
    expected = [v is not None and v.strip() != "" for v in PADDED]
    assert [bool(r) for r in apply(spark, R.has_text, PADDED)] == expected


def test_clean_npi(spark):
    values = ["1234567890", " 1234567890\xa0", "123456789", "12345678901", "12345 6789", "abc", "", None]
    assert apply(spark, R.clean_npi, values) == ["1234567890", "1234567890"] + [None] * 6


def test_clean_zip(spark):
    values = ["02108", "02108-1234", "021081234", " 02108 ", "2108", "02108-12", "02108 1234", "ABCDE", "", None]
    assert apply(spark, R.clean_zip, values) == ["02108"] * 4 + [None] * 6


def test_clean_date(spark):
    values = {
        "2023-11-09": "2023-11-09",
        "11/09/2023": "2023-11-09",
        " 3/9/2023 ": "2023-03-09",
        "02/29/2024": "2024-02-29",
        "02/30/2024": None,
        "2024-13-01": None,
        "2024-2-3": None,
        "01/01/1677": None,
        "09/22/1677": "1677-09-22",
        "2262-04-11": "2262-04-11",
        "2262-04-12": None,
        "soon": None,
        "": None,
    }
    assert apply(spark, R.clean_date, list(values)) == list(values.values())


def test_comparisons_with_missing_values(spark):
    pairs = [("a", "a"), ("a", "b"), ("a", None), (None, "a"), (None, None)]
    frame = text_frame(spark, ["l", "r"], pairs)
    left, right = F.col("l"), F.col("r")
    found = frame.select(
        R.differs_or_missing(left, right), R.differs(left, right), R.is_not(left, "a")
    ).collect()
    assert [tuple(row) for row in found] == [
        (False, False, False),
        (True, True, False),
        (True, True, False),
        (True, True, True),
        (True, False, True),
    ]
