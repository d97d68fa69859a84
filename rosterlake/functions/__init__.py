"""Column functions."""

from rosterlake.functions.cleaning import (
    clean_date,
    clean_key,
    clean_npi,
    clean_text,
    clean_upper,
    clean_zip,
    day_of,
    has_text,
    npi_of,
    strip,
    strip_tidy,
    zip_of,
)
from rosterlake.functions.predicates import differs, differs_or_missing, is_not

__all__ = [
    "clean_date",
    "clean_key",
    "clean_npi",
    "clean_text",
    "clean_upper",
    "clean_zip",
    "day_of",
    "differs",
    "differs_or_missing",
    "has_text",
    "is_not",
    "npi_of",
    "strip",
    "strip_tidy",
    "zip_of",
]
