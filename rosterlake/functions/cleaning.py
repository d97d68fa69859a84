"""Text, key, ZIP and date normalisation as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.layout import DirectoryProfile

# Fixed value: every character that counts as whitespace at the ends of a field
# (Unicode White_Space plus the four ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Ten ASCII digits; five digits with an optional +4 part.
NPI_PATTERN = r"^[0-9]{10}\z"
ZIP_PATTERN = r"^([0-9]{5})(?:-?[0-9]{4})?\z"


def strip(value: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(value.cast("string"), F.lit(WHITESPACE))


def strip_tidy(value: Column) -> Column:
    """`strip` for keys and codes on hot paths.

    Such text mostly begins and ends with a visible ASCII character; two comparisons see that
    at a fraction of the cost of trimming against a set. The expression is larger, so a wide
    projection over all fields uses `strip`: its generated method must stay small enough to be
    compiled.
    """
    text = value.cast("string")
    tidy = _visible_ascii(text) & _visible_ascii(F.substring(text, -1, 1))
    return F.when(tidy, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def _visible_ascii(text: Column) -> Column:
    """The first byte lies between '!' and '~', by byte order of strings."""
    return (text >= "!") & (text < "\x7f")


def has_text(value: Column) -> Column:
    """There is something besides whitespace: the test that `clean_text` is not NULL."""
    text = value.cast("string")
    return _visible_ascii(text) | (strip(text) != "")


def clean_text(value: Column) -> Column:
    """Stripped text, with blank as NULL."""
    return F.nullif(strip(value), F.lit(""))


def clean_key(value: Column) -> Column:
    """`clean_text` for keys and codes."""
    return F.nullif(strip_tidy(value), F.lit(""))


def clean_upper(value: Column) -> Column:
    """A code in upper case, with blank as NULL."""
    return F.upper(clean_key(value))


def npi_of(text: Column) -> Column:
    """Stripped text when it is a ten-digit key, else NULL."""
    return F.when(text.rlike(NPI_PATTERN), text)


def zip_of(text: Column) -> Column:
    """First five digits of stripped text that is a ZIP or ZIP+4, else NULL."""
    return F.nullif(F.regexp_extract(text, ZIP_PATTERN, 1), F.lit(""))


def day_of(text: Column, profile: DirectoryProfile = DirectoryProfile()) -> Column:
    """The date that stripped text names, NULL when there is none or it is out of bounds.

    Each value is tested for a format's shape first, so that a parser only sees text that it
    can read; a failed parse costs far more than the test.
    """
    day = F.coalesce(
        *[
            F.when(text.rlike(shape), F.try_to_date(text, form))
            for shape, form in profile.date_formats
        ]
    )
    first, last = (F.to_date(F.lit(bound)) for bound in profile.date_bounds)
    return F.when(day.between(first, last), day)


def clean_npi(value: Column) -> Column:
    return npi_of(strip_tidy(value))


def clean_zip(value: Column) -> Column:
    return zip_of(strip(value))


def clean_date(value: Column, profile: DirectoryProfile = DirectoryProfile()) -> Column:
    """ISO day text, NULL when blank or unparseable."""
    return day_of(strip(value), profile).cast("string")
