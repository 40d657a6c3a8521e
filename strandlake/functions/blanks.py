"""What counts as blank. The catalogue's steps differ on purpose, so each rule has its own function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that stand for a missing number.
NUMBER_BLANKS = ["", "nan", "none", "na", "n/a", "-", "null"]
# Tokens that a curated value must not be.
CURATION_BLANKS = ["-", "na", "n/a", "NA", "Na", "N/A"]
# Tokens that reports leave out.
REPORT_BLANKS = ["", "NA", "Na", "N/A", "na", "n/a", "-", "None"]


def blank_number(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(NUMBER_BLANKS)


def blank_in_curation(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "") | F.trim(c).isin(CURATION_BLANKS) | F.lower(F.trim(c)).isin("na", "n/a")


def empty_after_trim(c: Column) -> Column:
    """'NA' is a value here."""
    return c.isNull() | (F.trim(c) == "")


def empty(c: Column) -> Column:
    """'NA' and a blank are values here."""
    return c.isNull() | (c == "")


def blank_in_report(c: Column) -> Column:
    return c.isNull() | F.trim(c).isin(REPORT_BLANKS)


def blank_taxon(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "") | (F.upper(F.trim(c)) == "NA")


def nullable_integer(c: Column) -> Column:
    """A whole number, or null for blanks, text and numbers with a fraction."""
    number = F.trim(c).try_cast("double")
    return F.when(~blank_number(c) & (number == F.floor(number)), number.try_cast("bigint"))


def integer_or(c: Column, default: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("bigint"), default)


def float_or(c: Column, default: float) -> Column:
    return F.coalesce(F.trim(c).try_cast("double"), F.lit(default))


def key_value(c: Column, is_string: bool) -> Column:
    """A key for comparing: strings are trimmed and null is the empty string; other types stay as they are."""
    return F.coalesce(F.trim(c), F.lit("")) if is_string else c
