"""Collection dates: split into parts, and a validity flag."""

from __future__ import annotations

import re
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Short English month names, and the date that fills parts that a text leaves out.
MONTHS = {"jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"}
MISSING = datetime(1900, 1, 1)
WORD, SLASHED = re.compile(r"\w+"), re.compile(r"\d{1,2}/\d{1,2}/\d{2}")


def shown_parts(text: str) -> tuple[bool, bool, bool]:
    """Whether a date text shows a day (a number of one or two digits before any hyphen), an English month name, and a year of four digits.

    Texts like 5/6/21 show all three.
    """
    if SLASHED.fullmatch(text):
        return True, True, True
    digits = lambda words, *sizes: any(w.isdecimal() and len(w) in sizes for w in words)
    words = WORD.findall(text)
    return digits(WORD.findall(text.partition("-")[0]), 1, 2), not MONTHS.isdisjoint(w.lower() for w in words), digits(words, 4)


def date_parts(text: str | None) -> tuple[int | None, int | None, int | None]:
    """(day, month, year) of a free date text; a part that the text doesn't show is None, as are all if it can't be read."""
    from dateutil.parser import parse

    text = (text or "").strip()
    if not text:
        return None, None, None
    try:
        read = parse(text, default=MISSING)
    except (ValueError, OverflowError, TypeError):
        return None, None, None
    day, month, year = shown_parts(text)
    return read.day if day else None, read.month if month else None, read.year if year else None


# Types are objects here: workers import this module, where no session reads type strings.
PARTS = T.StructType([T.StructField(name, T.IntegerType()) for name in ("day", "month", "year")])


@F.pandas_udf(PARTS)
def _parts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([date_parts(t) for t in texts], columns=["day", "month", "year"]).astype("Int32")


def split_dates(df: DataFrame, column: str, prefix: str = "collection_") -> DataFrame:
    """df with day, mon and year columns. The grammar is a Python library's, so only distinct texts are read."""
    distinct = df.select(F.col(column).alias("_text")).distinct().withColumn("_parts", _parts(F.coalesce("_text", F.lit(""))))
    out = df.join(distinct, F.col(column).eqNullSafe(F.col("_text")), "left")
    named = {f"{prefix}day": F.col("_parts.day"), f"{prefix}mon": F.col("_parts.month"), f"{prefix}year": F.col("_parts.year")}
    return out.withColumns(named).drop("_text", "_parts")


def date_flag(c: Column) -> Column:
    """'Yes' for day-month-year, month-year and year with English month names, else 'NA'."""
    text = F.trim(c)
    read = [F.try_to_timestamp(text, F.lit(form)) for form in ("d-MMM-yyyy", "MMM-yyyy", "yyyy")]
    return F.when(F.coalesce(*read).isNotNull(), "Yes").otherwise("NA")
