"""Column expressions that turn vendor text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for a missing number in vendor tables, and in factor files.
MISSING = ("", "N/A")
FACTOR_MISSING = ("", "-99.99", "-999", "-99.00")
#: Texts, in lower case, that say that there is no value: not counted as unreadable.
NOTHING = ("", "n/a", "nan", "null", "none")


def number(text: Column) -> Column:
    """Double, or null where the text is missing, no number, or NaN."""
    value = F.trim(text.cast("string")).try_cast("double")
    return F.when(text.isin(*MISSING) | F.isnan(value), None).otherwise(value)


def factor_number(text: Column) -> Column:
    """As ``number``, for factor files, whose gaps are coded as numbers."""
    value = F.trim(text)
    return F.when(value.isin(*FACTOR_MISSING), None).otherwise(value.try_cast("double"))


def filled(text: Column) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(text, F.lit(""))


def iso_date(text: Column) -> Column:
    return text.try_cast("date")


def compact_date(text: Column) -> Column:
    """Date from YYYYMMDD."""
    return F.to_date(F.try_to_timestamp(F.trim(text), F.lit("yyyyMMdd")))


def share(part: Column, whole: Column) -> Column:
    """part / whole; null if either is null or whole is 0."""
    return F.try_divide(part, whole)


def first_nonzero(*values: Column) -> Column:
    """The first value that is neither null nor 0, else the last one."""
    return F.coalesce(*[F.nullif(v, F.lit(0.0)) for v in values[:-1]], values[-1])


def cik(value: Column) -> Column:
    """Ten digits with leading zeros."""
    return F.lpad(value.cast("string"), 10, "0")
