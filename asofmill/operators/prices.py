"""Prices as they were traded, and series adjusted for splits and dividends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_traded(bars: DataFrame, *more: str) -> DataFrame:
    """ticker, date, open, high, low, close, volume, adjustment (and the columns ``more``) from vendor bars.

    The vendor's open, high, low and close are split-adjusted; closeunadj is what was paid and
    closeadj is adjusted for dividends too. Without closeunadj, or with a close of 0, prices stay
    as they are; without closeadj or closeunadj (or with a 0) the adjustment is 1.
    """
    paid, close = F.col("closeunadj"), F.col("close")
    factor = F.when(paid.isNull() | close.isNull() | (close == 0), F.lit(1.0)).otherwise(paid / F.nullif(close, F.lit(0.0)))
    given = (F.col("closeadj") != 0) & (paid != 0)
    return bars.select(
        "ticker",
        "date",
        *[(F.col(c) * factor).alias(c) for c in ("open", "high", "low")],
        F.coalesce(paid, close).alias("close"),
        F.col("volume").cast("long").alias("volume"),
        F.when(given, F.col("closeadj") / F.nullif(paid, F.lit(0.0))).otherwise(F.lit(1.0)).alias("adjustment"),
        *more,
    )


def between(rows: DataFrame, ticker: str | None = None, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Rows of a ticker (or of all) in a range of days, both ends included and either open."""
    for given, make in ((ticker, lambda: F.col("ticker") == ticker), (start, lambda: F.col("date") >= F.lit(start)), (end, lambda: F.col("date") <= F.lit(end))):
        rows = rows.filter(make()) if given is not None else rows
    return rows


def _scaled(prices: DataFrame, scale: Column) -> DataFrame:
    factor = F.coalesce(F.col("adjustment"), F.lit(1.0)) / scale
    return prices.select("ticker", "date", *[(F.col(c) * factor).alias(c) for c in ("open", "high", "low", "close")], "volume", factor.alias("adjustment"))


def adjusted(prices: DataFrame, as_of: dt.date | None = None, missing_is_an_error: bool = True) -> DataFrame:
    """OHLC times the adjustment; with ``as_of`` rebased so that the last day up to it has its traded prices.

    A null adjustment counts as 1; volume is untouched and ``adjustment`` is the factor applied.
    A ticker without an adjustment up to ``as_of`` fails, or is left out where that is no error.
    Rows after ``as_of`` come back too. The anchor is one row per ticker.
    """
    if as_of is None:
        return _scaled(prices, F.lit(1.0))
    anchor = prices.filter(F.col("date") <= F.lit(as_of)).groupBy(F.col("ticker").alias("__ticker")).agg(F.max_by("adjustment", "date").alias("__anchor"))
    joined = prices.join(anchor, F.col("ticker") == F.col("__ticker"), "left")
    if missing_is_an_error:
        fail = F.raise_error(F.concat(F.lit(f"no adjustment up to {as_of} for "), F.col("ticker"))).cast("double")
        return _scaled(joined, F.coalesce(F.col("__anchor"), fail))
    return _scaled(joined.filter(F.col("__anchor").isNotNull()), F.col("__anchor"))


def cross_section(prices: DataFrame, day: dt.date) -> DataFrame:
    """All tickers on one day."""
    return prices.filter(F.col("date") == F.lit(day))
