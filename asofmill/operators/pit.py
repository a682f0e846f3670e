"""The point-in-time universe: who could be held on a day, by what was known then."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import asof_join, latest_upto


@dataclass(frozen=True)
class Screen:
    """Least price, market value and mean daily dollar volume; sessions looked back, those with volume needed, and days that a quote holds."""

    # The default thresholds and the common-stock categories.
    min_price: float = 2.0
    min_mcap: float = 3e8
    min_dvol: float = 5e6
    lookback: int = 20
    min_dvol_days: int = 10
    max_quote_age: int = 10
    categories: tuple[str, ...] = ("Domestic Common Stock", "Domestic Common Stock Primary Class", "Domestic Common Stock Secondary Class")


PROFILE = ("category", "exchange", "isdelisted", "sector", "industry", "firstpricedate", "lastpricedate")
COLUMNS = ("as_of", "ticker", "category", "exchange", "isdelisted", "sector", "industry", "price", "mcap", "dvol_avg", "dvol_days", "firstpricedate", "lastpricedate")


def candidates(master: DataFrame, screen: Screen, day) -> DataFrame:
    """Stocks of the wanted categories that were not delisted before ``day``."""
    gone = F.coalesce((F.col("isdelisted") == "Y") & (F.col("lastpricedate") < day), F.lit(False))
    return master.filter((F.col("src_table") == "stocks") & F.col("category").isin(*screen.categories) & ~gone).select("ticker", *PROFILE)


def filed_shares(sf1: DataFrame) -> DataFrame:
    """ticker, date (of filing), dimension, shareswa: as-reported quarters and years."""
    return sf1.filter(F.col("dimension").isin("ARQ", "ARY")).select("ticker", "date", "dimension", "shareswa")


def _dollars(close: str = "close", volume: str = "volume"):
    """Money traded in a session, as a decimal: sums of it do not depend on their order."""
    return (F.col(close) * F.col(volume)).cast("decimal(28,6)")


def trading_days(prices: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    days = prices.select("date").distinct()
    days = days.filter(F.col("date") >= F.lit(start)) if start else days
    return days.filter(F.col("date") <= F.lit(end)) if end else days


def universe_on(prices: DataFrame, master: DataFrame, sf1: DataFrame, day: dt.date, screen: Screen = Screen()) -> DataFrame:
    """Members on one day, judged by the last quote up to it.

    The frame is lookback + 5 sessions; dollar volume is the mean over those with a price and a
    volume. Share counts are the latest filing's, null or not; of two filings of a day the later
    dimension counts.
    """
    names = candidates(master, screen, F.lit(day))
    recent = Window.partitionBy("ticker").orderBy(F.desc("date"))
    quotes = (
        prices.filter(F.col("date") <= F.lit(day))
        .join(names.select("ticker"), "ticker", "left_semi")
        .withColumn("nth", F.row_number().over(recent))
        .filter(F.col("nth") <= screen.lookback + 5)
    )
    traded = (F.col("close") != 0) & (F.col("volume") != 0)
    by = quotes.groupBy("ticker").agg(
        F.max("date").alias("last_date"),
        F.max_by("close", "date").alias("price"),
        F.sum(F.when(traded, _dollars())).alias("dollars"),
        F.count_if(traded).cast("int").alias("dvol_days"),
    )
    shares = latest_upto(filed_shares(sf1), ["ticker"], "date", F.lit(day), ["shareswa"], ["dimension"])
    rows = (
        by.join(shares, "ticker")
        .join(names, "ticker")
        .withColumn("mcap", F.col("price") * F.col("shareswa"))
        .withColumn("dvol_avg", F.coalesce(F.try_divide(F.col("dollars").cast("double"), F.col("dvol_days")), F.lit(0.0)))
        .filter(F.datediff(F.lit(day), F.col("last_date")) <= screen.max_quote_age)
        .filter((F.col("price") >= screen.min_price) & (F.col("mcap") >= screen.min_mcap) & (F.col("dvol_days") >= screen.min_dvol_days) & (F.col("dvol_avg") >= screen.min_dvol))
    )
    return rows.withColumn("as_of", F.lit(day)).select(*COLUMNS)


def valid_quotes(prices: DataFrame, master: DataFrame, sf1: DataFrame, screen: Screen = Screen(), start: dt.date | None = None) -> DataFrame:
    """Quotes that pass the screen: ticker, date, price, mcap, dvol_avg, dvol_days.

    The frame is the last ``lookback`` sessions with a close; it begins anew at ``start``.
    """
    known = prices.filter(F.col("close").isNotNull())
    known = known.filter(F.col("date") >= F.lit(start)) if start else known
    names = candidates(master, screen, F.lit(start) if start else F.lit(dt.date(1900, 1, 1)))
    quotes = known.join(names.select("ticker"), "ticker", "left_semi").select("ticker", "date", "close", "volume")
    # the share counts first: their exchange and order by ticker and date serve the rolling frame too
    known_shares = asof_join(quotes, filed_shares(sf1), ["ticker"], "date", ["shareswa"], ["dimension"])
    frame = Window.partitionBy("ticker").orderBy("date").rowsBetween(-(screen.lookback - 1), 0)
    rolled = known_shares.withColumn("dollars", F.sum(F.when(F.col("volume") > 0, _dollars())).over(frame)).withColumn("dvol_days", F.count(F.when(F.col("volume") > 0, 1)).over(frame).cast("int"))
    dvol = F.when(F.col("dvol_days") >= screen.min_dvol_days, F.try_divide(F.col("dollars").cast("double"), F.col("dvol_days"))).otherwise(F.lit(0.0))
    return (
        rolled.select("ticker", "date", F.col("close").alias("price"), (F.col("close") * F.col("shareswa")).alias("mcap"), F.coalesce(dvol, F.lit(0.0)).alias("dvol_avg"), "dvol_days")
        .filter((F.col("price") >= screen.min_price) & (F.col("mcap") >= screen.min_mcap) & (F.col("dvol_avg") >= screen.min_dvol))
    )


def validity(valid: DataFrame, master: DataFrame, screen: Screen, last_day: DataFrame) -> DataFrame:
    """valid quotes with ``until``: the last day that each stands for.

    A quote holds until the next valid one, for ``max_quote_age`` days at most. A ticker's last
    one is also bounded by its last price (or the last session), but holds its own day if it
    follows another within ``max_quote_age``.
    """
    w = Window.partitionBy("ticker").orderBy("date")
    ends = master.groupBy("ticker").agg(F.max("lastpricedate").alias("lastpricedate"))
    aged = F.date_add("date", screen.max_quote_age)
    joined = valid.withColumn("next", F.lead("date").over(w)).withColumn("before", F.lag("date").over(w)).join(ends, "ticker", "left").join(F.broadcast(last_day))
    stop = F.coalesce("lastpricedate", "last_day")
    capped = F.when(F.col("before").isNotNull() & (F.datediff("date", "before") <= screen.max_quote_age), F.greatest("date", F.least(stop, aged))).otherwise(F.least(stop, aged))
    until = F.when(F.col("next").isNotNull(), F.least(F.date_sub("next", 1), aged)).otherwise(capped)
    return joined.withColumn("until", until).drop("next", "before", "lastpricedate", "last_day")


def _names(master: DataFrame, screen: Screen, bounds: DataFrame) -> DataFrame:
    """Candidates that were not delisted before the first trading day."""
    names = candidates(master, screen, F.lit(dt.date(1900, 1, 1))).join(F.broadcast(bounds.select("first_day")))
    return names.filter(~F.coalesce((F.col("isdelisted") == "Y") & (F.col("lastpricedate") < F.col("first_day")), F.lit(False))).drop("first_day")


def _members(valid: DataFrame, master: DataFrame, screen: Screen, days: DataFrame, bounds: DataFrame) -> DataFrame:
    """The trading days that each valid quote stands for, with the ticker's profile."""
    spans = validity(valid, master, screen, bounds.select("last_day")).filter(F.col("until") >= F.col("date"))
    # profiles before the days are listed: a row for each quote meets them, not one for each day
    each = spans.join(_names(master, screen, bounds), "ticker").withColumn("as_of", F.explode(F.sequence("date", "until")))
    return each.join(F.broadcast(days.select(F.col("date").alias("as_of"))), "as_of", "left_semi").select(*COLUMNS)


def _bounds(days: DataFrame) -> DataFrame:
    return days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def universe_history(prices: DataFrame, master: DataFrame, sf1: DataFrame, screen: Screen = Screen(), start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Members on every trading day from ``start`` to ``end``.

    A member stays while its last valid quote holds; price, market value and volume are that
    quote's. One shuffle by ticker serves the rolling volume, the share counts and the spans.
    Each quote spans max_quote_age + 1 days at most, so days are listed rather than joined by
    range, and kept if they are trading days.
    """
    days = trading_days(prices, start, end)
    return _members(valid_quotes(prices, master, sf1, screen, start), master, screen, days, _bounds(days))


def affected_since(changes: DataFrame, tickers: DataFrame, screen: Screen = Screen()) -> DataFrame:
    """ticker, since: from which day on each ticker's membership has to be worked out again.

    changes: (ticker, first_day) of what was loaded; a null ticker stands for all, from a day that is new to the calendar: each
    trading day lists every member, so a new one concerns those without a change too. A quote's days end where the next one's
    begin, so a change reaches back over the days that the quote before it may hold.
    """
    first = changes.groupBy("ticker").agg(F.min("first_day").alias("first_day"))
    own = first.filter(F.col("ticker").isNotNull()).select("ticker", F.date_sub("first_day", screen.max_quote_age).alias("own"))
    every = first.filter(F.col("ticker").isNull()).agg(F.min("first_day").alias("every"))
    known = tickers.select("ticker").union(own.select("ticker")).distinct()
    return known.join(own, "ticker", "left").join(F.broadcast(every)).select("ticker", F.least("own", "every").alias("since")).filter(F.col("since").isNotNull())


def history_since(prices: DataFrame, master: DataFrame, sf1: DataFrame, since: DataFrame, screen: Screen = Screen()) -> DataFrame:
    """The rows of ``universe_history`` of the tickers in ``since`` (ticker, since), from their day on.

    Quotes are judged from two quote ages before that day, each on a whole frame: the sessions that the frame needs are
    carried along from before. Everything earlier is left alone.
    """
    days = trading_days(prices)
    begin = F.date_sub("since", 2 * screen.max_quote_age)
    quotes = prices.filter(F.col("close").isNotNull()).select("ticker", "date", "close", "volume").join(since.select("ticker", begin.alias("__begin")), "ticker")
    back = Window.partitionBy("ticker").orderBy(F.desc("date"))
    warm = F.col("date") < F.col("__begin")
    before = F.sum(warm.cast("int")).over(back)
    needed = quotes.withColumn("__before", before).filter(~warm | (F.col("__before") < screen.lookback)).drop("__begin", "__before")
    valid = valid_quotes(needed, master, sf1, screen).join(since.select("ticker", begin.alias("__begin")), "ticker").filter(F.col("date") >= F.col("__begin")).drop("__begin")
    found = _members(valid, master, screen, days, _bounds(days)).join(since, "ticker").filter(F.col("as_of") >= F.col("since"))
    return found.select(*COLUMNS)


def without_affected(history: DataFrame, since: DataFrame) -> DataFrame:
    """Rows of a history that ``history_since`` does not give anew."""
    return history.join(since, "ticker", "left").filter(F.col("since").isNull() | (F.col("as_of") < F.col("since"))).select(*history.columns)


def sessions_expected(prices: DataFrame, master: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """ticker, first, last, expected: how many sessions each ticker's life, cut to ``start`` and ``end``, spans by the calendar of all prices.

    Trading days are ranked once; every day of the calendar gets the rank of the last session up to it, so a life's sessions are
    the difference of the ranks at its ends. The calendar has a row for each day, so its size does not grow with the tickers. A life without first or
    last day is open there; one that lies outside has 0 sessions.
    """
    sessions = trading_days(prices, start, end)
    bounds = _bounds(sessions)
    listed = bounds.select(F.explode(F.sequence(F.date_sub("first_day", 1), "last_day")).alias("day")).join(sessions.select(F.col("date").alias("day"), F.lit(1).alias("open")), "day", "left")
    ranks = listed.select("day", F.count("open").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)).alias("rank"))
    lives = master.groupBy("ticker").agg(F.min(F.coalesce("firstpricedate", F.lit(dt.date(1800, 1, 1)))).alias("firstpricedate"), F.max(F.coalesce("lastpricedate", F.lit(dt.date(9999, 12, 31)))).alias("lastpricedate")).join(F.broadcast(bounds))
    lives = lives.select("ticker", F.greatest("firstpricedate", "first_day").alias("first"), F.least("lastpricedate", "last_day").alias("last"))
    at = lambda day, name: F.broadcast(ranks.select(F.col("day").alias(day), F.col("rank").alias(name)))
    ranked = lives.withColumn("__first", F.date_sub("first", 1)).join(at("__first", "before"), "__first", "left").join(at("last", "upto"), "last", "left")
    expected = F.when(F.col("first") <= F.col("last"), F.col("upto") - F.col("before")).otherwise(F.lit(0))
    return ranked.select("ticker", "first", "last", F.coalesce(expected, F.lit(0)).cast("long").alias("expected"))


def short_tickers(prices: DataFrame, expected: DataFrame, slack: int = 20) -> DataFrame:
    """ticker, expected, held: tickers with more than ``slack`` sessions fewer than ``expected`` (ticker, expected, and first and last, if given, between which sessions count)."""
    rows = prices.select("ticker", "date").distinct()
    if "first" in expected.columns:
        rows = rows.join(expected.select("ticker", "first", "last"), "ticker").filter(F.col("date").between(F.col("first"), F.col("last")))
    held = rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("held"))
    counted = expected.select("ticker", "expected").join(held, "ticker", "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long")))
    return counted.filter(F.col("held") < F.col("expected") - slack)


def spans_of(valid: DataFrame, age: int) -> DataFrame:
    """Runs of valid quotes of which none is more than ``age`` days after the one before: ticker, first, last, quotes."""
    w = Window.partitionBy("ticker").orderBy("date")
    fresh = F.coalesce(F.datediff("date", F.lag("date").over(w)) > age, F.lit(True)).cast("int")
    runs = valid.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(w))
    return runs.groupBy("ticker", "run").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count(F.lit(1)).alias("quotes")).drop("run")
