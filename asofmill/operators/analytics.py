"""Coverage, quality, distribution and tear-sheet queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import shared_folder
from .selection import medians
from .writes import aside, kept


def coverage(tables: dict[str, tuple[DataFrame, str | None]], distinct: str | None = None) -> DataFrame:
    """name, n_rows, first_date, last_date of several tables; each comes with its date column, or none. Also how many different values of ``distinct`` each has, if given (null where it has no such column)."""
    parts = []
    for name, (rows, day) in tables.items():
        ends = (F.min(day), F.max(day)) if day else (F.lit(None), F.lit(None))
        more = [(F.count_distinct(distinct) if distinct in rows.columns else F.lit(None)).cast("long").alias(f"n_{distinct}")] if distinct else []
        parts.append(rows.agg(F.count(F.lit(1)).alias("n_rows"), *more, ends[0].cast("date").alias("first_date"), ends[1].cast("date").alias("last_date")).select(F.lit(name).alias("name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def counts(rows: DataFrame, by: list[str], distinct: str | None = None) -> DataFrame:
    """Rows, and different values of ``distinct``, in each group."""
    more = [F.count_distinct(distinct).alias(f"n_{distinct}")] if distinct else []
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *more)


def flag_counts(rows: DataFrame, flags: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """How many rows (of each group) have each flag, and how many there are."""
    return rows.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(v).alias(k) for k, v in flags.items()])


def is_missing(column: str) -> Column:
    """Null, or an empty text."""
    return F.col(column).isNull() | (F.col(column).cast("string") == "")


def null_counts(rows: DataFrame, columns: list[str], empty_is_null: bool = False) -> DataFrame:
    """column, n_missing, n_rows: one pass over the table."""
    missing = lambda c: is_missing(c) if empty_is_null else F.col(c).isNull()
    one = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(missing(c)).alias(c) for c in columns])
    return one.unpivot(["n_rows"], columns, "column", "n_missing").select("column", "n_missing", "n_rows")


def absent(rows: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Keys of ``rows`` that ``other`` has not."""
    return rows.select(key).distinct().join(other.select(F.col(other_key).alias("__key")).distinct(), F.col(key) == F.col("__key"), "left_anti")


def full_span(rows: DataFrame, key: str, first: dt.date, last: dt.date) -> DataFrame:
    """Keys whose rows begin on or before ``first`` and end on or after ``last``."""
    return rows.groupBy(key).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date")).filter((F.col("first_date") <= F.lit(first)) & (F.col("last_date") >= F.lit(last)))


def mean_days(rows: DataFrame, key: str) -> DataFrame:
    """Whole part of the mean, over keys, of their numbers of different days."""
    return rows.groupBy(key).agg(F.count_distinct("date").alias("d")).agg(F.avg("d").cast("int").alias("mean_days"))


def median_by(rows: DataFrame, by: str, value: str) -> DataFrame:
    """n, exact median and sum (of whole units) of a value in each group. No group is gathered anywhere: the median is selected by histograms.

    The rows are worked out once, whatever they are made of.
    """
    folder = shared_folder(rows.sparkSession)
    with aside(rows.select(by, value), folder) as held:
        with_n = kept(held.groupBy(F.col(by).alias("__by")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(28,0)")).cast("double").alias("total")), folder)
        middle = medians(held, by, value).select(by, "median")
    return with_n.join(middle, F.col("__by").eqNullSafe(F.col(by)), "left").select(F.col("__by").alias(by), "n", "median", "total")


def pivot_counts(rows: DataFrame, by: str, kind: str, kinds: list[str]) -> DataFrame:
    """Rows by ``by``, with a column for each kind; 0 where there are none."""
    return rows.groupBy(by).pivot(kind, kinds).agg(F.count(F.lit(1))).na.fill(0, kinds)


def bucket(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval (edge, next edge] that holds the value; null outside."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        out = F.when((value > low) & (value <= high), label).otherwise(out)
    return out


def magnitude(value: Column) -> Column:
    """Decimal logarithm of a positive value; null for others."""
    return F.when(value > 0, F.log10(value))


def shortened(text: Column, most: int = 150) -> Column:
    """The first characters of a description."""
    return F.substring(text, 1, most)


def with_share(rows: DataFrame, value: str, name: str = "share") -> DataFrame:
    """rows with each one's part of the total. The rows are one per group, not per record."""
    return rows.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy()))


def threshold_counts(rows: DataFrame, value: str, thresholds: list[float]) -> DataFrame:
    """For each threshold: rows at or above it, and the sum of their values in whole units; one pass."""
    one = rows.agg(*[F.struct(F.count_if(F.col(value) >= t).alias("n"), F.sum(F.when(F.col(value) >= t, F.col(value).cast("decimal(28,0)"))).cast("double").alias("total")).alias(f"t{i}") for i, t in enumerate(thresholds)])
    each = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}.n").alias("n"), F.col(f"t{i}.total").alias("total")) for i, t in enumerate(thresholds)])
    return one.select(F.inline(each))


def top(rows: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows in ``order`` (names are descending)."""
    return rows.orderBy(*[F.desc(c) if isinstance(c, str) else c for c in order]).limit(k)


def split_days(prices: DataFrame, up: float = 1.9, down: float = 0.52) -> DataFrame:
    """Days on which the adjustment jumps as a split makes it: ticker, date, step."""
    w = Window.partitionBy("ticker").orderBy("date")
    return prices.withColumn("step", F.try_divide(F.col("adjustment"), F.lag("adjustment").over(w))).filter((F.col("step") > up) | (F.col("step") < down)).select("ticker", "date", "step")


def max_drawdown(prices: DataFrame, since: dt.date | None = None) -> DataFrame:
    """ticker, drawdown: the deepest fall of the close below its highest so far (0 or less)."""
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    rows = prices.filter(F.col("date") >= F.lit(since)) if since else prices
    return rows.withColumn("fall", F.try_divide(F.col("close"), F.max("close").over(w)) - 1).groupBy("ticker").agg(F.min("fall").alias("drawdown"))


def trailing_returns(prices: DataFrame, as_of: dt.date, windows: dict[str, dt.date]) -> DataFrame:
    """ticker and, for each window, the return from its first close to the last; one pass."""
    rows = prices.filter((F.col("date") <= F.lit(as_of)) & (F.col("date") >= F.lit(min(windows.values()))))
    ends = []
    for name, first in windows.items():
        day = F.when(F.col("date") >= F.lit(first), F.col("date"))
        ends.append((F.try_divide(F.max_by("close", day), F.min_by("close", day)) - 1).alias(name))
    return rows.groupBy("ticker").agg(*ends)


def range_high_low(prices: DataFrame, as_of: dt.date, days: int = 365) -> DataFrame:
    """ticker, high, low of the closes of the last ``days`` days."""
    rows = prices.filter((F.col("date") <= F.lit(as_of)) & (F.col("date") > F.date_sub(F.lit(as_of), days)))
    return rows.groupBy("ticker").agg(F.max("close").alias("high"), F.min("close").alias("low"))


def with_events(rows: DataFrame, events: DataFrame, *columns: str) -> DataFrame:
    """rows left-joined with the events of their ticker and day: one row for each event of the day, null ``columns`` where there is none.

    Both sides are laid out by ticker and day; null tickers and days meet nothing.
    """
    return rows.join(events.select("ticker", "date", *columns), ["ticker", "date"], "left")


def adjustment_chain(prices: DataFrame, events: DataFrame, kinds: tuple[str, ...] = ("split", "dividend"), since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """ticker, date, adjustment, is_event, chain and deviation: the adjustment against what the events alone explain.

    ``chain`` is the product of the steps (adjustment before over adjustment after) on event days after a
    row's own, as far as ``until``. Where every change of the adjustment falls on a day with an event, adjustment over chain is
    the last adjustment and ``deviation``, their ratio less 1, is 0; a change on any other day shows from there back to
    the first day. Only rows with an adjustment above 0 count, a first row has no step, and several events of a day are one.
    """
    rows = prices.filter(F.col("adjustment") > 0)
    rows = rows.filter(F.col("date") >= F.lit(since)) if since else rows
    rows = rows.filter(F.col("date") <= F.lit(until)) if until else rows
    days = events.filter(F.col("action").isin(*kinds)).select("ticker", "date").distinct().withColumn("__event", F.lit(True))
    rows = with_events(rows.select("ticker", "date", "adjustment"), days, "__event").withColumn("is_event", F.coalesce("__event", F.lit(False))).drop("__event")
    w = Window.partitionBy("ticker").orderBy("date")
    later = Window.partitionBy("ticker").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__step", F.when(F.col("is_event"), F.ln(F.lag("adjustment").over(w) / F.col("adjustment"))))
    rows = rows.withColumn("chain", F.exp(F.coalesce(F.sum("__step").over(later), F.lit(0.0)))).drop("__step")
    last = F.first("adjustment").over(Window.partitionBy("ticker").orderBy(F.desc("date")))
    return rows.withColumn("deviation", F.col("adjustment") / F.col("chain") / last - 1)


def long_histories(prices: DataFrame, rows: DataFrame, years: float, order: str) -> DataFrame:
    """``rows`` whose ticker has prices over so many years, with ``years``; largest ``order`` first."""
    spans = prices.groupBy("ticker").agg((F.datediff(F.max("date"), F.min("date")) / 365.25).alias("years")).filter(F.col("years") >= years)
    return rows.join(spans, "ticker").orderBy(F.desc(order), "ticker")


def checks(facts: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """check, passed: each test on a one-row frame of facts."""
    each = F.array(*[F.struct(F.lit(k).alias("check"), F.coalesce(v, F.lit(False)).alias("passed")) for k, v in tests.items()])
    return facts.select(F.inline(each))


def transpose(row: DataFrame, columns: list[str]) -> DataFrame:
    """item, value (as text): a wide row as a long one."""
    return row.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "item", "value")
