"""Statements, ratios and F-scores from filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import first_nonzero, share
from .asof import latest_rows
from .writes import last_by_key


def _or_null(rows: DataFrame, name: str) -> Column:
    return F.col(name) if name in rows.columns else F.lit(None).cast("double")


def quarterly_statements(sf1: DataFrame) -> DataFrame:
    """One row per ticker and period from as-reported quarters."""
    rows = sf1.filter(F.col("dimension") == "ARQ")
    return rows.select(
        "ticker",
        F.coalesce("reportperiod", "calendardate").alias("period"),
        F.col("netinc").alias("net_income"),
        "revenue",
        F.col("gp").alias("gross_profit"),
        F.col("ncfo").alias("operating_cash_flow"),
        F.col("assets").alias("total_assets"),
        F.col("liabilities").alias("total_liabilities"),
        F.col("assetsc").alias("current_assets"),
        F.col("liabilitiesc").alias("current_liabilities"),
        first_nonzero(F.col("shareswa"), F.col("sharesbas")).alias("shares_out"),
        share(F.col("netinc"), F.col("assets")).alias("roa"),
        F.col("ncfo").alias("cfo"),
    )


def ratios(sf1: DataFrame, as_of: Column) -> DataFrame:
    """Valuation and margins from each ticker's latest restated year; analysts' figures and beta are not given."""
    rows = latest_rows(sf1.filter(F.col("dimension") == "MRY"), ["ticker"], ["calendardate", "reportperiod"])
    same = {
        "trailing_pe": "pe", "price_to_book": "pb", "price_to_sales": "ps", "roe": "roe", "roa": "roa", "net_margin": "netmargin", "gross_margin": "grossmargin",
        "debt_to_equity": "de", "current_ratio": "currentratio", "dividend_yield": "divyield", "market_cap": "marketcap", "enterprise_value": "ev", "ev_to_ebitda": "evebitda",
        "shares_outstanding": "shareswa",
    }
    made = {k: _or_null(rows, v) for k, v in same.items()}
    made |= {"operating_margin": share(_or_null(rows, "opinc"), F.col("revenue")), "forward_pe": F.lit(None).cast("double"), "beta": F.lit(None).cast("double")}
    names = "trailing_pe forward_pe price_to_book price_to_sales roe roa net_margin gross_margin operating_margin debt_to_equity current_ratio dividend_yield market_cap enterprise_value ev_to_ebitda beta shares_outstanding"
    return rows.select("ticker", as_of.alias("as_of"), *[made[n].alias(n) for n in names.split()])


def piotroski(sf1: DataFrame) -> DataFrame:
    """F-scores (0 to 8) by ticker and fiscal year from as-reported years.

    A year is compared with the row before it, in order of period, whatever that row holds; rows
    without income and assets are left out afterwards. A missing figure makes a signal 0. Of two
    rows of one fiscal year the later counts.
    """
    before = Window.partitionBy("ticker").orderBy("calendardate", "reportperiod")
    level = {
        "roa": share(F.col("netinc"), F.col("assets")),
        "debt": F.col("liabilities"),
        "liquid": share(F.col("assetsc"), F.col("liabilitiesc")),
        "shares": first_nonzero(F.col("shareswa"), F.col("sharesbas")),
        "margin": share(F.col("gp"), F.col("revenue")),
        "turnover": share(F.col("revenue"), F.col("assets")),
    }
    rows = sf1.filter(F.col("dimension") == "ARY").select("ticker", "calendardate", "reportperiod", "netinc", "assets", F.col("ncfo").alias("cfo"), *[v.alias(f"l_{k}") for k, v in level.items()])
    rows = rows.select("*", *[F.lag(f"l_{k}").over(before).alias(f"p_{k}") for k in level])
    flag = lambda test: F.coalesce(test.cast("int"), F.lit(0))
    now, then = (lambda k: F.col(f"l_{k}")), (lambda k: F.col(f"p_{k}"))
    signals = {
        "d_roa": now("roa") > then("roa"),
        "accruals": F.col("cfo") > F.col("netinc"),
        "d_leverage": now("debt") < then("debt"),
        "d_liquidity": now("liquid") > then("liquid"),
        "equity_issuance": now("shares") <= then("shares"),
        "d_gross_margin": now("margin") > then("margin"),
        "d_asset_turnover": now("turnover") > then("turnover"),
    }
    made = rows.filter(F.col("netinc").isNotNull() | F.col("assets").isNotNull()).select(
        "ticker", F.year("calendardate").alias("fiscal_year"), F.col("l_roa").alias("roa"), "cfo", *[flag(t).alias(k) for k, t in signals.items()], "calendardate", "reportperiod"
    )
    score = flag(F.col("cfo") > 0)
    for k in signals:
        score = score + F.col(k)
    return last_by_key(made.withColumn("f_score", score), ["ticker", "fiscal_year"], ["calendardate", "reportperiod"]).drop("calendardate", "reportperiod")


def score_histogram(fundamentals: DataFrame, most: int = 9) -> DataFrame:
    """f_score 0 to ``most`` and how many rows have it, 0 where none has."""
    every = fundamentals.sparkSession.range(most + 1).select(F.col("id").cast("int").alias("f_score"))
    counts = fundamentals.groupBy("f_score").agg(F.count(F.lit(1)).alias("n"))
    return every.join(F.broadcast(counts), "f_score", "left").select("f_score", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
