"""Tables of the engine: columns, types and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The numeric indicators of the fundamentals table.
INDICATORS = [
    "accoci", "assets", "assetsavg", "assetsc", "assetsnc", "assetturnover", "bvps", "capex", "cashneq", "cashnequsd", "cor", "consolinc", "currentratio", "de", "debt",
    "debtc", "debtnc", "debtusd", "deferredrev", "depamor", "deposits", "divyield", "dps", "ebit", "ebitda", "ebitdamargin", "ebitdausd", "ebitusd", "ebt", "eps",
    "epsdil", "epsusd", "equity", "equityavg", "equityusd", "ev", "evebit", "evebitda", "fcf", "fcfps", "fxusd", "gp", "grossmargin", "intangibles", "intexp", "invcap",
    "invcapavg", "inventory", "investments", "investmentsc", "investmentsnc", "liabilities", "liabilitiesc", "liabilitiesnc", "marketcap", "ncf", "ncfbus", "ncfcommon",
    "ncfdebt", "ncfdiv", "ncff", "ncfi", "ncfinv", "ncfo", "ncfx", "netinc", "netinccmn", "netinccmnusd", "netincdis", "netincnci", "netmargin", "opex", "opinc",
    "payables", "payoutratio", "pb", "pe", "pe1", "ppnenet", "prefdivis", "price", "ps", "ps1", "receivables", "retearn", "revenue", "revenueusd", "rnd", "roa", "roe",
    "roic", "ros", "sbcomp", "sgna", "sharefactor", "sharesbas", "shareswa", "shareswadil", "sps", "tangibles", "taxassets", "taxexp", "taxliabilities", "tbvps",
    "workingcapital",
]


@dataclass(frozen=True)
class Table:
    """Columns as `name type` pairs (string where no type stands) and the key that makes a row unique."""

    name: str
    columns: str
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(c if " " in c else f"{c} string" for c in (x.strip() for x in self.columns.split(","))))

    def conform(self, rows: DataFrame, *more: str) -> DataFrame:
        """The table's columns in its order and types, and ``more``; those that ``rows`` lacks are null, further ones go."""
        return rows.select(*more, *[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema])


def _doubles(names: str | list[str]) -> str:
    return ", ".join(f"{n} double" for n in (names.split() if isinstance(names, str) else names))


# The tables, their columns and keys.
_ALL = [
    Table("universe", "ticker, name, source, added_at timestamp_ntz, figi, cik, sic, sic_description, lei", ("ticker",)),
    Table("prices", f"ticker, date date, {_doubles('open high low close')}, volume bigint, adjustment double", ("ticker", "date")),
    Table("classifications", "ticker, sector, industry, as_of date", ("ticker",)),
    Table("snapshots", "source, pulled_at timestamp_ntz, as_of date, row_count int", ()),
    Table(
        "quarterly_statements",
        f"ticker, period date, {_doubles('net_income revenue gross_profit operating_cash_flow total_assets total_liabilities current_assets current_liabilities shares_out roa cfo')}",
        ("ticker", "period"),
    ),
    Table(
        "ratios",
        f"ticker, as_of date, {_doubles('trailing_pe forward_pe price_to_book price_to_sales roe roa net_margin gross_margin operating_margin debt_to_equity current_ratio dividend_yield market_cap enterprise_value ev_to_ebitda beta shares_outstanding')}",
        ("ticker", "as_of"),
    ),
    Table(
        "securities_master",
        "permaticker, ticker, name, exchange, isdelisted, category, cusips, siccode, sicsector, sicindustry, figi, famaindustry, sector, industry, scalemarketcap, scalerevenue, relatedtickers, "
        "currency, location, firstadded date, firstpricedate date, lastpricedate date, firstquarter, lastquarter, secfilings, companysite, lastupdated, src_table",
        ("permaticker",),
    ),
    Table("corporate_actions", "ticker, date date, action, name, value, contraticker, contraname", ("ticker", "date", "action", "value")),
    Table("descriptions", "table_name, indicator, isfilter, isprimarykey, title, description, unittype", ("table_name", "indicator")),
    Table("sp500_membership", "ticker, date date, action, name, contraticker, contraname, note", ("ticker", "date")),
    Table("sf1", f"ticker, dimension, date date, reportperiod date, fiscalperiod, calendardate date, lastupdated, {_doubles(INDICATORS)}", ("ticker", "dimension", "reportperiod")),
    Table(
        "metrics",
        f"ticker, as_of date, {_doubles('price beta1y beta5y ma50d ma200d high52w low52w return1y return5y returnytd volume volumeavg1m volumeavg3m dividendyieldtrailing dividendyieldforward high5y low5y')}",
        ("ticker", "as_of"),
    ),
    Table("french_factors", f"date date, {_doubles('mkt_rf smb hml rmw cma mom st_rev lt_rev rf')}", ("date",)),
    Table(
        "universe_pit",
        "as_of date, ticker, category, exchange, isdelisted, sector, industry, price double, mcap double, dvol_avg double, dvol_days int, firstpricedate date, lastpricedate date",
        ("as_of", "ticker"),
    ),
    Table(
        "fundamentals",
        "ticker, fiscal_year int, roa double, cfo double, d_roa int, accruals int, d_leverage int, d_liquidity int, equity_issuance int, d_gross_margin int, d_asset_turnover int, f_score int",
        ("ticker", "fiscal_year"),
    ),
]

TABLES = {t.name: t for t in _ALL}

# Vendor sector labels and the eleven standard sectors.
SECTORS = {
    "Technology": "Information Technology",
    "Electronic Technology": "Information Technology",
    "Technology Services": "Information Technology",
    "Healthcare": "Health Care",
    "Health Care": "Health Care",
    "Health Technology": "Health Care",
    "Health Services": "Health Care",
    "Finance": "Financials",
    "Financials": "Financials",
    "Finance & Insurance": "Financials",
    "Energy": "Energy",
    "Consumer Non-Durables": "Consumer Staples",
    "Consumer Staples": "Consumer Staples",
    "Consumer Durables": "Consumer Discretionary",
    "Consumer Discretionary": "Consumer Discretionary",
    "Consumer Services": "Consumer Discretionary",
    "Retail Trade": "Consumer Discretionary",
    "Producer Manufacturing": "Industrials",
    "Industrial Services": "Industrials",
    "Transportation": "Industrials",
    "Distribution Services": "Industrials",
    "Commercial Services": "Industrials",
    "Process Industries": "Materials",
    "Materials": "Materials",
    "Non-Energy Minerals": "Materials",
    "Utilities": "Utilities",
    "Communications": "Communication Services",
    "Communication Services": "Communication Services",
    "Real Estate": "Real Estate",
}

# Daily factor files in load order: archive, table columns, header columns.
FACTOR_FILES = {
    "3f": ("F-F_Research_Data_Factors_daily_CSV.zip", "mkt_rf smb hml rf", "Mkt-RF SMB HML RF"),
    "5f": ("F-F_Research_Data_5_Factors_2x3_daily_CSV.zip", "mkt_rf smb hml rmw cma rf", "Mkt-RF SMB HML RMW CMA RF"),
    "mom": ("F-F_Momentum_Factor_daily_CSV.zip", "mom", "Mom"),
    "st_rev": ("F-F_ST_Reversal_Factor_daily_CSV.zip", "st_rev", "ST_Rev"),
    "lt_rev": ("F-F_LT_Reversal_Factor_daily_CSV.zip", "lt_rev", "LT_Rev"),
}


def sector_of(label: Column) -> Column:
    """Standard sector of a vendor label without blanks and quotes around it; null if the label is not known."""
    known = F.create_map(*[F.lit(x) for pair in SECTORS.items() for x in pair])
    return F.try_element_at(known, F.regexp_replace(F.trim(label), '^"+|"+$', ""))
