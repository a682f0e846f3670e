"""Every registered query of the engine over the stand-in market tables, with DuckDB SQL that states it another way."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import parse
from .operators import analytics, asof, factors, fundamentals, pit, prices, writes
from .plans.surrogate import kept_views, view, with_views
from .shipping import shared_folder
from .sources import archives, landing, providers, shelves
from .sources.schemas import sector_of

#: Views of the universe's history, which reads each several times.
_PIT_VIEWS = "v_prices v_master v_sf1"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DAY, SINCE = dt.date(1999, 6, 30), dt.date(1998, 1, 1)
#: Thresholds at the scale of the stand-in tables.
SCREEN = pit.Screen(min_price=2000.0, min_dvol=40000.0, min_mcap=800000.0)
CATEGORIES = ", ".join(f"'{c}'" for c in SCREEN.categories)
MCAP_EDGES, MCAP_LABELS = [0.0, 1e6, 2e6, 5e6, 1e12], ["to 1m", "1m to 2m", "2m to 5m", "over 5m"]
THRESHOLDS = [8e5, 1e6, 1.5e6, 2e6, 3e6, 5e6, 1e7, 1e8]
KINDS = ["stocks", "funds"]
FACTOR_ORDER = ["signup", "click", "view", "purchase", "error"]
FACTOR_COLUMNS = ["mkt", "size", "value", "mom"]
#: Columns that each stand-in factor file owns; later files win where they overlap.
OWNED = {"signup": ["mkt", "size"], "click": ["mkt", "value"], "view": ["mom"], "purchase": ["size"], "error": ["value"]}


def query(name: str, views: str, sql: str | None = None):
    """Register a query of the named views (passed as DataFrames) and its SQL."""

    def keep(build):
        QUERIES[name] = lambda spark, sf_dir: build(*(kept_views(spark, sf_dir) if views == _PIT_VIEWS else [view(spark, sf_dir, v) for v in views.split()]))
        if sql:
            ORACLES[name] = f"{with_views(*views.split())}{',' if sql.lstrip().startswith('/*with*/') else ''} {sql.replace('/*with*/', '')}"
        return build

    return keep


# ---- prices ----

query(
    "as_traded_prices", "v_vendor_bars",
    """SELECT ticker, date, open * (closeunadj / close) AS open, high * (closeunadj / close) AS high, low * (closeunadj / close) AS low, closeunadj AS close, volume,
       CASE WHEN closeadj <> 0 AND closeunadj <> 0 THEN closeadj / closeunadj ELSE 1e0 END AS adjustment FROM v_vendor_bars WHERE close <> 0""",
)(lambda bars: prices.as_traded(bars))

query(
    "adjusted_prices", "v_prices",
    "SELECT ticker, date, open * adjustment AS open, high * adjustment AS high, low * adjustment AS low, close * adjustment AS close, volume, adjustment FROM v_prices",
)(lambda p: prices.adjusted(p))

query(
    "adjusted_prices_asof", "v_prices",
    f"""/*with*/ a AS (SELECT ticker, adjustment AS s FROM v_prices WHERE date <= DATE '{DAY}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1)
       SELECT ticker, date, open * (adjustment / s) AS open, high * (adjustment / s) AS high, low * (adjustment / s) AS low, close * (adjustment / s) AS close, volume, adjustment / s AS adjustment
       FROM v_prices JOIN a USING (ticker)""",
)(lambda p: prices.adjusted(p, DAY, missing_is_an_error=False))

query(
    "price_date_range", "v_prices", f"SELECT * FROM v_prices WHERE ticker = '7' AND date BETWEEN DATE '{SINCE}' AND DATE '{DAY}'"
)(lambda p: prices.between(p, "7", SINCE, DAY))

query("cross_section_date", "v_prices", f"SELECT * FROM v_prices WHERE date = DATE '{DAY}'")(lambda p: prices.cross_section(p, DAY))

query("trading_calendar", "v_prices", "SELECT date FROM v_prices GROUP BY date")(lambda p: pit.trading_days(p).orderBy("date"))

# ---- archives and vendors ----

@query(
    "archived_bars", "v_vendor_bars",
    """SELECT ticker, date, open * (closeunadj / close) AS open, high * (closeunadj / close) AS high, low * (closeunadj / close) AS low, closeunadj AS close, volume,
       CASE WHEN closeadj <> 0 AND closeunadj <> 0 THEN closeadj / closeunadj ELSE 1e0 END AS adjustment FROM v_vendor_bars WHERE close <> 0""",
)
def archived_bars(bars):
    """Vendor bars written as zipped CSV files by the executors, and loaded from them as a vendor's bulk files are."""
    spark = bars.sparkSession
    folder = f"{shared_folder(spark)}/bars-{uuid.uuid4().hex[:12]}"
    archives.write(bars.repartition("ticker"), folder).collect()  # a row for each archive, of which there are as many as the bars call for
    return landing.prices(archives.read(spark, folder, members="first")).drop(landing.UNPARSED)


def paged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders pulled by offset and limit."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    shelf = shelves.lay(spark.read.parquet(f"{sf_dir}/orders.parquet").select(*columns))
    rows = providers.paged(spark, columns, shelf.page, page=5_000, lanes=3)
    return rows.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus", "o_orderpriority")


def batched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items pulled by supplier, in batches by size, from a server that cuts its answers at 900 rows."""
    columns, cap = ["l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate"], 900
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_suppkey").cast("string").alias("ticker"), *columns[:3], F.col("l_shipdate").cast("date").alias("l_shipdate"))
    shelf = shelves.lay(lines, "ticker", "l_shipdate", "l_orderkey", "l_linenumber")

    def fetch(tickers: list[str], first: dt.date, last: dt.date) -> list[dict]:
        return shelf.of(tickers, "l_shipdate", first, last, cap)

    sizes = lines.groupBy("ticker").agg((F.count(F.lit(1)) * 2 / 3).cast("long").alias("expected"))  # too low, as estimates are
    rows = providers.by_ticker(spark, columns, fetch, sizes, (dt.date(1990, 1, 1), dt.date(2005, 12, 31)), cap, most_rows=1200)
    kinds = {"l_suppkey": "long", "l_orderkey": "long", "l_linenumber": "long", "l_shipdate": "date"}
    return rows.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])


QUERIES["paged_orders"], QUERIES["batched_lines"] = paged_orders, batched_lines
ORACLES["paged_orders"] = "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_orderpriority FROM orders"
ORACLES["batched_lines"] = "SELECT CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem"

# ---- fundamentals ----

_SECTOR_CASES = {"AFRICA": "Energy", "AMERICA": " Finance ", "ASIA": '"Technology"', "EUROPE": "Retail Trade"}


@query(
    "gics_map", "v_master",
    "SELECT ticker, CASE sector WHEN 'AFRICA' THEN 'Energy' WHEN 'AMERICA' THEN 'Financials' WHEN 'ASIA' THEN 'Information Technology' WHEN 'EUROPE' THEN 'Consumer Discretionary' END AS sector FROM v_master",
)
def gics_map(m):
    label = F.lit("Unheard Of")
    for region, vendor in _SECTOR_CASES.items():
        label = F.when(F.col("sector") == region, vendor).otherwise(label)
    return m.select("ticker", sector_of(label).alias("sector"))


query(
    "quarterly_statements", "v_sf1",
    """SELECT ticker, reportperiod AS period, netinc AS net_income, revenue, gp AS gross_profit, ncfo AS operating_cash_flow, assets AS total_assets, liabilities AS total_liabilities,
       assetsc AS current_assets, liabilitiesc AS current_liabilities, CASE WHEN shareswa IS NULL OR shareswa = 0 THEN sharesbas ELSE shareswa END AS shares_out,
       CASE WHEN assets <> 0 THEN netinc / assets END AS roa, ncfo AS cfo FROM v_sf1 WHERE dimension = 'ARQ'""",
)(fundamentals.quarterly_statements)


# Vendor ratios that the stand-in filings lack, from figures that they have.
_GIVEN = {
    "pe": ("assets", "netinc"), "pb": ("assets", "assetsc"), "ps": ("assets", "revenue"), "roe": ("netinc", "assetsc"), "roa": ("netinc", "assets"), "netmargin": ("netinc", "revenue"),
    "grossmargin": ("gp", "revenue"), "de": ("liabilities", "assetsc"), "currentratio": ("assetsc", "liabilitiesc"), "divyield": ("liabilitiesc", "assets"), "evebitda": ("assets", "ncfo"),
}
_RATIO_OF = {
    "trailing_pe": "pe", "price_to_book": "pb", "price_to_sales": "ps", "roe": "roe", "roa": "roa", "net_margin": "netmargin", "gross_margin": "grossmargin", "debt_to_equity": "de",
    "current_ratio": "currentratio", "dividend_yield": "divyield", "ev_to_ebitda": "evebitda",
}


@query(
    "ratios_latest", "v_sf1",
    f"""SELECT ticker, DATE '{DAY}' AS as_of, {", ".join(f"CASE WHEN {_GIVEN[v][1]} <> 0 THEN {_GIVEN[v][0]} / {_GIVEN[v][1]} END AS {k}" for k, v in _RATIO_OF.items())},
       CASE WHEN revenue <> 0 THEN ncfo / revenue END AS operating_margin, assets * 2 AS market_cap, assets * 3 AS enterprise_value, shareswa AS shares_outstanding,
       CAST(NULL AS DOUBLE) AS forward_pe, CAST(NULL AS DOUBLE) AS beta
       FROM v_sf1 WHERE dimension = 'MRY' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY calendardate DESC) = 1""",
)
def ratios_latest(sf1):
    made = {k: parse.share(F.col(a), F.col(b)) for k, (a, b) in _GIVEN.items()} | {"opinc": F.col("ncfo"), "marketcap": F.col("assets") * 2, "ev": F.col("assets") * 3}
    return fundamentals.ratios(sf1.withColumns(made), F.lit(DAY))


_PIOTROSKI = """r AS (
  SELECT *, coalesce(nullif(shareswa, 0), sharesbas) AS sh, row_number() OVER (PARTITION BY ticker ORDER BY calendardate) AS i FROM v_sf1 WHERE dimension = 'ARY'),
s AS (
  SELECT a.ticker, CAST(year(a.calendardate) AS INT) AS fiscal_year, CASE WHEN a.assets <> 0 THEN a.netinc / a.assets END AS roa, a.ncfo AS cfo,
         CAST(coalesce(a.netinc / nullif(a.assets, 0) > b.netinc / nullif(b.assets, 0), FALSE) AS INT) AS d_roa, CAST(coalesce(a.ncfo > a.netinc, FALSE) AS INT) AS accruals,
         CAST(coalesce(a.liabilities < b.liabilities, FALSE) AS INT) AS d_leverage,
         CAST(coalesce(a.assetsc / nullif(a.liabilitiesc, 0) > b.assetsc / nullif(b.liabilitiesc, 0), FALSE) AS INT) AS d_liquidity, CAST(coalesce(a.sh <= b.sh, FALSE) AS INT) AS equity_issuance,
         CAST(coalesce(a.gp / nullif(a.revenue, 0) > b.gp / nullif(b.revenue, 0), FALSE) AS INT) AS d_gross_margin,
         CAST(coalesce(a.revenue / nullif(a.assets, 0) > b.revenue / nullif(b.assets, 0), FALSE) AS INT) AS d_asset_turnover
  FROM r a LEFT JOIN r b ON a.ticker = b.ticker AND b.i = a.i - 1 WHERE a.netinc IS NOT NULL OR a.assets IS NOT NULL),
f AS (SELECT *, CAST(coalesce(cfo > 0, FALSE) AS INT) + d_roa + accruals + d_leverage + d_liquidity + equity_issuance + d_gross_margin + d_asset_turnover AS f_score FROM s)"""

query("piotroski", "v_sf1", f"/*with*/ {_PIOTROSKI} SELECT * FROM f")(fundamentals.piotroski)

query(
    "fscore_histogram", "v_sf1",
    f"/*with*/ {_PIOTROSKI} SELECT CAST(h.x AS INT) AS f_score, CAST(count(f.ticker) AS BIGINT) AS n FROM range(10) AS h(x) LEFT JOIN f ON f.f_score = h.x GROUP BY h.x",
)(lambda sf1: fundamentals.score_histogram(fundamentals.piotroski(sf1)))

# ---- as-of joins and the point-in-time universe ----

query(
    "asof_shares", "v_prices v_sf1",
    """/*with*/ s AS (SELECT ticker, date, shareswa FROM v_sf1 WHERE dimension IN ('ARQ', 'ARY') AND shareswa IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY dimension DESC) = 1)
       SELECT p.ticker, p.date, p.close, s.shareswa FROM v_prices p ASOF LEFT JOIN s ON p.ticker = s.ticker AND p.date >= s.date""",
)(lambda p, sf1: asof.asof_join(p.select("ticker", "date", "close"), pit.filed_shares(sf1), ["ticker"], "date", ["shareswa"], ["dimension"]))

query(
    "asof_shares_single", "v_sf1",
    f"""SELECT ticker, shareswa FROM v_sf1 WHERE dimension IN ('ARQ', 'ARY') AND date <= DATE '{DAY}'
       QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC, dimension DESC) = 1""",
)(lambda sf1: asof.latest_upto(pit.filed_shares(sf1), ["ticker"], "date", F.lit(DAY), ["shareswa"], ["dimension"]))

query(
    "pit_single", "v_prices v_master v_sf1",
    f"""/*with*/ q AS (SELECT * FROM v_prices WHERE date <= DATE '{DAY}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= {SCREEN.lookback + 5}),
       b AS (SELECT ticker, max(date) AS last_date, arg_max(close, date) AS price, CAST(sum(CASE WHEN close <> 0 AND volume <> 0 THEN CAST(close * volume AS DECIMAL(28,6)) END) AS DOUBLE) AS dollars,
                    CAST(count(*) FILTER (WHERE close <> 0 AND volume <> 0) AS INT) AS dvol_days FROM q GROUP BY ticker),
       s AS (SELECT ticker, shareswa FROM v_sf1 WHERE dimension IN ('ARQ', 'ARY') AND date <= DATE '{DAY}' QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC, dimension DESC) = 1)
       SELECT DATE '{DAY}' AS as_of, ticker, category, exchange, isdelisted, sector, industry, price, price * shareswa AS mcap, dollars / dvol_days AS dvol_avg, dvol_days, firstpricedate, lastpricedate
       FROM b JOIN s USING (ticker) JOIN v_master USING (ticker)
       WHERE src_table = 'stocks' AND category IN ({CATEGORIES}) AND NOT (isdelisted = 'Y' AND lastpricedate < DATE '{DAY}') AND DATE '{DAY}' - last_date <= {SCREEN.max_quote_age}
         AND price >= {SCREEN.min_price} AND price * shareswa >= {SCREEN.min_mcap} AND dvol_days >= {SCREEN.min_dvol_days} AND dollars / dvol_days >= {SCREEN.min_dvol}""",
)(lambda p, m, sf1: pit.universe_on(p, m, sf1, DAY, SCREEN))

_VALID = f"""c AS (SELECT * FROM v_master WHERE src_table = 'stocks' AND category IN ({CATEGORIES})),
rolled AS (
  SELECT ticker, date, close, sum(CASE WHEN volume > 0 THEN CAST(close * volume AS DECIMAL(28,6)) END) OVER w AS dollars, count(CASE WHEN volume > 0 THEN 1 END) OVER w AS n
  FROM v_prices WHERE ticker IN (SELECT ticker FROM c) WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {SCREEN.lookback - 1} PRECEDING AND CURRENT ROW)),
shares AS (SELECT ticker, date, shareswa FROM v_sf1 WHERE dimension IN ('ARQ', 'ARY') AND shareswa IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY dimension DESC) = 1),
known AS (SELECT r.*, s.shareswa FROM rolled r ASOF LEFT JOIN shares s ON r.ticker = s.ticker AND r.date >= s.date),
valid AS (
  SELECT * FROM (SELECT ticker, date, close AS price, close * shareswa AS mcap, CASE WHEN n >= {SCREEN.min_dvol_days} THEN CAST(dollars AS DOUBLE) / n ELSE 0e0 END AS dvol_avg, CAST(n AS INT) AS dvol_days FROM known)
  WHERE price >= {SCREEN.min_price} AND mcap >= {SCREEN.min_mcap} AND dvol_avg >= {SCREEN.min_dvol})"""

_HISTORY = f"""{_VALID},
days AS (SELECT DISTINCT date FROM v_prices),
steps AS (
  SELECT v.*, lead(v.date) OVER w AS nxt, lag(v.date) OVER w AS bef, coalesce(c.lastpricedate, (SELECT max(date) FROM days)) AS stop
  FROM valid v JOIN c USING (ticker) WINDOW w AS (PARTITION BY v.ticker ORDER BY v.date)),
spans AS (
  SELECT *, CASE WHEN nxt IS NOT NULL THEN least(nxt - 1, date + {SCREEN.max_quote_age}) WHEN bef IS NOT NULL AND date - bef <= {SCREEN.max_quote_age}
            THEN greatest(date, least(stop, date + {SCREEN.max_quote_age})) ELSE least(stop, date + {SCREEN.max_quote_age}) END AS until FROM steps),
history AS (
  SELECT d.date AS as_of, s.ticker, c.category, c.exchange, c.isdelisted, c.sector, c.industry, s.price, s.mcap, s.dvol_avg, s.dvol_days, c.firstpricedate, c.lastpricedate
  FROM spans s JOIN days d ON d.date BETWEEN s.date AND s.until JOIN c USING (ticker))"""

def _history(p, m, sf1):
    return pit.universe_history(p, m, sf1, SCREEN)


query("pit_history", _PIT_VIEWS, f"/*with*/ {_HISTORY} SELECT * FROM history")(_history)

query("rolling_dollar_volume", _PIT_VIEWS, f"/*with*/ {_VALID} SELECT * FROM valid")(lambda p, m, sf1: pit.valid_quotes(p, m, sf1, SCREEN))

query(
    "validity_islands", _PIT_VIEWS,
    f"""/*with*/ {_VALID}, marked AS (SELECT *, CASE WHEN date - lag(date) OVER w <= {SCREEN.max_quote_age} THEN 0 ELSE 1 END AS fresh FROM valid WINDOW w AS (PARTITION BY ticker ORDER BY date)),
       runs AS (SELECT *, sum(fresh) OVER (PARTITION BY ticker ORDER BY date) AS run FROM marked)
       SELECT ticker, min(date) AS first, max(date) AS last, count(*) AS quotes FROM runs GROUP BY ticker, run""",
)(lambda p, m, sf1: pit.spans_of(pit.valid_quotes(p, m, sf1, SCREEN), SCREEN.max_quote_age))

query("pit_members_per_day", _PIT_VIEWS, f"/*with*/ {_HISTORY} SELECT as_of, count(*) AS n FROM history GROUP BY as_of")(lambda *t: analytics.counts(_history(*t), ["as_of"]))


@query(
    "pit_mcap_buckets", _PIT_VIEWS,
    f"""/*with*/ {_HISTORY}, b AS (SELECT CASE WHEN mcap <= 1e6 THEN 'to 1m' WHEN mcap <= 2e6 THEN '1m to 2m' WHEN mcap <= 5e6 THEN '2m to 5m' ELSE 'over 5m' END AS bucket, count(*) AS n FROM history GROUP BY 1)
       SELECT bucket, n, n / (SELECT CAST(sum(n) AS DOUBLE) FROM b) AS share FROM b""",
)
def pit_mcap_buckets(*tables):
    held = _history(*tables).withColumn("bucket", analytics.bucket(F.col("mcap"), MCAP_EDGES, MCAP_LABELS))
    return analytics.with_share(analytics.counts(held, ["bucket"]), "n")


query(
    "pit_thresholds", _PIT_VIEWS,
    f"""/*with*/ {_HISTORY}, t AS (SELECT unnest([{", ".join(f"CAST({t} AS DOUBLE)" for t in THRESHOLDS)}]) AS threshold)
       SELECT threshold, count(h.mcap) AS n, CAST(sum(CAST(h.mcap AS DECIMAL(28,0))) AS DOUBLE) AS total FROM t LEFT JOIN history h ON h.mcap >= threshold GROUP BY threshold""",
)(lambda *t: analytics.threshold_counts(_history(*t), "mcap", THRESHOLDS))

query(
    "pit_sector_rollup", _PIT_VIEWS,
    f"/*with*/ {_HISTORY} SELECT sector, count(*) AS n, CAST(sum(CAST(mcap AS DECIMAL(28,0))) AS DOUBLE) AS mcap FROM history WHERE as_of = (SELECT max(as_of) FROM history) GROUP BY sector",
)(
    lambda *t: (lambda h: h.join(F.broadcast(h.agg(F.max("as_of").alias("as_of"))), "as_of", "left_semi").groupBy("sector").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("mcap").cast("decimal(28,0)")).cast("double").alias("mcap")))(_history(*t))
)

query(
    "pit_year_median", _PIT_VIEWS,
    f"/*with*/ {_HISTORY} SELECT CAST(year(as_of) AS INT) AS yr, count(*) AS n, median(mcap) AS median, CAST(sum(CAST(mcap AS DECIMAL(28,0))) AS DOUBLE) AS total FROM history GROUP BY 1",
)(lambda *t: analytics.median_by(_history(*t).withColumn("yr", F.year("as_of")), "yr", "mcap"))

# What an earlier state of the prices lacked: a third of the tickers from a day on, and two days of the calendar.
_LATE, _NEW_DAYS = dt.date(2001, 3, 1), (dt.date(2001, 6, 4), dt.date(2001, 10, 31))


@query("history_update", _PIT_VIEWS, f"/*with*/ {_HISTORY} SELECT * FROM history")
def history_update(p, m, sf1):
    """The history of an earlier state of the prices, brought up to date from what has changed since: equal to a full build."""
    late = ((F.col("ticker").cast("int") % 3 == 0) & (F.col("date") >= F.lit(_LATE))) | F.col("date").isin(*_NEW_DAYS)
    before, new = p.filter(~late), p.filter(late)
    changes = new.groupBy("ticker").agg(F.min("date").alias("first_day"))
    days = new.select("date").distinct().join(before.select("date").distinct(), "date", "left_anti").agg(F.min("date").alias("first_day")).select(F.lit(None).cast("string").alias("ticker"), "first_day")
    since = pit.affected_since(changes.union(days), m, SCREEN)
    old = pit.universe_history(before, m, sf1, SCREEN)
    return pit.without_affected(old, since).unionByName(pit.history_since(p, m, sf1, since, SCREEN))


_EXPECTED = f"""c AS (SELECT DISTINCT date FROM v_prices WHERE date BETWEEN DATE '{SINCE}' AND DATE '{DAY}'),
lives AS (SELECT ticker, greatest(firstpricedate, (SELECT min(date) FROM c)) AS first, least(lastpricedate, (SELECT max(date) FROM c)) AS last FROM v_master WHERE firstpricedate IS NOT NULL),
e AS (SELECT ticker, first, last, (SELECT count(*) FROM c WHERE c.date BETWEEN l.first AND l.last) AS expected FROM lives l)"""

query("sessions_expected", "v_prices v_master", f"/*with*/ {_EXPECTED} SELECT * FROM e")(
    lambda p, m: pit.sessions_expected(p, m.filter("firstpricedate IS NOT NULL"), SINCE, DAY)
)

query(
    "short_tickers", "v_prices v_master",
    f"""/*with*/ {_EXPECTED}, h AS (SELECT e.ticker, count(p.date) AS held FROM e LEFT JOIN v_prices p ON p.ticker = e.ticker AND p.date BETWEEN e.first AND e.last AND p.volume > 20 GROUP BY e.ticker)
       SELECT ticker, expected, held FROM e JOIN h USING (ticker) WHERE held < expected - 20""",
)(lambda p, m: pit.short_tickers(p.filter("volume > 20"), pit.sessions_expected(p, m.filter("firstpricedate IS NOT NULL"), SINCE, DAY)))

# ---- coverage and counts ----

query(
    "coverage_union", "v_prices v_master v_sf1 v_actions",
    """SELECT 'prices' AS name, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date FROM v_prices
       UNION ALL SELECT 'master', count(*), NULL, NULL FROM v_master UNION ALL SELECT 'sf1', count(*), min(date), max(date) FROM v_sf1
       UNION ALL SELECT 'actions', count(*), min(date), max(date) FROM v_actions""",
)(lambda p, m, s, a: analytics.coverage({"prices": (p, "date"), "master": (m, None), "sf1": (s, "date"), "actions": (a, "date")}))


def _with_kind(p, m):
    return p.join(m.select("ticker", "src_table"), "ticker", "left").withColumn("yr", F.year("date"))


query(
    "year_kind_counts", "v_prices v_master",
    "SELECT CAST(year(date) AS INT) AS yr, src_table, count(*) AS n, count(DISTINCT p.ticker) AS n_ticker FROM v_prices p LEFT JOIN v_master m ON p.ticker = m.ticker GROUP BY 1, 2",
)(lambda p, m: analytics.counts(_with_kind(p, m), ["yr", "src_table"], "ticker"))

query(
    "year_kind_pivot", "v_prices v_master",
    "SELECT CAST(year(date) AS INT) AS yr, count(*) FILTER (WHERE src_table = 'stocks') AS stocks, count(*) FILTER (WHERE src_table = 'funds') AS funds FROM v_prices p LEFT JOIN v_master m ON p.ticker = m.ticker GROUP BY 1",
)(lambda p, m: analytics.pivot_counts(_with_kind(p, m), "yr", "src_table", KINDS))

query(
    "freshness", "v_prices v_master",
    "SELECT src_table, max(date) AS last_date, count(DISTINCT p.ticker) AS n_ticker FROM v_prices p JOIN v_master m ON p.ticker = m.ticker GROUP BY src_table",
)(lambda p, m: p.join(m.select("ticker", "src_table"), "ticker").groupBy("src_table").agg(F.max("date").alias("last_date"), F.count_distinct("ticker").alias("n_ticker")))

query("action_counts", "v_actions", "SELECT action, count(*) AS n, count(DISTINCT ticker) AS n_ticker FROM v_actions GROUP BY action")(lambda a: analytics.counts(a, ["action"], "ticker"))

query(
    "action_filter", "v_actions", "SELECT * FROM v_actions WHERE (action = 'purchase' AND date >= DATE '2024-01-15') OR (action = 'error' AND date < DATE '2024-01-05')"
)(lambda a: a.filter(((F.col("action") == "purchase") & (F.col("date") >= "2024-01-15")) | ((F.col("action") == "error") & (F.col("date") < "2024-01-05"))))

query("delisted_by_kind", "v_master", "SELECT src_table, count(*) AS n, count(*) FILTER (WHERE isdelisted = 'Y') AS delisted FROM v_master GROUP BY src_table")(
    lambda m: analytics.flag_counts(m, {"delisted": F.col("isdelisted") == "Y"}, ["src_table"])
)

query(
    "quality_flags", "v_prices",
    """SELECT count(*) AS n, count(*) FILTER (WHERE volume = 0) AS no_volume, count(*) FILTER (WHERE adjustment > 0.9) AS high, count(*) FILTER (WHERE adjustment < 0.3) AS low,
       count(*) FILTER (WHERE close <= 0) AS no_price, count(*) FILTER (WHERE adjustment BETWEEN 0.01 AND 100) AS usable FROM v_prices""",
)(
    lambda p: analytics.flag_counts(
        p, {"no_volume": F.col("volume") == 0, "high": F.col("adjustment") > 0.9, "low": F.col("adjustment") < 0.3, "no_price": F.col("close") <= 0, "usable": F.col("adjustment").between(0.01, 100)}
    )
)

query("adj_extremes_topk", "v_prices", "SELECT ticker, date, adjustment FROM v_prices ORDER BY adjustment DESC, ticker, date LIMIT 8")(
    lambda p: analytics.top(p.select("ticker", "date", "adjustment"), 8, "adjustment", F.asc("ticker"), F.asc("date"))
)

query(
    "volume_magnitudes", "v_prices",
    "SELECT CAST(floor(log10(close * volume)) AS BIGINT) AS magnitude, count(*) AS n, round(min(log10(close * volume)), 6) AS low, round(max(log10(close * volume)), 6) AS high FROM v_prices WHERE close * volume > 0 GROUP BY 1",
)(
    lambda p: p.withColumn("m", analytics.magnitude(F.col("close") * F.col("volume"))).filter("m IS NOT NULL").groupBy(F.floor("m").alias("magnitude")).agg(F.count(F.lit(1)).alias("n"), F.round(F.min("m"), 6).alias("low"), F.round(F.max("m"), 6).alias("high"))
)


def short_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut to what a listing shows, with their whole lengths."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", analytics.shortened(F.col("text")).alias("description"), F.char_length("text").cast("long").alias("length"))


QUERIES["short_descriptions"] = short_descriptions
ORACLES["short_descriptions"] = "SELECT doc_id, substr(text, 1, 150) AS description, CAST(length(text) AS BIGINT) AS length FROM documents"

query("missing_prices", "v_actions v_master", "SELECT DISTINCT ticker FROM v_actions WHERE ticker NOT IN (SELECT ticker FROM v_master WHERE ticker IS NOT NULL)")(lambda a, m: analytics.absent(a, "ticker", m, "ticker"))

query(
    "full_span_tickers", "v_prices",
    "SELECT ticker, min(date) AS first_date, max(date) AS last_date FROM v_prices GROUP BY ticker HAVING min(date) <= DATE '1995-01-10' AND max(date) >= DATE '2001-10-25'",
)(lambda p: analytics.full_span(p, "ticker", dt.date(1995, 1, 10), dt.date(2001, 10, 25)))

query("mean_days_per_ticker", "v_prices", "SELECT CAST(trunc(avg(d)) AS INT) AS mean_days FROM (SELECT ticker, count(DISTINCT date) AS d FROM v_prices GROUP BY ticker)")(lambda p: analytics.mean_days(p, "ticker"))

query(
    "null_counts", "v_sf1",
    """SELECT 'revenue' AS "column", count(*) FILTER (WHERE revenue IS NULL) AS n_missing, count(*) AS n_rows FROM v_sf1
       UNION ALL SELECT 'shareswa', count(*) FILTER (WHERE shareswa IS NULL), count(*) FROM v_sf1 UNION ALL SELECT 'gp', count(*) FILTER (WHERE gp IS NULL), count(*) FROM v_sf1""",
)(lambda s: analytics.null_counts(s, ["revenue", "shareswa", "gp"]))

query(
    "largest_industries", "v_master",
    "SELECT industry, n FROM (SELECT industry, count(*) AS n FROM v_master GROUP BY industry) ORDER BY n DESC, industry LIMIT 6",
)(lambda m: analytics.top(analytics.counts(m, ["industry"]), 6, "n", F.asc("industry")))

query(
    "coverage_checks", "v_prices v_sf1",
    """/*with*/ f AS (SELECT (SELECT count(*) FROM v_prices) AS p, (SELECT max(date) FROM v_prices) AS d, (SELECT count(*) FROM v_sf1 WHERE shareswa IS NULL) AS z)
       SELECT 'prices present' AS "check", p > 1000 AS passed FROM f UNION ALL SELECT 'prices recent', d >= DATE '2001-10-01' FROM f UNION ALL SELECT 'shares whole', z = 0 FROM f""",
)(
    lambda p, s: analytics.checks(
        p.agg(F.count(F.lit(1)).alias("p"), F.max("date").alias("d")).join(F.broadcast(s.agg(F.count_if(F.col("shareswa").isNull()).alias("z")))),
        {"prices present": F.col("p") > 1000, "prices recent": F.col("d") >= "2001-10-01", "shares whole": F.col("z") == 0},
    )
)

query(
    "master_row_transposed", "v_master", "UNPIVOT (SELECT ticker, exchange, CAST(firstpricedate AS VARCHAR) AS firstpricedate FROM v_master WHERE ticker = '3') ON ticker, exchange, firstpricedate INTO NAME item VALUE value"
)(lambda m: analytics.transpose(m.filter("ticker = '3'"), ["ticker", "exchange", "firstpricedate"]))
ORACLES["master_row_transposed"] = f"{with_views('v_master')} SELECT item, value FROM (SELECT unnest(['ticker', 'exchange', 'firstpricedate']) AS item, unnest([ticker, exchange, CAST(firstpricedate AS VARCHAR)]) AS value FROM v_master WHERE ticker = '3')"

# ---- factors ----


def _files(f):
    return [(f.filter(F.col("file") == name).select("date", *[F.when(F.col("v") == -99.99, None).otherwise(F.col("v")).alias(c) for c in OWNED[name]]), OWNED[name]) for name in FACTOR_ORDER]


def _wide(f):
    return factors.merge_files(_files(f), FACTOR_COLUMNS)


_FILE = "(SELECT date, nullif(v, -99.99e0) AS v FROM v_factor_file WHERE file = '{}')"
_WIDE = f"""w AS (
  SELECT date, CASE WHEN c.date IS NOT NULL THEN c.v ELSE s.v END AS mkt, CASE WHEN p.date IS NOT NULL THEN p.v ELSE s.v END AS size, CASE WHEN e.date IS NOT NULL THEN e.v ELSE c.v END AS value, m.v AS mom
  FROM (SELECT DISTINCT date FROM v_factor_file) d LEFT JOIN {_FILE.format("signup")} s USING (date) LEFT JOIN {_FILE.format("click")} c USING (date)
  LEFT JOIN {_FILE.format("view")} m USING (date) LEFT JOIN {_FILE.format("purchase")} p USING (date) LEFT JOIN {_FILE.format("error")} e USING (date))"""

query("factor_wide", "v_factor_file", f"/*with*/ {_WIDE} SELECT * FROM w")(_wide)

query(
    "factor_coverage", "v_factor_file",
    f"""/*with*/ {_WIDE}, l AS (UNPIVOT w ON mkt, size, value, mom INTO NAME factor VALUE v)
       SELECT factor, count(v) AS n_days, min(date) AS first_date, max(date) AS last_date, CAST(sum(CAST(v AS DECIMAL(28,10))) AS DOUBLE) / count(v) AS mean,
              CAST(sum(CAST(v AS DECIMAL(28,10))) AS DOUBLE) / count(v) * 252 AS yearly_mean FROM l GROUP BY factor""",
)(lambda f: factors.coverage(_wide(f), FACTOR_COLUMNS))

query(
    "factor_cumulative", "v_factor_file",
    f"""/*with*/ {_WIDE}, l AS (SELECT date, mkt AS v FROM w WHERE mkt IS NOT NULL)
       SELECT a.date, round(exp(sum(ln(1 + b.v / 1000 / 100))), 6) AS growth FROM l a JOIN l b ON b.date <= a.date GROUP BY a.date""",
)(lambda f: factors.growth(_wide(f).filter("mkt IS NOT NULL"), [], F.col("mkt") / 1000).select("date", F.round("growth", 6).alias("growth")))

# ---- tear sheets ----

query(
    "split_days", "v_prices",
    """SELECT ticker, date, step FROM (SELECT ticker, date, adjustment / lag(adjustment) OVER (PARTITION BY ticker ORDER BY date) AS step FROM v_prices) WHERE step > 1.01 OR step < 0.52""",
)(lambda p: analytics.split_days(p, up=1.01))

query(
    "max_drawdown", "v_prices",
    f"""SELECT ticker, min(fall) AS drawdown FROM (SELECT ticker, close / max(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS fall FROM v_prices WHERE date >= DATE '{SINCE}') GROUP BY ticker""",
)(lambda p: analytics.max_drawdown(p, SINCE))

_WINDOWS = {"one_year": dt.date(1998, 7, 1), "three_years": dt.date(1996, 7, 1), "year_to_date": dt.date(1999, 1, 1)}
query(
    "trailing_returns", "v_prices",
    f"""SELECT ticker, {", ".join(f"arg_max(close, date) FILTER (WHERE date >= DATE '{d}') / arg_min(close, date) FILTER (WHERE date >= DATE '{d}') - 1 AS {k}" for k, d in _WINDOWS.items())}
       FROM v_prices WHERE date BETWEEN DATE '{min(_WINDOWS.values())}' AND DATE '{DAY}' GROUP BY ticker""",
)(lambda p: analytics.trailing_returns(p, DAY, _WINDOWS))

query(
    "high_low_52w", "v_prices",
    f"SELECT ticker, max(close) AS high, min(close) AS low FROM v_prices WHERE date <= DATE '{DAY}' AND date > DATE '{DAY}' - 365 GROUP BY ticker",
)(lambda p: analytics.range_high_low(p, DAY))

# Splits and dividends are known for most changes of the adjustment; those left out of v_events have to show as deviations.
_CHAIN = f"""steps AS (
  SELECT ticker, date, adjustment, lag(adjustment) OVER (PARTITION BY ticker ORDER BY date) / adjustment AS step, last_value(adjustment) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS at_end
  FROM v_prices WHERE adjustment > 0 AND date <= DATE '{DAY}'),
on_event AS (SELECT s.ticker, s.date, s.step FROM steps s WHERE EXISTS (SELECT 1 FROM v_events e WHERE e.ticker = s.ticker AND e.date = s.date AND e.action IN ('split', 'dividend'))),
chains AS (
  SELECT s.ticker, s.date, s.adjustment, s.at_end, coalesce(product(e.step), 1e0) AS chain FROM steps s LEFT JOIN on_event e ON e.ticker = s.ticker AND e.date > s.date AND e.step IS NOT NULL GROUP BY ALL)"""

query(
    "adjustment_identity", "v_prices v_events",
    f"""/*with*/ {_CHAIN}
       SELECT ticker, count(*) AS n, (SELECT count(*) FROM on_event o WHERE o.ticker = c.ticker) AS n_events, count(*) FILTER (WHERE abs(adjustment / chain / at_end - 1) > 1e-9) AS broken,
              round(max(abs(adjustment / chain / at_end - 1)), 6) AS deviation FROM chains c GROUP BY ticker""",
)(
    lambda p, e: analytics.adjustment_chain(p, e, until=DAY).groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_event").alias("n_events"), F.count_if(F.abs("deviation") > 1e-9).alias("broken"), F.round(F.max(F.abs("deviation")), 6).alias("deviation")
    )
)

query(
    "price_events", "v_prices v_events",
    f"SELECT p.ticker, p.date, p.close, p.adjustment, e.action FROM v_prices p LEFT JOIN v_events e ON e.ticker = p.ticker AND e.date = p.date WHERE p.date >= DATE '{SINCE}' AND p.date <= DATE '{DAY}'",
)(lambda p, e: analytics.with_events(prices.between(p, None, SINCE, DAY).select("ticker", "date", "close", "adjustment"), e, "action"))

query(
    "history_years_pick", "v_prices v_master",
    """SELECT m.ticker, m.sector, s.years FROM v_master m JOIN (SELECT ticker, date_diff('day', min(date), max(date)) / 365.25e0 AS years FROM v_prices GROUP BY ticker) s ON m.ticker = s.ticker
       WHERE s.years >= 6.5 ORDER BY m.ticker DESC LIMIT 1""",
)(lambda p, m: analytics.long_histories(p, m.select("ticker", "sector"), 6.5, "ticker").limit(1))

# ---- keyed writes ----

_NEW = f"SELECT ticker, date, close * 2 AS close, volume, 2 AS seq FROM v_prices WHERE date >= DATE '{DAY}'"


def _loads(p):
    base = p.select("ticker", "date", "close", "volume")
    late = base.filter(F.col("date") >= F.lit(DAY))
    return base, late.select("ticker", "date", (F.col("close") * 3).alias("close"), "volume", F.lit(1).alias("seq")).union(late.select("ticker", "date", (F.col("close") * 2).alias("close"), "volume", F.lit(2).alias("seq")))


@query("replace_by_key", "v_prices", f"SELECT ticker, date, CASE WHEN date >= DATE '{DAY}' THEN close * 2 ELSE close END AS close, volume FROM v_prices")
def replace_by_key(p):
    base, new = _loads(p)
    return writes.replace_by_key(base, new, ["ticker", "date"], ["seq"])


@query(
    "column_upsert", "v_factor_file",
    f"""SELECT date, CASE WHEN c.date IS NOT NULL THEN c.v ELSE s.v END AS mkt, s.v AS size FROM {_FILE.format("signup")} s FULL JOIN (SELECT * FROM {_FILE.format("click")} WHERE date >= DATE '2024-01-10') c USING (date)""",
)
def column_upsert(f):
    (signup, _), (click, _) = _files(f)[:2]
    return writes.column_upsert(signup, click.filter(F.col("date") >= "2024-01-10"), ["date"], ["mkt"])


@query(
    "preserve_upsert", "v_master",
    "SELECT ticker, CASE WHEN exchange = 'NYSE' THEN 'renamed' ELSE name END AS name, industry AS figi FROM v_master",
)
def preserve_upsert(m):
    old = m.select("ticker", "name", F.col("industry").alias("figi"))
    new = m.filter("exchange = 'NYSE'").select("ticker", F.lit("renamed").alias("name"), F.lit(None).cast("string").alias("figi"))
    return writes.preserve_upsert(old, new, ["ticker"], ["figi"])


query("dedup_first", "v_actions", "SELECT ticker, date, action, value FROM v_actions QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date, action, value) = 1")(
    lambda a: writes.first_by_key(a, ["ticker"], ["date", "action", "value"])
)

query(
    "keyed_update", "v_master v_prices",
    "SELECT m.ticker, coalesce(p.hi, m.lastpricedate) AS lastpricedate FROM v_master m LEFT JOIN (SELECT ticker, max(date) AS hi FROM v_prices WHERE volume > 40 GROUP BY ticker) p ON m.ticker = p.ticker",
)(lambda m, p: writes.keyed_update(m.select("ticker", "lastpricedate"), p.filter("volume > 40").groupBy("ticker").agg(F.max("date").alias("lastpricedate")), "ticker", ["lastpricedate"]))

query(
    "resume_worklist", "v_actions v_prices",
    "SELECT ticker FROM (SELECT DISTINCT ticker FROM v_actions) WHERE ticker NOT IN (SELECT ticker FROM v_prices GROUP BY ticker HAVING max(date) >= DATE '2001-10-28')",
)(lambda a, p: writes.worklist(a.select("ticker").distinct(), p, "ticker", F.lit(dt.date(2001, 10, 28))))

query("repeated_keys", "v_actions", "SELECT ticker, date, count(*) AS count FROM v_actions GROUP BY ticker, date HAVING count(*) > 1")(lambda a: writes.key_violations(a, ["ticker", "date"]))
