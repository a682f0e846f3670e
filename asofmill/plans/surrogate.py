"""Stand-ins for market tables over the star-schema test tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.writes import kept
from ..shipping import shared_folder

VIEWS = {
    "v_vendor_bars": """
SELECT ticker, date, o * sf AS open, h * sf AS high, l * sf AS low, c * sf AS close, c AS closeunadj,
       c * sf * (1.0E0 - 0.01E0 * (2001 - yr)) AS closeadj, volume
FROM (SELECT CAST(l_suppkey AS VARCHAR(20)) AS ticker, CAST(l_shipdate AS DATE) AS date, YEAR(l_shipdate) AS yr,
        CASE WHEN YEAR(l_shipdate) < 1998 THEN 0.25E0 WHEN YEAR(l_shipdate) < 2000 THEN 0.5E0 ELSE 1.0E0 END AS sf,
        MIN(l_extendedprice / l_quantity) AS l, MAX(l_extendedprice / l_quantity) AS h,
        (MIN(l_extendedprice / l_quantity) + MAX(l_extendedprice / l_quantity)) / 2.0E0 AS o,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / SUM(CAST(l_quantity AS BIGINT)) AS c,
        CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
      FROM lineitem GROUP BY 1, 2, 3, 4) b
""",
    "v_prices": """
SELECT ticker, date, open * (closeunadj / close) AS open, high * (closeunadj / close) AS high,
       low * (closeunadj / close) AS low, closeunadj AS close, volume, closeadj / closeunadj AS adjustment
FROM v_vendor_bars WHERE close <> 0 AND closeunadj <> 0
""",
    "v_master": """
SELECT CONCAT('P', CAST(s_suppkey AS VARCHAR(20))) AS permaticker, CAST(s_suppkey AS VARCHAR(20)) AS ticker, s_name AS name,
       CASE s_nationkey % 3 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'NASDAQ' ELSE 'NYSEMKT' END AS exchange,
       CASE WHEN s_suppkey % 7 = 0 THEN 'Y' ELSE 'N' END AS isdelisted,
       CASE s_suppkey % 5 WHEN 0 THEN 'Domestic Common Stock' WHEN 1 THEN 'Domestic Common Stock Primary Class'
            WHEN 2 THEN 'Domestic Common Stock Secondary Class' WHEN 3 THEN 'ADR Common Stock' ELSE 'ETF' END AS category,
       CASE WHEN s_suppkey % 5 = 4 THEN 'funds' ELSE 'stocks' END AS src_table,
       r_name AS sector, n_name AS industry, p.lo AS firstpricedate, p.hi AS lastpricedate
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT ticker, MIN(date) AS lo, MAX(date) AS hi FROM v_prices GROUP BY ticker) p ON p.ticker = CAST(s_suppkey AS VARCHAR(20))
""",
    "v_sf1": """
SELECT ticker, dimension, period_end AS reportperiod, period_end AS calendardate,
       CASE WHEN dimension = 'MRY' THEN period_end ELSE CAST(period_end + INTERVAL '45' DAY AS DATE) END AS date,
       revenue, gp, netinc, ncfo, assets, liabilities, assetsc, liabilitiesc,
       CASE WHEN sh > 0 THEN sh END AS shareswa, sh + 1.0E0 AS sharesbas
FROM (SELECT CAST(l_suppkey AS VARCHAR(20)) AS ticker, d.dimension,
        CASE WHEN d.dimension = 'ARQ' THEN MAKE_DATE(YEAR(l_shipdate), QUARTER(l_shipdate) * 3, 28)
             ELSE MAKE_DATE(YEAR(l_shipdate), 12, 31) END AS period_end,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS BIGINT) * 900) AS DOUBLE) AS gp,
        CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS netinc,
        CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END) AS DOUBLE) AS ncfo,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_partkey AS BIGINT)) AS DOUBLE) AS assets,
        CAST(SUM(CAST(l_partkey AS BIGINT)) AS DOUBLE) AS liabilities,
        CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS assetsc,
        CAST(SUM(CAST(l_linenumber AS BIGINT)) AS DOUBLE) AS liabilitiesc,
        CAST(SUM(CASE WHEN l_discount > 0.04 THEN CAST(l_quantity AS BIGINT) ELSE CAST(0 AS BIGINT) END) AS DOUBLE) AS sh
      FROM lineitem CROSS JOIN (SELECT 'ARY' AS dimension UNION ALL SELECT 'MRY' UNION ALL SELECT 'ARQ') d GROUP BY 1, 2, 3) x
""",
    "v_actions": """
SELECT DISTINCT CAST(user_id AS VARCHAR(20)) AS ticker, CAST(ts AS DATE) AS date, event_type AS action, CAST(value AS VARCHAR(30)) AS value
FROM events
""",
    "v_events": """
SELECT ticker, MIN(date) AS date, CASE WHEN yr IN (1998, 2000) THEN 'split' ELSE 'dividend' END AS action
FROM (SELECT ticker, date, YEAR(date) AS yr FROM v_prices) y WHERE (CAST(ticker AS INT) + yr) % 5 <> 0 GROUP BY ticker, yr
UNION ALL SELECT ticker, MIN(date) AS date, 'listed' AS action FROM v_prices GROUP BY ticker
UNION ALL SELECT ticker, MAX(date) AS date, 'delisted' AS action FROM v_prices WHERE CAST(ticker AS INT) % 7 = 0 GROUP BY ticker
""",
    "v_factor_file": """
SELECT event_type AS file, CAST(ts AS DATE) AS date,
       CASE WHEN COUNT(*) % 5 = 0 THEN -99.99E0 ELSE CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) END AS v
FROM events GROUP BY 1, 2
""",
}

#: Views that each view reads.
NEEDS = {"v_prices": ["v_vendor_bars"], "v_master": ["v_vendor_bars", "v_prices"], "v_events": ["v_vendor_bars", "v_prices"]}

TABLES = ("nation", "region", "supplier", "lineitem", "events")
#: Tables that registered queries read besides.
ALSO = ("orders", "documents")


def with_views(*names: str) -> str:
    """`WITH` clause of the named views and all that they need, for DuckDB."""
    wanted = {n for name in names for n in [name, *NEEDS.get(name, [])]}
    return "WITH " + ", ".join(f"{n} AS ({sql.strip()})" for n, sql in VIEWS.items() if n in wanted)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the Parquet tables in ``sf_dir``."""
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    needed = [n for n in VIEWS if n in NEEDS.get(name, [])]
    with_ = "WITH " + ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed) if needed else ""
    return spark.sql(f"{with_} {VIEWS[name].strip()}")


def kept_views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """v_prices (what the universe reads of it), v_master and v_sf1 for queries that read each of them several times.

    Each is worked out and written once, and v_master is made of the written prices: as plain views, every use adds up all line items anew.
    """
    folder = shared_folder(spark)
    prices = kept(view(spark, sf_dir, "v_prices").select("ticker", "date", "close", "volume"), folder)
    prices.createOrReplaceTempView("v_prices")
    try:
        master = kept(spark.sql(VIEWS["v_master"]), folder)
    finally:
        spark.catalog.dropTempView("v_prices")
    return prices, master, kept(view(spark, sf_dir, "v_sf1").select("ticker", "date", "dimension", "shareswa"), folder)
