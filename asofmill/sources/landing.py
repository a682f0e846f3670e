"""Vendor extracts: zipped CSV files to typed tables.

Archives are a data source of their own (``archives``), whose tasks inflate them; everything after is a scan of text columns.
Each loader counts, row by row, the texts that should have been numbers or days and were neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from . import archives
from .schemas import FACTOR_FILES, INDICATORS, TABLES

#: A column that says which of several rows of a key came last; loaders hand it on.
SEQUENCE = "__seq"
#: How many of a row's texts could not be read as what their column holds.
UNPARSED = "__unparsed"

# The vendor's price table codes and what they hold.
PRICE_TABLES = {"SEP": "stocks", "SFP": "funds"}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-driven CSV with every column as text; of an archive its first member, of a folder of archives the first member of each."""
    if path.endswith(".zip"):
        return archives.read(spark, path, members="first")
    return spark.read.option("header", True).option("multiLine", False).option("escape", '"').csv(path)


#: Vendor's names of columns that are called otherwise here; None for those that are made here.
VENDOR_NAMES = {
    "prices": {"adjustment": "closeadj"}, "metrics": {"as_of": "date"}, "descriptions": {"table_name": "table"}, "securities_master": {"src_table": "table"},
}


def missing_columns(rows: DataFrame, table: str) -> list[str]:
    """Columns that the vendor's file of a table is expected to have and lacks."""
    named = VENDOR_NAMES.get(table, {})
    return [n for n in (named.get(c, c) for c in TABLES[table].schema.names) if n not in rows.columns]


def _unparsed(pairs: list[tuple[Column, Column]]) -> Column:
    """How many of the texts say something that their parsed value does not."""
    out = F.lit(0)
    for text, value in pairs:
        out = out + (text.isNotNull() & ~F.lower(F.trim(text)).isin(*parse.NOTHING) & value.isNull()).cast("int")
    return out.alias(UNPARSED)


def _column(rows: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in rows.columns else F.lit(None).cast("string")


def _typed(rows: DataFrame, table: str, **given: Column) -> DataFrame:
    """The table's columns: given expressions, else the vendor's column of that name by the table's type."""
    out, told = [], []
    for f in TABLES[table].schema:
        kind = f.dataType.simpleString()
        source = _column(rows, f.name)
        value = given.get(f.name)
        if value is None:
            value = parse.number(source) if kind == "double" else parse.iso_date(source) if kind == "date" else source
            if f.name in rows.columns and kind in ("double", "date"):
                told.append((source, value))
        out.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*out, _unparsed(told), *[c for c in rows.columns if c == SEQUENCE])


def tickers(rows: DataFrame) -> DataFrame:
    """securities_master: stocks and funds, by the vendor's table code; other tables' rows go."""
    code = F.create_map(*[F.lit(x) for pair in PRICE_TABLES.items() for x in pair])
    made = _typed(rows, "securities_master", src_table=F.try_element_at(code, _column(rows, "table")))
    return made.filter(F.col("src_table").isNotNull())


def actions(rows: DataFrame) -> DataFrame:
    return _typed(rows, "corporate_actions")


def metrics(rows: DataFrame) -> DataFrame:
    return _typed(rows, "metrics", as_of=parse.iso_date(_column(rows, "date")))


def membership(rows: DataFrame) -> DataFrame:
    return _typed(rows, "sp500_membership")


def descriptions(rows: DataFrame) -> DataFrame:
    return _typed(rows, "descriptions", table_name=_column(rows, "table"))


def fundamentals(rows: DataFrame) -> DataFrame:
    """sf1: the filing date is ``datekey`` where it is set, else ``date``."""
    return _typed(rows, "sf1", date=parse.iso_date(F.coalesce(parse.filled(_column(rows, "datekey")), _column(rows, "date"))))


def prices(rows: DataFrame) -> DataFrame:
    """Prices as traded, from vendor bars."""
    from ..operators.prices import as_traded

    names = ("open", "high", "low", "close", "closeunadj", "closeadj", "volume")
    more = [c for c in rows.columns if c == SEQUENCE]
    day, values = parse.iso_date(F.col("date")), {c: parse.number(_column(rows, c)) for c in names}
    told = _unparsed([(F.col("date"), day), *[(_column(rows, c), v) for c, v in values.items() if c in rows.columns]])
    return as_traded(rows.select("ticker", day.alias("date"), *[v.alias(c) for c, v in values.items()], told, *more), UNPARSED, *more)


def factor_lines(lines: DataFrame, columns: str, header: str = "", seen: Observation | None = None) -> DataFrame:
    """date and the factor columns of a daily factor file, given its lines (column value).

    Comments and headers go: data lines begin with an eight-digit day. Values are taken by
    position; those that the line lacks are null. ``seen`` is told, as the lines pass, how many there are (n), how many values
    are no numbers (unparsed), and how many header lines (first field empty) do not begin with the names in ``header`` (drifted).
    """
    fields = F.split("value", ",")
    texts = [F.get(fields, F.lit(i)) for i, _ in enumerate(columns.split(), 1)]
    values = [parse.factor_number(t) for t in texts]
    is_data = F.col("value").rlike(r"^\s*\d{8}\s*,")
    made = lines.select("value", is_data.alias("__data"), *[v.alias(c) for v, c in zip(values, columns.split(), strict=True)], *( [] if seen is None else [_unparsed(list(zip([F.when(F.trim(t).isin(*parse.FACTOR_MISSING), None).otherwise(t) for t in texts], values, strict=True)))]))
    if seen is not None:
        made = made.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("__data"), F.col(UNPARSED))).alias("unparsed"), F.count_if(drifted(header)).alias("drifted"))
    day = parse.compact_date(F.get(fields, F.lit(0))).alias("date")
    return made.filter("__data").select(day, *columns.split())


def drifted(header: str) -> Column:
    """Whether a line (column value) is a header with other names than expected."""
    names = F.array(*[F.lit(n) for n in header.split()])
    got = F.transform(F.split("value", ","), lambda x: F.trim(x))
    return F.coalesce(F.col("value").rlike(r"^\s*,"), F.lit(False)) & (F.slice(got, 2, len(header.split())) != names)


def factor_file(spark: SparkSession, path: str, key: str, seen: Observation | None = None) -> DataFrame:
    """One of the registered factor files, from its archive or its unpacked text."""
    _, columns, header = FACTOR_FILES[key]
    return factor_lines(archives.read(spark, path, "first", lines=True) if path.endswith(".zip") else spark.read.text(path), columns, header, seen)


LOADERS = {
    "tickers": ("securities_master", tickers),
    "actions": ("corporate_actions", actions),
    "metrics": ("metrics", metrics),
    "sp500": ("sp500_membership", membership),
    "descriptions": ("descriptions", descriptions),
    "fundamentals": ("sf1", fundamentals),
    "stocks": ("prices", prices),
    "funds": ("prices", prices),
}

assert len(INDICATORS) == 105
