"""Vendors' network tables as DataFrames, and identifiers from public registries."""

from __future__ import annotations

import csv
import datetime as dt
import io
import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.parse import cik
from ..operators import pit
from ..shipping import shared_folder, ship
from .sync import Busy, patiently


class Provider(Protocol):
    """What a vendor gives: each table as text rows, by tickers and days or by pages; ``Warehouse.pull`` loads them."""

    #: Columns of each table, by the name of its loader.
    columns: dict[str, list[str]]

    def rows(self, table: str, tickers: list[str], first: dt.date, last: dt.date) -> list[dict]: ...

    def page(self, table: str, offset: int, limit: int) -> list[dict]: ...


def csv_rows(text: str) -> list[dict[str, str]]:
    return list(csv.DictReader(io.StringIO(text)))


def text_frame(spark: SparkSession, rows: list[dict], columns: list[str]) -> DataFrame:
    """Vendor rows as text columns; what a row lacks is null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([tuple(None if r.get(c) is None else str(r[c]) for c in columns) for r in rows], schema)


#: Tasks that batches of tickers are dealt to, one each, up to so many; then so many batches a task.
TASKS, RUN = 200, 64


class _Pages(InputPartition):
    def __init__(self, first: int, step: int):
        self.first, self.step = first, step


def _texts(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    """Vendor rows as text columns; what a row lacks is null."""
    return pa.RecordBatch.from_arrays([pa.array([None if r.get(n) is None else str(r[n]) for r in rows], pa.string()) for n in names], names=names)


class PagedReader(DataSourceReader):
    """A table by offset and limit: each of ``lanes`` partitions reads every lanes-th page until a short one."""

    def __init__(self, names: list[str], fetch: Callable[[int, int], list[dict]], page: int, lanes: int):
        self.names, self.fetch, self.page, self.lanes = names, fetch, page, lanes

    def partitions(self) -> list[InputPartition]:
        return [_Pages(i, self.lanes) for i in range(self.lanes)]

    def read(self, partition: _Pages) -> Iterator[pa.RecordBatch]:
        at = partition.first
        while True:
            rows = patiently(lambda at=at: self.fetch(at * self.page, self.page))
            if rows:
                yield _texts(rows, self.names)
            if len(rows) < self.page:
                return
            at += partition.step


#: Asks for tickers between two days, both included.
TickerFetch = Callable[[list[str], dt.date, dt.date], list[dict]]


def answers(tickers: list[str], days: tuple[dt.date, dt.date], fetch: TickerFetch, cap: int) -> Iterator[list[dict]]:
    """Whole answers for a batch of tickers, planned so that its rows stay below the server's ``cap``.

    Sizes are estimates (the sessions a life spans), so an answer may still reach the cap, and what reaches it may be cut: its tickers
    are halved until each answer is whole. A ticker that alone reaches the cap is asked for in pieces of its days, halved likewise.
    """
    todo = [(tickers, *days)]
    while todo:
        own, first, last = todo.pop()
        rows = patiently(lambda own=own, first=first, last=last: fetch(own, first, last))
        if len(rows) < cap:
            if rows:
                yield rows
        elif len(own) > 1:
            todo += [(own[len(own) // 2 :], first, last), (own[: len(own) // 2], first, last)]
        elif first < last:
            middle = first + (last - first) // 2
            todo += [(own, middle + dt.timedelta(1), last), (own, first, middle)]
        else:
            raise ValueError(f"{own[0]} has {len(rows)} rows or more on {first}: a day's rows do not fit an answer")


def batches_of(sizes: Iterable[tuple[str, int]], most_rows: int, most_names: int) -> Iterator[list[str]]:
    """Names in order, in batches that keep both bounds; a name that alone passes ``most_rows`` is a batch."""
    own: list[str] = []
    total = 0
    for name, rows in sizes:
        if own and (total + rows > most_rows or len(own) == most_names):
            yield own
            own, total = [], 0
        own.append(name)
        total += rows
    if own:
        yield own


def size_batches(rows_of: dict[str, int], most_rows: int = 30_000, most_names: int = 28) -> list[list[str]]:
    return list(batches_of(rows_of.items(), most_rows, most_names))


def _source(given: str, columns: list[str], make: Callable[[], DataSourceReader]) -> type[DataSource]:
    table = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    class Vendor(DataSource):
        @classmethod
        def name(cls) -> str:
            return given

        def schema(self) -> T.StructType:
            return table

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return make()

    return Vendor


def paged(spark: SparkSession, columns: list[str], fetch: Callable[[int, int], list[dict]], page: int = 10_000, lanes: int = 4) -> DataFrame:
    """A whole table as text columns, pulled page by page on the executors: ``fetch(offset, limit)``."""
    ship(spark)
    name = f"paged_{uuid.uuid4().hex[:8]}"
    spark.dataSource.register(_source(name, columns, lambda: PagedReader(columns, fetch, page, lanes)))
    return spark.read.format(name).load()


def by_ticker(
    spark: SparkSession, columns: list[str], fetch: TickerFetch, expected: DataFrame, days: tuple[dt.date, dt.date], cap: int = 50_000, most_rows: int = 30_000, most_tickers: int = 28
) -> DataFrame:
    """Rows of the tickers in ``expected`` (ticker, expected rows) as text columns, fetched on the executors in batches by size.

    The plan (a name and a number for each ticker) is written once and dealt to tasks by ranges of names; each makes the batches of its
    own names, ``RUN`` of them or so where there are many. The driver learns two totals.
    """
    ship(spark)
    path = f"{shared_folder(spark)}/tickers-{uuid.uuid4().hex[:12]}"
    own = expected.filter("ticker IS NOT NULL").groupBy(F.col("ticker").cast("string").alias("ticker")).agg(F.coalesce(F.max("expected"), F.lit(0)).cast("long").alias("expected"))
    own.write.parquet(path)
    plan = spark.read.schema("ticker string, expected long").parquet(path)
    names, rows = plan.agg(F.count(F.lit(1)), F.coalesce(F.sum("expected"), F.lit(0))).first()
    if not names:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    batches = min(names, max(-(-rows // most_rows), -(-names // most_tickers), 1))
    tasks = max(min(batches, TASKS), -(-batches // RUN))

    def read(planned: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = (pair for some in planned for pair in zip(*[c.to_pylist() for c in some.columns], strict=True))
        for batch in batches_of(sizes, most_rows, most_tickers):
            for found in answers(batch, days, fetch, cap):
                yield _texts(found, columns)

    dealt = plan.repartitionByRange(tasks, "ticker").sortWithinPartitions("ticker")
    return dealt.mapInArrow(read, ", ".join(f"`{c}` string" for c in columns))


def refetched(rows: DataFrame, expected: DataFrame, again: Callable[[DataFrame], DataFrame], slack: int = 20) -> DataFrame:
    """``rows`` (text; ticker, date), and those of tickers with over ``slack`` sessions fewer than expected fetched once more, alone; rows that both have count once."""
    short = pit.short_tickers(rows.withColumn("date", F.col("date").try_cast("date")), expected, slack)
    return rows.unionByName(again(short.select("ticker", "expected"))).distinct()


# ---- holdings ----

_AS_OF = re.compile(r'as of[",:\s]*"?([A-Z][a-z]{2} \d{1,2}, \d{4})')


def fund_holdings(spark: SparkSession, text: str) -> tuple[DataFrame, dt.date | None]:
    """ticker, name, sector, weight of a fund's holdings file, and its day. A preamble comes before the header; rows without ticker go."""
    lines = text.lstrip("﻿").splitlines()
    head = next((i for i, line in enumerate(lines) if line.startswith("Ticker,")), len(lines))
    found = _AS_OF.search("\n".join(lines[:head]))
    day = dt.datetime.strptime(found[1], "%b %d, %Y").date() if found else None
    rows = csv_rows("\n".join(lines[head:]))
    frame = text_frame(spark, rows, ["Ticker", "Name", "Sector", "Weight (%)"]).toDF("ticker", "name", "sector", "weight")
    ticker = F.trim("ticker")
    return frame.filter(ticker.isNotNull() & ~ticker.isin("", "-")).select(ticker.alias("ticker"), "name", "sector", F.regexp_replace("weight", ",", "").try_cast("double").alias("weight")), day


def joint_holdings(funds: list[DataFrame]) -> DataFrame:
    """ticker, name, sector of several funds' holdings (ticker, name, sector), one row per ticker in upper case: the first fund that has it counts."""
    from ..operators.writes import first_by_key

    ticker = F.upper(F.trim("ticker"))
    parts = [f.select(F.lit(i).alias("nth"), ticker.alias("ticker"), "name", "sector") for i, f in enumerate(funds)]
    rows = reduce(DataFrame.unionByName, parts).filter(F.coalesce(F.col("ticker"), F.lit("")) != "")
    return first_by_key(rows, ["ticker"], ["nth", "name", "sector"]).drop("nth")


# ---- identifiers ----


def figi_lookup(spark: SparkSession, tickers: list[str], post: Callable[[list[dict]], list[dict]], sleep: Callable[[float], None], size: int = 10) -> DataFrame:
    """ticker, figi from a mapping service that takes ``size`` tickers at a time; those it does not know are left out."""
    out = []
    for own in [tickers[i : i + size] for i in range(0, len(tickers), size)]:
        jobs = [{"idType": "TICKER", "idValue": t, "exchCode": "US"} for t in own]
        for ticker, answer in zip(own, patiently(lambda jobs=jobs: post(jobs), attempts=6, sleep=sleep), strict=True):
            if found := (answer.get("data") or [None])[0]:
                out.append((ticker, found.get("figi")))
    return spark.createDataFrame(out, "ticker string, figi string")


def cik_lookup(spark: SparkSession, document: str | dict) -> DataFrame:
    """ticker (upper case), cik (ten digits) from the registry's numbered entries."""
    entries = json.loads(document) if isinstance(document, str) else document
    rows = [(str(e["ticker"]), str(e["cik_str"])) for e in entries.values()]
    return spark.createDataFrame(rows, "ticker string, cik string").select(F.upper("ticker").alias("ticker"), cik(F.col("cik")).alias("cik"))


def company_lookup(spark: SparkSession, ciks: list[str], get: Callable[[str], dict | None]) -> DataFrame:
    """cik, sic, sic_description, lei from one document per company; companies without one are left out."""
    found = [(c, get(c)) for c in ciks]
    rows = [(c, d.get("sic"), d.get("sicDescription"), d.get("lei")) for c, d in found if d]
    return spark.createDataFrame(rows, "cik string, sic string, sic_description string, lei string")


def busy_on(status: int, retry_after: str | None) -> None:
    """Raise ``Busy`` for a status that means "later"."""
    if status in (429, 503):
        raise Busy(float(retry_after) if retry_after and retry_after.isdigit() else None)
