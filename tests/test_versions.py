"""Versioned tables: what a write touches, what a reader sees, what a death in between leaves."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofmill.operators import pit
from asofmill.operators.versions import Conflict, VersionedTable
from asofmill.sources.schemas import TABLES
from asofmill.warehouse import Warehouse

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType()), T.StructField("v", T.IntegerType())])


def day(text):
    return dt.date.fromisoformat(text)


def rows(spark, *values):
    return spark.createDataFrame([(k, day(d), v, n) for n, (k, d, v) in enumerate(values)], "k string, d date, v int, n int")


def table(spark, path):
    return VersionedTable(spark, str(path), SCHEMA, ("k", "d"), F.year("d"))


def held(t):
    return sorted((r.k, str(r.d), r.v) for r in t.read().collect())


def test_a_new_day_rewrites_its_partition_only(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert held(t) == [] and t.versions() == []
    done = t.merge(rows(spark, ("a", "2020-01-01", 1), ("a", "2021-01-01", 2), ("b", "2021-05-01", 3)), ["n"])
    assert (done.rows, done.parts, done.version) == (3, ["2020", "2021"], 1)
    before = t.parts()
    done = t.merge(rows(spark, ("b", "2021-05-02", 4), ("b", "2021-05-01", 5), ("b", "2021-05-01", 6)), ["n"], {"even": F.count_if(F.col("v") % 2 == 0)})
    assert (done.rows, done.figures, done.parts) == (3, {"even": 2}, ["2021"])
    assert t.parts()["2020"] == before["2020"] and t.parts()["2021"] != before["2021"]
    assert held(t) == [("a", "2020-01-01", 1), ("a", "2021-01-01", 2), ("b", "2021-05-01", 6), ("b", "2021-05-02", 4)]
    assert held(t) == sorted((r.k, str(r.d), r.v) for p in ("2020", "2021") for r in t.read([p]).collect()) and t.read(["1999"]).count() == 0
    assert t.merge(rows(spark).limit(0), ["n"]).version == 2 and t.versions() == [1, 2]


@pytest.mark.parametrize("step", ["_write", "_switch", "_tidy"])
def test_a_job_that_dies_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    t = table(spark, tmp_path / "t")
    t.merge(rows(spark, ("a", "2020-01-01", 1), ("b", "2021-01-01", 2)), ["n"])
    own = getattr(VersionedTable, step)

    def dies(self, *args):
        if step == "_tidy":
            raise KeyboardInterrupt
        own(self, *args) if step == "_write" else None
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedTable, step, dies)
    reader = table(spark, tmp_path / "t").read()
    with pytest.raises(KeyboardInterrupt):
        t.merge(rows(spark, ("a", "2020-01-01", 9)), ["n"])
    new = [("a", "2020-01-01", 9 if step == "_tidy" else 1), ("b", "2021-01-01", 2)]
    assert held(t) == new and sorted(r.v for r in reader.collect()) == [1, 2]  # a reader that had begun is not disturbed
    monkeypatch.setattr(VersionedTable, step, own)
    t.merge(rows(spark, ("a", "2020-01-01", 7)), ["n"])
    assert held(t) == [("a", "2020-01-01", 7), ("b", "2021-01-01", 2)]
    for _ in range(3):
        t.merge(rows(spark, ("a", "2020-01-01", 7)), ["n"])
    assert len(os.listdir(tmp_path / "t" / "_data")) <= 3 and os.listdir(tmp_path / "t" / "_staging") == []


def test_of_two_writers_one_fails(spark, tmp_path):
    t, other = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    t.merge(rows(spark, ("a", "2020-01-01", 1)), ["n"])
    with pytest.raises(Conflict):
        t.merge(rows(spark, ("a", "2020-01-01", 2)), ["n"], changed=lambda old, new: other.merge(rows(spark, ("a", "2020-01-01", 3)), ["n"]))
    assert held(t) == [("a", "2020-01-01", 3)]


def test_whole_tables_null_days_and_rows_that_came_before(spark, tmp_path):
    schema = T.StructType([*SCHEMA.fields, T.StructField("n", T.IntegerType())])
    t = VersionedTable(spark, str(tmp_path / "t"), schema, ("k", "d"), F.year("d"))
    none = spark.createDataFrame([("x", None, 1, 1)], "k string, d date, v int, n int")
    assert t.merge(none, ["n"], later="n").parts == ["none"]
    assert t.merge(none.withColumn("v", F.lit(5)), ["n"], later="n").parts == ["none"] and t.read().first().v == 1  # not later
    assert t.merge(none.withColumns({"v": F.lit(5), "n": F.lit(2)}), ["n"], later="n").rows == 1 and t.read().first().v == 5
    whole = VersionedTable(spark, str(tmp_path / "w"), SCHEMA, ("k",))
    whole.overwrite(rows(spark, ("a", "2020-01-01", 1)).drop("n"))
    assert whole.overwrite(whole.read().union(whole.read())).rows == 2 and whole.read().count() == 2
    assert whole.overwrite(whole.read().limit(0)).rows == 0 and whole.read().count() == 0


MASTER = "permaticker string, ticker string, src_table string, category string, isdelisted string, firstpricedate date, lastpricedate date"


def market(spark, n=6, sessions=90):
    import random

    chance, days, at = random.Random(5), [], day("2019-11-01")
    while len(days) < sessions:
        if at.weekday() < 5:
            days.append(at)
        at += dt.timedelta(1)
    quotes = [(f"T{i}", d, float(chance.randrange(2, 40)), chance.choice([0, 10, 50, 200])) for i in range(n) for d in days if chance.random() < (0.9 if i % 2 else 0.3)]
    prices = lambda some: spark.createDataFrame([(t, d, c, v, 1.0) for t, d, c, v in some], "ticker string, date date, close double, volume bigint, adjustment double")
    filings = spark.createDataFrame([(f"T{i}", "ARQ", day("2019-10-01"), day("2019-09-30"), 100.0 + i) for i in range(n)], "ticker string, dimension string, date date, reportperiod date, shareswa double")
    master = spark.createDataFrame([(f"P{i}", f"T{i}", "stocks", "Domestic Common Stock", "N", None, days[-20] if i == 1 else None) for i in range(n)], MASTER)
    return days, quotes, prices, filings, master


SCREEN = pit.Screen(min_price=10, min_mcap=1000, min_dvol=400, lookback=5, min_dvol_days=3, max_quote_age=7)


def test_history_from_changes_equals_a_whole_build(spark, tmp_path):
    days, quotes, prices, filings, master = market(spark)
    house = Warehouse(spark, str(tmp_path / "w"))
    house.upsert("securities_master", master)
    house.upsert("sf1", filings)
    late = [q for q in quotes if q[1] > days[70] or (q[0] == "T2" and q[1] > days[50]) or q[1] == days[60]]
    house.upsert("prices", prices([q for q in quotes if q not in late]))
    assert house.update_history(SCREEN) == house.table("universe_pit").count() > 0  # the first time it is built whole
    first = house.stored("universe_pit").parts()

    def same():
        want = pit.universe_history(house.table("prices"), house.table("securities_master"), house.table("sf1"), SCREEN)
        names = TABLES["universe_pit"].schema.names
        return sorted(map(repr, want.select(*names).collect())) == sorted(map(repr, house.table("universe_pit").select(*names).collect()))

    assert same() and house.update_history(SCREEN) == 0
    house.upsert("prices", prices(late))
    assert house.update_history(SCREEN) > 0 and same()
    assert house.stored("universe_pit").parts()["2019"] == first["2019"]  # no change reaches back that far
    house.upsert("prices", prices(quotes))  # nothing that was not there before
    assert house.ledger("changes", "table_name string, ticker string, first_day date, at bigint").agg(F.max("at")).first()[0] and house.update_history(SCREEN) == 0
    house.upsert("prices", prices([("T3", d, 1.0, 0) for d in days[50:55]]))  # quotes that no longer pass
    assert house.update_history(SCREEN) > 0 and same()
    house.upsert("sf1", filings.filter("ticker = 'T5'").withColumns({"shareswa": F.lit(1e6), "date": F.lit(days[45])}))
    assert house.update_history(SCREEN) > 0 and same()
    house.upsert("securities_master", master.filter("ticker = 'T1'").withColumn("category", F.lit("ETF")))
    house.update_history(SCREEN)
    assert same() and house.table("universe_pit").filter("ticker = 'T1'").count() == 0


def test_expected_sessions(spark):
    days = [day(f"2020-01-{d:02d}") for d in (2, 3, 6, 7, 8)]
    prices = spark.createDataFrame([("A", d) for d in days], "ticker string, date date")
    lives = [("A", None, None), ("B", day("2020-01-04"), day("2020-01-07")), ("C", day("2020-01-06"), day("2020-01-06")), ("D", day("2019-01-01"), day("2020-01-01")), ("E", day("2020-02-01"), None), ("F", day("2020-01-04"), day("2020-01-05"))]
    master = spark.createDataFrame(lives, "ticker string, firstpricedate date, lastpricedate date")
    expected = pit.sessions_expected(prices, master)
    assert {r.ticker: r.expected for r in expected.collect()} == {"A": 5, "B": 2, "C": 1, "D": 0, "E": 0, "F": 0}
    assert {r.ticker: r.expected for r in pit.sessions_expected(prices, master, day("2020-01-03"), day("2020-01-07")).collect()} == {"A": 3, "B": 2, "C": 1, "D": 0, "E": 0, "F": 0}
    held = spark.createDataFrame([("A", d) for d in days[:3]] + [("A", days[0]), ("C", days[2])], "ticker string, date date")
    assert sorted((r.ticker, r.expected, r.held) for r in pit.short_tickers(held, expected, slack=1).collect()) == [("A", 5, 3), ("B", 2, 0)]
