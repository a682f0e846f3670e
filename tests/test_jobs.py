"""Loaders, syncing, providers, streaming and the command line, with the network played by fakes."""

import datetime as dt
import json
import os
import time
import zipfile

import pytest

from pyspark.sql import functions as F

from asofmill import cli
from asofmill.sources import landing, providers, sync
from asofmill.sources.schemas import TABLES
from asofmill.streaming.incremental import follow, followed
from asofmill.warehouse import Warehouse

BARS = "ticker,date,open,high,low,close,volume,closeadj,closeunadj,lastupdated\n"


def zipped(folder, name, text):
    path = folder / f"{name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(f"{name}.csv", text)
    return str(path)


def test_loaders(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    house.load("stocks", zipped(tmp_path, "SEP", BARS + "A,2020-01-02,1,1,1,1.5,10,1.4,3.0,x\nA,2020-01-02,1,1,1,2,10,2,2,x\nB,2020-01-03,N/A,,1,2,7.9,,2,x\n"))
    rows = {r.ticker: r for r in house.table("prices").collect()}
    assert rows["A"].close == 2.0 and rows["B"].open is None and rows["B"].volume == 7 and rows["B"].adjustment == 1.0
    assert house.load("tickers", zipped(tmp_path, "TICKERS", "table,permaticker,ticker,name,isdelisted,category,lastpricedate\nSEP,1,A,Alpha,N,ADR,2020-01-02\nSFP,2,F,Fund,N,ETF,\nSF1,1,A,x,N,y,\n")) == 2
    assert {r.src_table for r in house.table("securities_master").collect()} == {"stocks", "funds"}
    house.load("fundamentals", zipped(tmp_path, "SF1", "ticker,dimension,datekey,date,reportperiod,calendardate,assets,netinc\nA,ARY,2021-02-01,2021-02-02,2020-12-31,2020-12-31,1e9,nan\nB,ARQ,,2021-03-01,2020-12-31,2020-12-31,5,6\n"))
    sf1 = {r.ticker: r for r in house.table("sf1").collect()}
    assert str(sf1["A"].date) == "2021-02-01" and sf1["A"].netinc is None and sf1["A"].assets == 1e9 and str(sf1["B"].date) == "2021-03-01"
    house.load("descriptions", zipped(tmp_path, "IND", "table,indicator,title\nSF1,assets,Assets\n"))
    house.load("metrics", zipped(tmp_path, "MET", "ticker,date,price,beta1y\nA,2020-01-02,5,1.1\n"))
    house.load("actions", zipped(tmp_path, "ACT", "ticker,date,action,value\nA,2020-01-02,split,2\nA,2020-01-02,split,2\n"))
    house.load("sp500", zipped(tmp_path, "SP5", "ticker,date,action\nA,2020-01-02,added\n"))
    status = {r.name: r.n_rows for r in house.status().collect()}
    loads = {r.source: r for r in house.loads().collect()}
    assert (loads["stocks"].n_read, loads["stocks"].n_rows, loads["stocks"].n_unparsed, loads["stocks"].drift) == (3, 3, 0, None)
    assert (loads["tickers"].n_read, loads["tickers"].n_rejected) == (3, 1) and "siccode" in loads["tickers"].drift and loads["fundamentals"].parts == "2020"
    assert (status["descriptions"], status["metrics"], status["corporate_actions"], status["sp500_membership"]) == (1, 1, 1, 1)
    assert house.derive()["quarterly_statements"] == 1
    assert house.optimize()["prices"]["rows"] == 2
    assert [r.close for r in house.adjusted_prices("A").collect()] == [2.0]
    with pytest.raises(ValueError):
        house.adjusted_prices("A", as_of=dt.date(2000, 1, 1))


def test_factor_precedence_and_reload(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    three = zipped(tmp_path, "three", "notes\n,Mkt-RF,SMB,HML,RF\n19630701,1,2,3,4\n19260701,5,6,7,8\n")
    five = zipped(tmp_path, "five", ",Mkt-RF,SMB,HML,RMW,CMA,RF\n19630701,10,20,30,40,50,60\n")
    mom = zipped(tmp_path, "mom", ",Mom\n19630701,-99.99\n")
    for key, path in (("3f", three), ("5f", five), ("mom", mom), ("3f", three), ("mom", mom)):
        house.load_factor_file(key, path)
    rows = {str(r.date): r for r in house.table("french_factors").collect()}
    assert rows["1963-07-01"].smb == 20 and rows["1963-07-01"].cma == 50 and rows["1963-07-01"].mom is None
    assert rows["1926-07-01"].smb == 6 and rows["1926-07-01"].rmw is None and len(rows) == 2


class Fake:
    def __init__(self, files, busy=0):
        self.files, self.busy, self.asked = files, busy, []

    def get_json(self, url):
        return json.loads(self.files[url])

    def get_bytes(self, url):
        self.asked.append(url)
        if self.busy:
            self.busy -= 1
            raise sync.Busy(2)
        yield self.files[url]

    def stamp(self, url):
        return "s"


def test_sync_skips_what_has_not_changed_and_retries_failed_loads(tmp_path):
    fake, waits, loaded = Fake({"u/a.zip": b"1", "u/b.zip": b"2"}, busy=1), [], []

    def load(name, path):
        loaded.append(name)
        if len(loaded) == 2:
            raise RuntimeError("load failed")
        return 7

    wanted = {"a": ("u/a.zip", "1"), "b": ("u/b.zip", "1")}
    with pytest.raises(RuntimeError):
        sync.sync(fake, str(tmp_path), wanted, load, sleep=waits.append)
    assert sync.sync(fake, str(tmp_path), wanted, load, sleep=waits.append) == {"a": None, "b": 7}
    assert sync.sync(fake, str(tmp_path), wanted, load) == {"a": None, "b": None} and waits == [2]
    assert sync.sync(fake, str(tmp_path), wanted, load, force=True) == {"a": 7, "b": 7}


def test_batches():
    assert providers.size_batches({"a": 10, "b": 25, "c": 40, "d": 1}, most_rows=30) == [["a"], ["b"], ["c"], ["d"]]
    assert providers.size_batches({str(i): 1 for i in range(5)}, most_names=2) == [["0", "1"], ["2", "3"], ["4"]]


def test_providers(spark):
    text = '﻿Fund Name\nFund Holdings as of,"Aug 07, 2026"\n\nTicker,Name,Sector,Weight (%)\nAAA,Alpha,Energy,"1,000.5"\n,Cash,,\n-,Dash,,\n'
    rows, when = providers.fund_holdings(spark, text)
    assert [tuple(r) for r in rows.collect()] == [("AAA", "Alpha", "Energy", 1000.5)] and when == dt.date(2026, 8, 7)
    fund = lambda *own: spark.createDataFrame(own, "ticker string, name string, sector string")
    joint = providers.joint_holdings([fund(("a", "first", "s"), ("", None, None), (None, "x", None)), fund(("A ", "second", "t"), ("B", "b", None))])
    assert sorted(tuple(r) for r in joint.collect()) == [("A", "first", "s"), ("B", "b", None)]
    waits, answers = [], iter([sync.Busy(), [{"data": [{"figi": "F1"}]}, {"warning": "none"}]])

    def post(jobs):
        answer = next(answers)
        if isinstance(answer, Exception):
            raise answer
        return answer

    assert [tuple(r) for r in providers.figi_lookup(spark, ["A", "B"], post, waits.append).collect()] == [("A", "F1")] and waits == [1.0]
    assert [tuple(r) for r in providers.cik_lookup(spark, '{"0": {"ticker": "aa", "cik_str": 320193}}').collect()] == [("AA", "0000320193")]
    assert providers.company_lookup(spark, ["1", "2"], {"1": {"sic": "7", "sicDescription": "d", "lei": None}}.get).count() == 1


def test_paged_source(spark):
    def fetch(offset, limit):
        return [{"a": i, "b": None} for i in range(offset, min(offset + limit, 25))]

    assert sorted(int(r.a) for r in providers.paged(spark, ["a", "b"], fetch, page=4, lanes=3).collect()) == list(range(25))


def day(text):
    return dt.date.fromisoformat(text)


def test_answers_that_reach_the_cap_are_asked_for_in_parts(spark):
    first, last = day("2020-01-01"), day("2020-03-30")
    table = [{"ticker": t, "date": first + dt.timedelta(d), "v": t * 2} for t, n in (("A", 80), ("B", 3), ("C", 5), ("D", 1)) for d in range(n)]

    def fetch(tickers, a, b):
        return [r for r in table if r["ticker"] in tickers and a <= r["date"] <= b][:20]  # an answer of 20 rows may have been cut

    expected = spark.createDataFrame([("A", 4), ("B", 4), ("C", 4), ("D", 4), ("E", 4), (None, 4)], "ticker string, expected long")
    got = providers.by_ticker(spark, ["ticker", "date", "v", "w"], fetch, expected, (first, last), cap=20, most_rows=16)
    assert got.rdd.getNumPartitions() == 2  # four and one of the planned tickers
    assert sorted((r.ticker, r.date, r.v, r.w) for r in got.collect()) == sorted((r["ticker"], str(r["date"]), r["v"], None) for r in table)
    full = lambda tickers, a, b: [{"ticker": "A", "date": a}] * 20
    with pytest.raises(Exception, match="do not fit"):
        providers.by_ticker(spark, ["ticker", "date"], full, expected, (first, first), cap=20).collect()
    assert providers.by_ticker(spark, ["ticker"], full, expected.limit(0), (first, last)).count() == 0


def vendor():
    """The class below, by value: executors don't import tests."""

    class Vendor:
        """A provider over rows at hand that may fail for some tickers; a lone ticker gets all its rows, several only so many each."""

        columns = {"stocks": BARS.strip().split(","), "actions": ["ticker", "date", "action", "value"]}

        def __init__(self, table, log, bad=(), most=1000):
            self.table, self.log, self.bad, self.most = table, log, bad, most

        def rows(self, what, tickers, first, last):
            if set(tickers) & set(self.bad):
                raise RuntimeError("the server failed")
            with open(self.log, "a") as f:
                f.write(",".join(tickers) + "\n")
            own = [r for r in self.table if r["ticker"] in tickers and str(first) <= r["date"] <= str(last)]
            return own if len(tickers) == 1 else [r for t in tickers for r in [x for x in own if x["ticker"] == t][: self.most]]

        def page(self, what, offset, limit):
            return self.table[offset : offset + limit]

    return Vendor


def test_pulls_go_on_with_what_is_left(spark, tmp_path):
    house, log, Vendor = Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "asked"), vendor()
    table = [{"ticker": t, "date": str(day("2020-01-01") + dt.timedelta(i)), "close": "2", "closeunadj": "4", "closeadj": "1" if i else "x"} for t in "ABC" for i in range(60)]
    members = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    span = {"start": day("2020-01-01"), "end": day("2020-02-29")}
    with pytest.raises(Exception, match="the server failed"):
        house.pull(Vendor(table, log, bad=("C",)), "stocks", members, **span)
    assert house.table("prices").count() == 0
    assert house.pull(Vendor(table, log), "stocks", members.filter("ticker != 'C'"), **span) == 120
    open(log, "w").close()
    assert house.pull(Vendor(table, log), "stocks", members, **span) == 60 and open(log).read().split() == ["C"]
    assert house.pull(Vendor(table, log), "stocks", members, upto=day("2020-02-29"), **span) == 0
    assert house.pull(Vendor(table, log), "stocks", members, force=True, **span) == 180
    assert house.table("prices").count() == 180 and [r.n_unparsed for r in house.loads().orderBy("loaded_at").collect()] == [2, 1, 0, 3]
    # answers that came back short are asked for again, one ticker at a time
    lives = spark.createDataFrame([(t, t, "stocks", day("2020-01-01"), day("2020-02-29")) for t in "ABC"], "permaticker string, ticker string, src_table string, firstpricedate date, lastpricedate date")
    house.upsert("securities_master", lives)
    short = Warehouse(spark, str(tmp_path / "v"))
    short.upsert("securities_master", lives)
    short.upsert("prices", house.table("prices").filter("ticker = 'A'"))
    open(log, "w").close()
    assert short.pull(Vendor(table, log, most=10), "stocks", members, **span) == 120
    assert sorted(open(log).read().split()) == ["B", "B,C", "C"]
    actions = [{"ticker": "A", "date": "2020-01-02", "action": "split", "value": i} for i in range(7)]
    assert house.pull_whole(Vendor(actions, log), "actions", page=3, lanes=2) == 7


def test_stream_of_landed_files(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "prices")
    folder.mkdir()
    columns = BARS.strip().split(",")
    (folder / "1.csv").write_text(BARS + "A,2020-01-02,1,1,1,1,10,1,1,x\nB,2020-01-02,1,1,1,5,10,5,5,x\n")

    def run():
        follow(spark, str(folder), columns, landing.prices, "prices", path, str(tmp_path / "state"), day="date").awaitTermination(120)
        return {r.ticker: r.close for r in followed(spark, "prices", path).read().collect()}

    assert run() == {"A": 1.0, "B": 5.0}
    later = time.time() + 100
    (folder / "2.csv").write_text(BARS + "A,2020-01-02,1,1,1,2,10,2,2,x\n")
    os.utime(folder / "2.csv", (later, later))
    assert run() == {"A": 2.0, "B": 5.0} and run() == {"A": 2.0, "B": 5.0}
    # a file that was written before arrives after: its rows change nothing where a later file has spoken
    (folder / "0.csv").write_text(BARS + "A,2020-01-02,1,1,1,9,10,9,9,x\nC,2021-01-02,1,1,1,7,10,7,7,x\n")
    os.utime(folder / "0.csv", (later - 50, later - 50))
    assert run() == {"A": 2.0, "B": 5.0, "C": 7.0}
    # all files once more, as after a lost checkpoint
    follow(spark, str(folder), columns, landing.prices, "prices", path, str(tmp_path / "another"), day="date").awaitTermination(120)
    assert run() == {"A": 2.0, "B": 5.0, "C": 7.0} and sorted(followed(spark, "prices", path, "date").parts()) == ["2020", "2021"]
    assert Warehouse(spark, str(tmp_path)).table("prices").count() == 3


def test_command_line(spark, tmp_path, capsys):
    base = ["--warehouse", str(tmp_path / "w")]
    sep = zipped(tmp_path, "SEP", BARS + "A,2020-01-02,1,1,1,1.5,10,1.5,1.5,x\n")
    assert cli.run(spark, [*base, "load-bulk", "stocks", sep]) == 1
    assert cli.run(spark, [*base, "prices", "a"])[0][5] == 1.5
    assert cli.run(spark, [*base, "build-piotroski"]) == 0 and cli.run(spark, [*base, "build-ratios", "--as-of", "2020-01-01"]) == 0
    assert cli.run(spark, [*base, "build-universe-pit", "--history"]) == 0
    assert cli.run(spark, [*base, "build-universe-pit", "--changed", "--types", "ETF, ADR"]) == 0
    (tmp_path / "h.csv").write_text("x\nTicker,Name,Sector,Weight (%)\nA,Alpha,Energy,1\n")
    assert cli.run(spark, [*base, "update-universe", str(tmp_path / "h.csv")]) == 1
    assert [r.sector for r in Warehouse(spark, base[1]).table("classifications").collect()] == ["Energy"]
    with open(sep, "rb") as f:
        fake = Fake({"s": json.dumps([{"table": "stocks", "files": [{"history": "full", "name": "SEP.zip", "modified": "m"}]}]), "u/SEP.zip": f.read()})
    bulk = ["--status-url", "s", "--base-url", "u", "--folder", str(tmp_path / "land")]
    assert cli.run(spark, [*base, "bulk-update", *bulk], fake)["stocks"] == 1
    assert cli.run(spark, [*base, "bulk-update", *bulk], fake) == {"stocks": None}
    assert cli.run(spark, [*base, "bulk-update", *bulk, "--tables", "actions"], fake) == {}
    assert cli.run(spark, [*base, "bulk-update", *bulk, "--tables", "stocks", "--force", "--no-derive"], fake) == {"stocks": 1}
    assert "universe_pit" not in cli.run(spark, [*base, "bulk-update", *bulk, "--force", "--no-pit"], fake)
    assert cli.run(spark, [*base, "bulk-fromzero", *bulk], fake)["stocks"] == 1
    assert dict((r[0], r[1]) for r in cli.run(spark, [*base, "status"]))["prices"] == 1
    assert cli.ticker_list(" a, B,,") == ["A", "B"]
    for wrong in (["no-such"], [*base, "bulk-update", *bulk, "--tables", "no-such"]):
        with pytest.raises(SystemExit):
            cli.run(spark, wrong, fake)


def test_classify_keeps_known_industries(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([("A", "Technology", "Chips"), ("B", "Energy", "Oil"), ("C", "Energy", "Gas")], "ticker string, sector string, industry string")
    house.upsert("securities_master", rows.withColumn("permaticker", F.col("ticker")).withColumn("src_table", F.lit("stocks")))
    day = dt.date(2024, 1, 2)
    old = spark.createDataFrame([("A", "Old", "Semiconductors", day), ("B", "Old", None, day)], "ticker string, sector string, industry string, as_of date")
    house.upsert("classifications", old)
    assert house.classify(dt.date(2024, 2, 1)) == 3
    got = {r.ticker: r for r in house.table("classifications").collect()}
    assert {t: r.industry for t, r in got.items()} == {"A": "Semiconductors", "B": "Oil", "C": "Gas"}
    assert {r.as_of for r in got.values()} == {dt.date(2024, 2, 1)} and "Old" not in {r.sector for r in got.values()}


def test_a_factor_file_is_watched_as_it_is_loaded(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"))
    assert house.load_factor_file("mom", zipped(tmp_path, "mom", "notes\n,Momentum\n19630701,1.5\n19630702,abc\n19630703,-99.99\n")) == 3
    load = house.loads().first()
    assert (load.n_read, load.n_rows, load.n_unparsed, load.drift) == (3, 3, 1, "1 header lines")
    assert house.load_factor_file("st_rev", zipped(tmp_path, "st", ",ST_Rev\n19630701,1.5\n")) == 1
    assert house.loads().filter("source = 'st_rev'").first().drift is None
    assert {r.row_count for r in house.pulled().collect()} == {3, 1} and house.table("french_factors").count() == 3
    fake = Fake({"u/F-F_Momentum_Factor_daily_CSV.zip": open(tmp_path / "mom.zip", "rb").read()})
    wanted = {"mom": ("u/F-F_Momentum_Factor_daily_CSV.zip", "s")}
    (tmp_path / "land").mkdir()
    assert house.update_factors(fake, str(tmp_path / "land"), wanted) == {"mom": 3}
    assert house.update_factors(fake, str(tmp_path / "land"), wanted) == {"mom": None}
    assert house.table("descriptions").filter("table_name = 'french_factors'").count() == 10


def test_members_get_only_what_they_lack(spark, tmp_path):
    house, asked = Warehouse(spark, str(tmp_path)), []
    house.upsert("universe", spark.createDataFrame([("A", "F0", None, None), ("B", None, "1", None), ("C", "", "2", "7")], "ticker string, figi string, cik string, sic string"))

    def figis(tickers):
        asked.append(tickers)
        return spark.createDataFrame([("B", "F1")], "ticker string, figi string")

    def companies(ciks):
        asked.append(ciks)
        return spark.createDataFrame([("1", "10", "d", None), ("9", "90", "e", None)], "cik string, sic string, sic_description string, lei string")

    ciks = spark.createDataFrame([("A", "9"), ("B", "8")], "ticker string, cik string")
    assert house.enrich_all(figis, ciks, companies) == {"figi": 1, "cik": 1, "sic": 2}
    assert asked == [["B", "C"], ["1", "9"]]
    got = {r.ticker: (r.figi, r.cik, r.sic) for r in house.table("universe").collect()}
    assert got == {"A": ("F0", "9", "90"), "B": ("F1", "1", "10"), "C": ("", "2", "7")}


def test_statements_name_the_filing_date(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    rows = [("A", "ARY", day("2022-02-01"), day("2021-12-31"), day("2021-12-31"), 2.0), ("A", "ARY", day("2021-02-01"), day("2020-12-31"), day("2020-12-31"), 1.0), ("A", "MRY", day("2020-12-31"), day("2020-12-31"), day("2020-12-31"), 3.0)]
    house.upsert("sf1", spark.createDataFrame(rows, "ticker string, dimension string, date date, reportperiod date, calendardate date, assets double"))
    got = house.statements("A", "ARY")
    assert "date" not in got.columns and [(r.datekey, r.assets) for r in got.collect()] == [(day("2021-02-01"), 1.0), (day("2022-02-01"), 2.0)]
