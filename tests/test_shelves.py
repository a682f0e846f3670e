import datetime as dt

from asofmill.sources import providers, shelves


def test_an_answer_opens_only_the_files_that_hold_its_rows(spark, monkeypatch):
    monkeypatch.setattr(shelves, "FILE", 40)
    opened, table = [], shelves._table
    rows = spark.range(1000).selectExpr("id", "CAST(id % 7 AS STRING) AS ticker", "DATE '2020-01-01' + CAST(id % 300 AS INT) AS day").coalesce(1)
    plain, ordered = shelves.lay(rows), shelves.lay(rows, "ticker", "day", "id")
    monkeypatch.setattr(shelves, "_table", lambda path: opened.append(path) or table(path))
    assert [r["id"] for r in plain.page(95, 60)] == list(range(95, 155)) and len(set(opened)) == 2
    assert [r["id"] for at in range(0, 1040, 13) for r in plain.page(at, 13)] == list(range(1000)) and plain.page(1000, 5) == []
    first, last = dt.date(2020, 1, 11), dt.date(2020, 4, 9)
    wanted = {r.id for r in rows.filter("ticker IN ('3', '5') AND day BETWEEN '2020-01-11' AND '2020-04-09'").collect()}
    del opened[:]
    assert {r["id"] for r in ordered.of(["3", "5", "none"], "day", first, last, 10_000)} == wanted and len(set(opened)) <= 12
    assert len(ordered.of(["3", "5"], "day", first, last, 50)) == 50


def test_many_batches_share_tasks_and_the_driver_holds_no_plan(spark, monkeypatch):
    monkeypatch.setattr(providers, "TASKS", 4)
    monkeypatch.setattr(providers, "RUN", 16)
    fetch = lambda tickers, a, b: [{"ticker": t, "v": i} for t in tickers for i in range(3)]
    expected = spark.range(400).selectExpr("CAST(id AS STRING) AS ticker", "2L AS expected")
    day = dt.date(2020, 1, 1)
    got = providers.by_ticker(spark, ["ticker", "v"], fetch, expected, (day, day), cap=20, most_rows=8)
    assert got.rdd.getNumPartitions() == 7  # a hundred batches
    assert got.distinct().count() == got.count() == 1200

