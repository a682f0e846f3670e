"""Hand-computed cases of the market operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from asofmill.operators import analytics, asof, factors, fundamentals, pit, prices, selection, writes
from asofmill.sources import landing
from asofmill.sources.schemas import INDICATORS, TABLES, sector_of

BAR = "ticker string, date date, open double, high double, low double, close double, closeunadj double, closeadj double, volume double"
PRICE = "ticker string, date date, open double, high double, low double, close double, volume bigint, adjustment double"
FILING = "ticker string, dimension string, date date, reportperiod date, calendardate date, shareswa double"


def day(text):
    return dt.date.fromisoformat(text)


def close_to(x):
    return pytest.approx(x, rel=1e-12)


def test_prices_as_traded(spark):
    rows = [
        ("A", day("2020-01-02"), 26.102, 26.9, 25.0, 26.512, 106.05, 24.12, 100.9),
        ("A", day("2020-01-03"), 1.0, 1.0, 1.0, 0.0, 5.0, 4.0, 3.0),
        ("A", day("2020-01-06"), 1.0, 2.0, 0.5, 1.5, None, 1.4, 3.0),
        ("A", day("2020-01-07"), 1.0, 2.0, 0.5, 1.5, 3.0, 0.0, None),
    ]
    got = {r.date.day: r for r in prices.as_traded(spark.createDataFrame(rows, BAR)).collect()}
    assert got[2].close == 106.05 and got[2].volume == 100
    assert got[2].open == close_to(26.102 * 106.05 / 26.512) and got[2].adjustment == close_to(24.12 / 106.05)
    assert (got[3].open, got[3].close, got[3].adjustment) == (1.0, 5.0, close_to(0.8))
    assert (got[6].open, got[6].close, got[6].adjustment) == (1.0, 1.5, 1.0)
    assert (got[7].open, got[7].adjustment, got[7].volume) == (2.0, 1.0, None)


def test_rebasing_keeps_returns(spark):
    rows = [("T", day("2020-01-02"), 100.0, 100.0, 100.0, 100.0, 1, 0.5), ("T", day("2020-01-03"), 60.0, 60.0, 60.0, 60.0, 1, 1.0), ("T", day("2020-01-06"), 70.0, 70.0, 70.0, 70.0, 1, 0.1)]
    frame = spark.createDataFrame(rows, PRICE)
    plain = [r.close for r in prices.adjusted(frame).orderBy("date").collect()]
    based = [r.close for r in prices.adjusted(frame, day("2020-01-06")).orderBy("date").collect()]
    assert plain == [50.0, 60.0, close_to(7.0)]
    assert based == [close_to(500.0), close_to(600.0), 70.0]
    assert based[1] / based[0] == close_to(plain[1] / plain[0])
    with pytest.raises(Exception, match="no adjustment"):
        prices.adjusted(frame, day("2019-01-01")).collect()
    assert prices.adjusted(frame, day("2019-01-01"), missing_is_an_error=False).count() == 0
    assert [r.date.day for r in prices.between(frame, "T", day("2020-01-03"), None).collect()] == [3, 6]


YEAR = "ticker string, dimension string, calendardate date, reportperiod date, netinc double, ncfo double, assets double, liabilities double, assetsc double, liabilitiesc double, shareswa double, sharesbas double, gp double, revenue double"


def year(y, netinc, ncfo, assets, liabilities, assetsc, liabilitiesc, shares, gp, revenue, dimension="ARY"):
    return ("A", dimension, day(f"{y}-12-31"), day(f"{y}-12-31"), netinc, ncfo, assets, liabilities, assetsc, liabilitiesc, shares, 7.0, gp, revenue)


def test_fscore_of_eight_and_its_gaps(spark):
    rows = [year(2021, 20.0, 30.0, 100.0, 40.0, 50.0, 20.0, 10.0, 40.0, 80.0), year(2020, 5.0, 4.0, 100.0, 50.0, 40.0, 20.0, 10.0, 30.0, 70.0)]
    got = {r.fiscal_year: r for r in fundamentals.piotroski(spark.createDataFrame(rows, YEAR)).collect()}
    assert got[2021].f_score == 8 and got[2021].roa == 0.2 and got[2021].cfo == 30.0
    assert got[2020].f_score == 1
    # a year without figures is left out, but the next is still compared with it
    gap = [year(2020, 5.0, 4.0, 100.0, 50.0, 40.0, 20.0, 10.0, 30.0, 70.0), year(2021, None, 9.0, None, 60.0, None, None, 0.0, None, None), year(2022, 20.0, 30.0, 100.0, 40.0, 50.0, 20.0, 0.0, 40.0, 80.0)]
    got = {r.fiscal_year: r for r in fundamentals.piotroski(spark.createDataFrame(gap, YEAR)).collect()}
    assert set(got) == {2020, 2022}
    assert (got[2022].d_roa, got[2022].d_leverage, got[2022].equity_issuance, got[2022].f_score) == (0, 1, 1, 4)
    histogram = {r.f_score: r.n for r in fundamentals.score_histogram(fundamentals.piotroski(spark.createDataFrame(rows, YEAR))).collect()}
    assert histogram == {s: int(s in (1, 8)) for s in range(10)}


def test_quarterly_and_ratios(spark):
    rows = [year(2021, 10.0, 3.0, 500.0, 1.0, 2.0, 3.0, 0.0, 4.0, 0.0, "ARQ"), year(2020, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, "MRY"), year(2021, 2.0, 1.0, 1.0, 1.0, 1.0, 1.0, 9.0, 1.0, 0.0, "MRY")]
    frame = spark.createDataFrame(rows, YEAR).withColumn("opinc", F.lit(2.0))
    q = fundamentals.quarterly_statements(frame).first()
    assert (q.roa, q.shares_out, q.operating_cash_flow) == (0.02, 7.0, 3.0)
    r = fundamentals.ratios(frame, F.lit(day("2022-01-01"))).collect()
    assert len(r) == 1 and r[0].shares_outstanding == 9.0 and r[0].operating_margin is None and r[0].beta is None


def test_asof_ties_nulls_and_sides(spark):
    left = spark.createDataFrame([("A", day("2020-01-01"), 1), ("A", day("2020-02-01"), 2), ("A", day("2020-03-01"), 3), ("B", day("2020-03-01"), 4)], "k string, date date, n int")
    right = spark.createDataFrame(
        [("A", day("2020-02-01"), "ARQ", 5.0), ("A", day("2020-02-01"), "ARY", 6.0), ("A", day("2020-02-15"), "ARQ", None), ("C", day("2020-01-01"), "ARQ", 9.0)], "k string, date date, dimension string, v double"
    )
    got = {r.n: r.v for r in asof.asof_join(left, right, ["k"], "date", ["v"], ["dimension"]).collect()}
    assert got == {1: None, 2: 6.0, 3: 6.0, 4: None}
    single = {r.k: r.v for r in asof.latest_upto(right, ["k"], "date", F.lit(day("2020-03-01")), ["v"], ["dimension"]).collect()}
    assert single == {"A": None, "C": 9.0}


MASTER = "ticker string, src_table string, category string, exchange string, isdelisted string, sector string, industry string, firstpricedate date, lastpricedate date"
STOCK = "Domestic Common Stock"


def market(spark, quotes, filings, names):
    p = spark.createDataFrame([(t, d, None, None, None, c, v, 1.0) for t, d, c, v in quotes], PRICE)
    s = spark.createDataFrame([(t, k, d, d, d, x) for t, k, d, x in filings], FILING)
    m = spark.createDataFrame([(t, "stocks", STOCK, "NYSE", gone, "s", "i", None, last) for t, gone, last in names], MASTER)
    return p, m, s


def sessions(n, first="1998-01-01"):
    out, at = [], day(first)
    while len(out) < n:
        if at.weekday() < 5:
            out.append(at)
        at += dt.timedelta(1)
    return out


def test_universe_of_a_day(spark):
    days = sessions(30)
    quotes = [(t, d, c, v) for d in days for t, c, v in (("GOOD", 50.0, 1_000_000), ("BAD", 1.0, 1_000_000), ("LOWDV", 50.0, 10))]
    filings = [(t, "ARQ", day("1997-11-01"), 1e8) for t in ("GOOD", "BAD", "LOWDV", "NOQ")]
    p, m, s = market(spark, quotes, filings, [("GOOD", "N", None), ("BAD", "N", None), ("LOWDV", "N", None), ("NOQ", "N", None)])
    got = pit.universe_on(p, m, s, days[-1]).collect()
    assert [r.ticker for r in got] == ["GOOD"]
    assert got[0].mcap == 5e9 and got[0].dvol_days == 25 and got[0].dvol_avg == 5e7
    assert pit.universe_on(p, m, s, days[-1] + dt.timedelta(10)).count() == 1 and pit.universe_on(p, m, s, days[-1] + dt.timedelta(11)).count() == 0


def by_loop(quotes, shares, last, calendar, screen):
    """Membership by merging spans one after another: the plain restatement of the history."""
    valid, frame = [], []
    for d, c, v in quotes:
        frame = (frame + [(c, v)])[-screen.lookback :]
        traded = [a * b for a, b in frame if b > 0]
        known = [x for f, x in shares if f <= d]
        dv = sum(traded) / len(traded) if len(traded) >= screen.min_dvol_days else 0.0
        if known and c >= screen.min_price and c * known[-1] >= screen.min_mcap and dv >= screen.min_dvol:
            valid.append((d, c))
    runs = []
    for i, (d, c) in enumerate(valid):
        until = min(valid[i + 1][0] if i + 1 < len(valid) else (last or calendar[-1]), d + dt.timedelta(screen.max_quote_age))
        if runs and runs[-1][1] >= d:
            runs[-1] = (runs[-1][0], max(runs[-1][1], until), runs[-1][2] + [(d, c)])
        else:
            runs.append((d, until, [(d, c)]))
    return {day_: [c for d, c in own if d <= day_][-1] for a, b, own in runs for day_ in calendar if a <= day_ <= b}


@pytest.mark.parametrize("seed", range(4))
def test_history_matches_merged_spans(spark, seed):
    import random

    chance = random.Random(seed)
    calendar = sessions(80)
    screen = pit.Screen(min_price=10, min_mcap=1000, min_dvol=500, lookback=5, min_dvol_days=3, max_quote_age=7)
    quotes, filings, names, want = [], [], [], {}
    for t in "ABCDEF":
        own = [(d, float(chance.randrange(5, 40)), chance.choice([0, 10, 50, 200])) for d in calendar if chance.random() < (0.9 if t < "D" else 0.3)]
        last = chance.choice([None, calendar[60], calendar[70]])
        shares = [(day("1997-12-01"), 100.0), (calendar[30], 60.0)]
        quotes += [(t, *q) for q in own]
        filings += [(t, "ARQ", d, x) for d, x in shares] + [(t, "MRY", calendar[10], 1e9), (t, "ARY", calendar[40], None)]
        names.append((t, "N", last))
        want[t] = (own, shares, last)
    quotes.append(("Z", calendar[-1], 1.0, 0))
    every = sorted({q[1] for q in quotes})
    p, m, s = market(spark, quotes, filings, names)
    got = {(r.ticker, r.as_of): r.price for r in pit.universe_history(p, m, s, screen).collect()}
    assert got == {(t, d): c for t, args in want.items() for d, c in by_loop(*args, every, screen).items()}


def test_history_begins_cold_and_ends_where_told(spark):
    days = sessions(40)
    p, m, s = market(spark, [("A", d, 50.0, 1_000_000) for d in days], [("A", "ARQ", day("1997-11-01"), 1e8)], [("A", "N", None)])
    got = sorted(r.as_of for r in pit.universe_history(p, m, s, start=days[10], end=days[30]).collect())
    assert got == days[19:31]  # ten sessions with volume come first
    gone = spark.createDataFrame([("A", "stocks", STOCK, "NYSE", "Y", "s", "i", None, days[5])], MASTER)
    assert pit.universe_history(p, gone, s, start=days[10]).count() == 0


def test_factor_files(spark, tmp_path):
    text = "This file was made from data\nto be skipped\n\n,Mkt-RF,SMB,HML,RF\n19260701,    0.10,   -0.25, -99.99,   0.009\n19260702, -999 ,0.1,0.2,\n\nCopyright 2026\n"
    (tmp_path / "f.csv").write_text(text)
    lines = spark.read.text(str(tmp_path / "f.csv"))
    got = {r.date: tuple(r)[1:] for r in landing.factor_lines(lines, "mkt_rf smb hml rf").collect()}
    assert got == {day("1926-07-01"): (0.10, -0.25, None, 0.009), day("1926-07-02"): (None, 0.1, 0.2, None)}
    drifts = {header: lines.filter(landing.drifted(header)).count() for header in ("Mkt-RF SMB HML RF", "Mkt-RF SMB", "Mom")}
    assert drifts == {"Mkt-RF SMB HML RF": 0, "Mkt-RF SMB": 0, "Mom": 1}
    three = landing.factor_lines(lines, "mkt_rf smb hml rf")
    rev = spark.createDataFrame([(day("1926-07-01"), 7.0)], "date date, st_rev double")
    columns = ["mkt_rf", "smb", "hml", "rf", "st_rev"]
    once = factors.merge_files([(three, columns[:4]), (rev, ["st_rev"])], columns)
    again = factors.merge_files([(rev, ["st_rev"])], columns, once)
    for made in (once, again):
        rows = {r.date: r for r in made.collect()}
        assert rows[day("1926-07-01")].mkt_rf == 0.10 and rows[day("1926-07-01")].st_rev == 7.0 and rows[day("1926-07-02")].st_rev is None and len(rows) == 2


def test_keyed_writes_with_null_key_parts(spark):
    old = spark.createDataFrame([("a", None, 1, "x"), ("b", "k", 2, "y")], "p string, q string, v int, w string")
    new = spark.createDataFrame([("a", None, 5, "n", 1), ("a", None, 6, None, 2), ("c", None, 7, "z", 1)], "p string, q string, v int, w string, seq int")
    got = sorted((tuple(r) for r in writes.replace_by_key(old, new, ["p", "q"], ["seq"]).collect()), key=repr)
    assert got == sorted([("a", None, 6, None), ("b", "k", 2, "y"), ("c", None, 7, "z")], key=repr)
    unique = new.filter("seq = 1").drop("seq")
    upserted = sorted((tuple(r) for r in writes.column_upsert(old, unique, ["p", "q"], ["v"]).collect()), key=repr)
    assert upserted == sorted([("a", None, 5, "x"), ("b", "k", 2, "y"), ("c", None, 7, None)], key=repr)
    kept = sorted((tuple(r) for r in writes.preserve_upsert(old, unique, ["p", "q"], ["w"]).collect()), key=repr)
    assert kept == sorted([("a", None, 5, "x"), ("b", "k", 2, "y"), ("c", None, 7, None)], key=repr)


def test_sector_labels(spark):
    rows = [('"Technology"',), (" Finance ",), ("Unknown",), (None,), ("",)]
    assert [r[0] for r in spark.createDataFrame(rows, "s string").select(sector_of(F.col("s"))).collect()] == ["Information Technology", "Financials", None, None, None]
    assert len(INDICATORS) == 105 and len(TABLES["sf1"].schema) == 112


def test_buckets_are_closed_on_the_right(spark):
    frame = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (9.0,)], "v double")
    assert [r[0] for r in frame.select(analytics.bucket(F.col("v"), [0, 1, 2], ["low", "high"])).collect()] == [None, "low", "high", "high", None]


def test_changes_without_an_event_deviate(spark):
    days = sessions(8)
    frame = lambda factors: spark.createDataFrame([("T", d, None, None, None, 1.0, 1, f) for d, f in zip(days, factors)], PRICE)
    events = spark.createDataFrame([("T", days[3], "split"), ("T", days[3], "dividend"), ("T", days[6], "dividend"), ("T", days[5], "listed"), ("U", days[2], "split")], "ticker string, date date, action string")
    explained = [0.2, 0.2, 0.2, 0.5, 0.5, 0.5, 0.9, 0.9]
    got = {r.date: r for r in analytics.adjustment_chain(frame(explained), events).collect()}
    assert all(abs(r.deviation) < 1e-12 for r in got.values()) and [d for d, r in sorted(got.items()) if r.is_event] == [days[3], days[6]]
    assert got[days[0]].chain == close_to(0.2 / 0.9) and got[days[3]].chain == close_to(0.5 / 0.9) and got[days[7]].chain == 1.0
    planted = [0.2, 0.2, 0.2, 0.5, 0.5, 0.6, 0.9, 0.9]  # the fifth day's change has no split or dividend
    got = {r.date: r.deviation for r in analytics.adjustment_chain(frame(planted), events).collect()}
    assert [round(got[d], 9) for d in days] == [round(0.5 / 0.6 - 1, 9)] * 5 + [0.0] * 3
    assert analytics.adjustment_chain(frame(planted), events, until=days[4]).filter("abs(deviation) > 1e-9").count() == 0


def test_every_event_of_a_day_meets_its_price(spark):
    days = sessions(3)
    p = spark.createDataFrame([("T", d, None, None, None, 1.0, 1, 1.0) for d in days], PRICE)
    events = spark.createDataFrame([("T", days[1], "split"), ("T", days[1], "dividend"), (None, days[2], "split")], "ticker string, date date, action string")
    got = sorted((r.date, r.action or "") for r in analytics.with_events(p, events, "action").collect())
    assert got == [(days[0], ""), (days[1], "dividend"), (days[1], "split"), (days[2], "")]


def test_bits_order_as_doubles_do(spark):
    import random
    import struct

    chance = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), -float("inf"), 1 - 2**-53, 1 + 2**-52, 2.0, 4.0, 0.1, 2.0**-1021, 3.0e-310]
    values += [struct.unpack("d", struct.pack("Q", chance.getrandbits(63)))[0] * chance.choice([1, -1]) for _ in range(400)]
    values = [v for v in values if v == v]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", selection.ordered_bits(F.col("v")).alias("k")).collect()
    plain = lambda v: struct.unpack("q", struct.pack("d", abs(v)))[0] * (1 if v >= 0 else -1)
    assert [(r.v, r.k) for r in got if r.k != plain(r.v)] == []


def test_medians_by_histograms(spark):
    import random
    import statistics

    chance = random.Random(2)
    groups = {"odd": [chance.gauss(0, 1e6) for _ in range(301)], "even": [chance.choice([-1.5, 0.0, 2.0, 2.5]) for _ in range(200)], "one": [7.25], "two": [1e-300, -1e300], None: [1.0, 2.0, 4.0], "same": [3.5] * 500}
    rows = [(g, v) for g, own in groups.items() for v in own] + [("odd", None), ("none", None)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(3)
    assert {r.g: (r.n, r.median) for r in selection.medians(frame, "g", "v").collect()} == {g: (len(v), statistics.median(v)) for g, v in groups.items()}
    whole = {r.g: (r.n, r.median) for r in analytics.median_by(frame.filter("abs(v) < 1e20 OR v IS NULL"), "g", "v").collect()}
    assert whole["none"] == (1, None) and whole["odd"][0] == 302
    assert selection.medians(frame.limit(0), "g", "v").count() == 0
    assert "percentile" not in analytics.median_by(frame.filter("g = 'odd'"), "g", "v")._jdf.queryExecution().toString()


def test_members_are_worked_out_once_for_median_and_sums(spark):
    """Before, the rows were worked out for the sums and again for the medians."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 7.5), (2, None)], "yr int, v double").mapInArrow(counted, "yr int, v double")
    assert {r.yr: (r.n, r["median"], r.total) for r in analytics.median_by(rows, "yr", "v").collect()} == {1: (2, 3.0, 6.0), 2: (2, 7.5, 8.0)}
    assert seen.value == 4
