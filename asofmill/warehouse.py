"""The tables of one folder, and the jobs that load and derive them."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators import analytics, factors, fundamentals, pit, prices, writes
from .operators.versions import Merge, VersionedTable, figures_of
from .sources import landing, providers
from .sources.schemas import FACTOR_FILES, TABLES, sector_of
from .sources.sync import Fetcher, sync

# Tables whose content comes from vendor files only, and what they are cleared with before a rebuild.
RAW = ("prices", "securities_master", "corporate_actions", "descriptions", "sp500_membership", "sf1", "metrics")
DERIVED = ("fundamentals", "quarterly_statements", "ratios", "universe_pit")
#: Tables that are laid out by year, and the key column that gives it.
BY_YEAR = {"prices": "date", "universe_pit": "as_of", "metrics": "as_of", "sf1": "reportperiod", "corporate_actions": "date", "quarterly_statements": "period"}
#: Tables from which the universe's history is derived, and the column from which day on a row counts (none: from the beginning).
FEEDS = {"prices": "date", "sf1": "date", "securities_master": None}
BEGINNING = dt.date(1900, 1, 1)
#: Ledgers of this folder: what each load did, and which tickers it changed from which day on (``at`` orders them; a null ticker stands for all).
LOADS = "source string, table_name string, loaded_at timestamp_ntz, n_read bigint, n_rows bigint, n_rejected bigint, n_unparsed bigint, n_keyless bigint, parts string, drift string"
CHANGES = "table_name string, ticker string, first_day date, at bigint"


class Warehouse:
    """Tables under ``folder`` (any store that Spark writes), as versions of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def stored(self, name: str) -> VersionedTable:
        table, day = TABLES[name], BY_YEAR.get(name)
        return VersionedTable(self.spark, self.path(name), table.schema, table.key, F.year(day) if day else None, tuple(reversed(table.key)) if day == "date" else table.key)

    def exists(self, name: str) -> bool:
        return bool(self.stored(name).versions())

    def table(self, name: str) -> DataFrame:
        """The table, empty if it was never written; columns that older files lack are null."""
        return self.stored(name).read()

    def write(self, name: str, rows: DataFrame) -> int:
        return self.stored(name).overwrite(TABLES[name].conform(rows)).rows

    def merge(self, name: str, rows: DataFrame, order: list | None = None) -> Merge:
        """Replace rows by key, in the partitions that they fall into; of several new ones the last in ``order``.

        The rows are computed once. Keys with null parts, and texts that were no numbers or days, are counted on the way;
        tickers whose rows differ from what was there are noted for ``update_history``.
        """
        table, hidden = TABLES[name], (landing.SEQUENCE, landing.UNPARSED)
        made = table.conform(rows, *[c for c in hidden if c in rows.columns])
        made = made if landing.SEQUENCE in made.columns else made.withColumn(landing.SEQUENCE, F.monotonically_increasing_id())
        made = made if landing.UNPARSED in made.columns else made.withColumn(landing.UNPARSED, F.lit(0))
        keyless = F.count_if(F.greatest(*[F.col(k).isNull() for k in table.key], F.lit(False)))
        note = self._noting(name) if name in FEEDS else None
        return self.stored(name).merge(made, order or [landing.SEQUENCE], {"unparsed": F.sum(landing.UNPARSED), "keyless": keyless}, note)

    def upsert(self, name: str, rows: DataFrame, order: list | None = None) -> int:
        """``merge``; returns the rows given."""
        return self.merge(name, rows, order).rows

    def _noting(self, name: str) -> Callable[[DataFrame, DataFrame], None]:
        """Notes, of the old and the new rows of the partitions that a merge touches, which tickers change from which day on."""
        key, day = list(TABLES[name].key), FEEDS[name]
        values = [c for c in TABLES[name].schema.names if c not in key]

        def note(old: DataFrame, new: DataFrame) -> None:
            when = F.coalesce(day, F.lit(BEGINNING)) if day else F.lit(BEGINNING)
            was = old.select(*[F.col(k).alias(f"__{k}") for k in key], F.xxhash64(*values).alias("__was"), when.alias("__when"), F.col("ticker").alias("__was_ticker"))
            same = F.lit(True)
            for k in key:
                same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
            differ = new.withColumn("__day", when).join(was, same, "left").filter(F.col("__was").isNull() | (F.col("__was") != F.xxhash64(*values)))
            names = F.explode(F.array_distinct(F.array_compact(F.array("ticker", "__was_ticker"))))
            changed = differ.select(names.alias("ticker"), F.least("__day", "__when").alias("first_day"))
            if name == "prices":
                days = new.select("date").distinct().join(old.select("date").distinct(), "date", "left_anti")
                changed = changed.union(days.agg(F.min("date").alias("first_day")).filter(F.col("first_day").isNotNull()).select(F.lit(None).cast("string"), "first_day"))
            found = changed.groupBy("ticker").agg(F.min("first_day").alias("first_day"))
            writes.append(found.select(F.lit(name).alias("table_name"), "ticker", "first_day", F.lit(time.time_ns()).alias("at")), self.path("changes"))

        return note

    def ledger(self, name: str, schema: str) -> DataFrame:
        """An append-only table beside the versioned ones; empty if nothing was ever noted."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(self.path(name)) if there else self.spark.createDataFrame([], schema)

    def loads(self) -> DataFrame:
        """What each load read, gave, rejected and could not parse."""
        return self.ledger("loads", LOADS)

    def clear(self, *names: str) -> None:
        for name in names:
            self.write(name, self.spark.createDataFrame([], TABLES[name].schema))

    def log(self, source: str, row_count: int, as_of: dt.date | None = None) -> None:
        self.stored("snapshots").overwrite(self.table("snapshots").unionByName(writes.ledger_row(self.spark, source, as_of, row_count)))

    def _note_load(self, source: str, table: str, read: int, done: Merge, drift: str | None) -> None:
        f = done.figures
        row = (source, table, dt.datetime.now(dt.UTC).replace(tzinfo=None), read, done.rows, read - done.rows, f.get("unparsed", 0), f.get("keyless", 0), ",".join(done.parts), drift)
        writes.append(self.spark.createDataFrame([row], LOADS), self.path("loads"))
        if drift:
            print(f"{source}: columns differ from what is expected: {drift}")

    # ---- loads ----

    def load(self, what: str, path: str) -> int:
        """A vendor file by its loader's name, in one pass over it; what came of it goes into ``loads``."""
        table, make = landing.LOADERS[what]
        raw, seen = landing.read_csv(self.spark, path), Observation()
        done = self.merge(table, make(raw.observe(seen, F.count(F.lit(1)).alias("n"))))
        self._note_load(what, table, figures_of(seen, "n")["n"], done, ",".join(landing.missing_columns(raw, table)) or None)
        return done.rows

    def load_factor_file(self, key: str, path: str) -> int:
        """One factor file into its own columns; where three- and five-factor files overlap, the five-factor one stays.

        The file is read once: lines, values that are no numbers and headers with other names than expected are counted on the way.
        """
        columns, seen = FACTOR_FILES[key][1].split(), Observation()
        new, old = landing.factor_file(self.spark, path, key, seen), self.table("french_factors")
        wide = [c for c in old.columns if c != "date"]
        given = Observation()
        new = new.observe(given, F.count(F.lit(1)).alias("n"), F.max("date").alias("last"))
        if key == "3f":
            known = old.filter(F.col("rmw").isNotNull() | F.col("cma").isNotNull()).select("date")
            new = new.join(known, "date", "left_anti").unionByName(old.join(known, "date", "left_semi").select(*new.columns))
        made = self.stored("french_factors").overwrite(TABLES["french_factors"].conform(factors.merge_files([(new, columns)], wide, old)))
        figures, told = figures_of(seen, "n", "unparsed", "drifted"), figures_of(given, "n", "last")
        rows = told["n"]
        drift = f"{figures['drifted']} header lines" if figures["drifted"] else None
        self._note_load(key, "french_factors", rows, Merge(rows, {"unparsed": figures["unparsed"]}, made.parts, made.version), drift)
        self.log(f"factors:{key}", rows, told["last"] or None)
        return rows

    def wanted(self, table: str, tickers: DataFrame, upto: dt.date | None = None, force: bool = False) -> DataFrame:
        """The tickers (ticker) that ``table`` does not cover yet: that it lacks, or holds up to an earlier day than ``upto`` only. All with ``force``."""
        names = tickers.select("ticker").filter(F.col("ticker").isNotNull()).distinct()
        return names if force else writes.worklist(names, self.table(table), "ticker", F.lit(upto) if upto else None)

    def pull(
        self, provider: providers.Provider, what: str, tickers: DataFrame | None = None, start: dt.date | None = None, end: dt.date | None = None, upto: dt.date | None = None, force: bool = False, cap: int = 50_000,
        most_rows: int = 30_000,
    ) -> int:
        """Fetch a loader's table from a provider for the tickers (the universe's, if not given) that it does not cover yet, and load it.

        Batches follow the sessions that each ticker's life spans by the calendar of the prices at hand (or of weekdays, without any); prices of
        tickers that come back short are asked for once more, alone. A job that died goes on with the tickers that are left,
        since those that were loaded are covered.
        """
        table, make = landing.LOADERS[what]
        first, last = start or BEGINNING, end or dt.date.today()
        todo = self.wanted(table, tickers if tickers is not None else self.table("universe"), upto, force)
        lives = self.table("securities_master").join(todo, "ticker", "left_semi")
        expected = pit.sessions_expected(self.table("prices"), lives, start, end)
        weekdays = max(1, (last - first).days * 5 // 7)
        sized = todo.join(expected, "ticker", "left").withColumn("expected", F.coalesce(F.nullif("expected", F.lit(0).cast("long")), F.lit(weekdays).cast("long")))
        fetch = lambda names, a, b: provider.rows(what, names, a, b)
        again = lambda some, most: providers.by_ticker(self.spark, provider.columns[what], fetch, some, (first, last), cap, most_rows, most)
        with writes.aside(again(sized, 28), f"{self.path(table)}/_staging") as raw:
            if table == "prices":
                raw = providers.refetched(raw, expected, lambda short: again(short, 1))
            done = self.merge(table, make(raw))
        self._note_load(what, table, done.rows, done, ",".join(landing.missing_columns(raw, table)) or None)
        return done.rows

    def pull_whole(self, provider: providers.Provider, what: str, page: int = 10_000, lanes: int = 4) -> int:
        """Fetch a loader's whole table from a provider page by page, and load it."""
        table, make = landing.LOADERS[what]
        raw, seen = providers.paged(self.spark, provider.columns[what], lambda at, n: provider.page(what, at, n), page, lanes), Observation()
        done = self.merge(table, make(raw.observe(seen, F.count(F.lit(1)).alias("n"))))
        self._note_load(what, table, figures_of(seen, "n")["n"], done, ",".join(landing.missing_columns(raw, table)) or None)
        return done.rows

    def describe_factors(self) -> int:
        """The factor columns into the dictionary."""
        rows = [("french_factors", c, "N", "Y" if c == "date" else "N", c, f"daily factor {c}, in percent" if c != "date" else "trading day", "percent" if c != "date" else "date") for c in TABLES["french_factors"].schema.names]
        return self.upsert("descriptions", self.spark.createDataFrame(rows, TABLES["descriptions"].schema))

    # ---- derivations ----

    def build_piotroski(self) -> int:
        return self.upsert("fundamentals", fundamentals.piotroski(self.table("sf1")))

    def build_quarterly(self) -> int:
        return self.upsert("quarterly_statements", fundamentals.quarterly_statements(self.table("sf1")))

    def build_ratios(self, as_of: dt.date | None = None) -> int:
        return self.upsert("ratios", fundamentals.ratios(self.table("sf1"), F.lit(as_of or dt.date.today())))

    def build_universe(self, day: dt.date, screen: pit.Screen = pit.Screen()) -> int:
        return self.upsert("universe_pit", pit.universe_on(self.table("prices"), self.table("securities_master"), self.table("sf1"), day, screen))

    def build_history(self, screen: pit.Screen = pit.Screen(), start: dt.date | None = None, end: dt.date | None = None) -> int:
        """The whole history between two days; from beginning to end, it is what ``update_history`` goes on from."""
        upto = self._noted()
        rows = pit.universe_history(self.table("prices"), self.table("securities_master"), self.table("sf1"), screen, start, end)
        if start is not None or end is not None:
            return self.upsert("universe_pit", rows)
        count = self.write("universe_pit", rows)
        self._mark(upto)
        return count

    def _noted(self) -> int:
        return self.ledger("changes", CHANGES).agg(F.max("at")).first()[0] or 0

    def _mark(self, upto: int) -> None:
        writes.append(self.spark.createDataFrame([("universe_pit", None, None, upto)], CHANGES), self.path("built"))

    def update_history(self, screen: pit.Screen = pit.Screen()) -> int:
        """Work the history out again for the tickers that loads have changed since, from the day that they changed it; the rest of it, and of its files, stays.

        Gives the same table as ``build_history``. Returns the rows worked out; without a whole build before, it makes one.
        """
        mark = self.ledger("built", CHANGES).agg(F.max("at")).first()[0]
        if mark is None or not self.exists("universe_pit"):
            return self.build_history(screen)
        upto, changes = self._noted(), self.ledger("changes", CHANGES).filter(F.col("at") > mark)
        held = self.stored("universe_pit")
        tickers = self.table("securities_master").select("ticker").union(held.read().select("ticker")).distinct()
        with writes.aside(pit.affected_since(changes.select("ticker", "first_day"), tickers, screen), f"{self.path('universe_pit')}/_staging") as since:
            first = since.agg(F.min("since")).first()[0]
            last = self.table("prices").agg(F.max("date")).first()[0]
            if first is None or last is None:
                self._mark(upto)
                return 0
            # every year from the first day on, and those before it only if they are there
            parts = [str(y) for y in range(max(first, BEGINNING).year, max(first, last).year + 1)]
            rows = pit.history_since(self.table("prices"), self.table("securities_master"), self.table("sf1"), since, screen)
            done = held.replace_where(TABLES["universe_pit"].conform(rows), lambda old: pit.without_affected(old, since), parts)
        self._mark(upto)
        return done.rows

    def classify(self, as_of: dt.date, tickers: list[str] | None = None, force: bool = False) -> int:
        """Standard sectors from the master (of some tickers, or all); industries that are known already stay, unless ``force`` takes the master's."""
        master = self.table("securities_master").select("ticker", sector_of(F.col("sector")).alias("sector"), "industry", F.lit(as_of).alias("as_of")).dropDuplicates(["ticker"])
        master = master.filter(F.col("ticker").isin(tickers)) if tickers else master
        if not force:
            known = self.table("classifications").filter(F.col("industry").isNotNull()).select("ticker", F.col("industry").alias("__known"))
            master = master.join(known, "ticker", "left").withColumn("industry", F.coalesce("__known", "industry")).drop("__known")
        seen = Observation()
        master = master.observe(seen, F.count(F.lit(1)).alias("n"))
        self.write("classifications", writes.preserve_upsert(self.table("classifications"), master, ["ticker"], []))
        return figures_of(seen, "n")["n"]

    def update_universe(self, rows: DataFrame, source: str, as_of: dt.date | None) -> int:
        """Members of a fund (ticker, name, and sector if the fund tells it); identifiers found earlier stay, and so do sectors of members that are classified."""
        now, seen = dt.datetime.now(dt.UTC).replace(tzinfo=None), Observation()
        with writes.aside(rows.observe(seen, F.count(F.lit(1)).alias("n")), f"{self.path('universe')}/_staging") as held:
            new = TABLES["universe"].conform(held.withColumn("source", F.lit(source)).withColumn("added_at", F.lit(now).cast("timestamp_ntz")))
            self.write("universe", writes.preserve_upsert(self.table("universe"), new, ["ticker"], ["figi", "cik", "sic", "sic_description", "lei"]))
            if "sector" in rows.columns:
                told = held.select("ticker", sector_of(F.col("sector")).alias("sector")).filter(F.col("sector").isNotNull()).dropDuplicates(["ticker"])
                fresh = told.join(self.table("classifications").select("ticker"), "ticker", "left_anti")
                self.upsert("classifications", fresh.withColumn("as_of", F.lit(as_of or now.date())))
        self.log(source, figures_of(seen, "n")["n"], as_of)
        return figures_of(seen, "n")["n"]

    def enrich(self, found: DataFrame, key: str, columns: list[str]) -> int:
        """Identifiers into the universe, by ticker or cik."""
        seen = Observation()
        self.write("universe", writes.keyed_update(self.table("universe"), found.observe(seen, F.count(F.lit(1)).alias("n")), key, columns))
        return figures_of(seen, "n")["n"]

    def lacking(self, column: str, given: str = "ticker") -> list[str]:
        """Values of ``given`` (ticker or cik) of members whose ``column`` is missing: a fund's members, a few thousand."""
        rows = self.table("universe").filter(analytics.is_missing(column) & ~analytics.is_missing(given))
        return sorted(r[0] for r in rows.select(given).distinct().collect())

    def enrich_all(self, figis: Callable[[list[str]], DataFrame] | None = None, ciks: DataFrame | None = None, companies: Callable[[list[str]], DataFrame] | None = None) -> dict[str, int]:
        """Fill what members lack, and ask for nothing that is known: figi by ticker, cik by ticker, then what the registry says of each cik."""
        out = {}
        if figis is not None and (wanted := self.lacking("figi")):
            out["figi"] = self.enrich(figis(wanted), "ticker", ["figi"])
        if ciks is not None and (wanted := self.lacking("cik")):
            out["cik"] = self.enrich(ciks.filter(F.col("ticker").isin(wanted)).dropDuplicates(["ticker"]), "ticker", ["cik"])
        if companies is not None and (wanted := self.lacking("sic", "cik")):
            out["sic"] = self.enrich(companies(wanted), "cik", ["sic", "sic_description", "lei"])
        return out

    def statements(self, ticker: str, dimension: str) -> DataFrame:
        """All columns of a ticker's filings of a dimension, by period; the filing date is named ``datekey``."""
        own = self.table("sf1").filter((F.col("ticker") == ticker) & (F.col("dimension") == dimension))
        return own.withColumnRenamed("date", "datekey").orderBy("calendardate")

    def adjusted_prices(self, ticker: str, start: dt.date | None = None, end: dt.date | None = None, as_of: dt.date | None = None) -> DataFrame:
        """A ticker's adjusted series; fails if ``as_of`` has no adjustment up to it."""
        own = prices.between(self.table("prices"), ticker)
        if as_of is not None:
            anchor = own.filter(F.col("date") <= F.lit(as_of)).agg(F.max_by("adjustment", "date")).first()[0]
            if anchor is None:
                raise ValueError(f"no adjustment for {ticker} up to {as_of}")
        return prices.between(prices.adjusted(own, as_of), None, start, end).orderBy("date")

    # ---- whole runs ----

    def derive(self, history: bool = True) -> dict[str, int]:
        made = {"fundamentals": self.build_piotroski(), "quarterly_statements": self.build_quarterly(), "ratios": self.build_ratios()}
        return made | ({"universe_pit": self.update_history()} if history else {})

    def update_factors(self, fetcher: Fetcher, landing_folder: str, files: dict[str, tuple[str, str | None]], force: bool = False) -> dict[str, int | None]:
        """Fetch and load the factor files whose stamp has changed, and enter their columns into the dictionary."""
        done = sync(fetcher, landing_folder, files, self.load_factor_file, force=force)
        if any(n is not None for n in done.values()):
            self.describe_factors()
        return done

    def bulk(
        self, fetcher: Fetcher, landing_folder: str, files: dict[str, tuple[str, str | None]], factor_files: dict[str, tuple[str, str | None]] | None = None, from_zero: bool = False, derive: bool = True,
        history: bool = True, force: bool = False,
    ) -> dict[str, int | None]:
        """Fetch, load and derive. files: loader -> (url, stamp). From zero, raw and derived tables are emptied first and all is loaded.

        Tables are derived anew if more than the dictionary was loaded, unless ``derive`` (or ``history``, for the universe's) is off. Factor files may fail
        without stopping an update. ``force`` loads unchanged files too.
        """
        if from_zero:
            self.clear(*RAW, *DERIVED)
        done = sync(fetcher, landing_folder, files, self.load, force=from_zero or force)
        try:
            done |= self.update_factors(fetcher, landing_folder, factor_files or {}, force=from_zero or force)
        except Exception as failure:
            if from_zero:
                raise
            print(f"factor files were left as they are: {failure}")
        if derive and any(n is not None for name, n in done.items() if name in landing.LOADERS and name != "descriptions"):
            done |= self.derive(history)
        return done

    def status(self) -> DataFrame:
        """name, n_rows, n_tickers, first_date, last_date of every table, each read once."""
        day = {n: next((c for c in ("date", "as_of", "period") if c in TABLES[n].schema.names), None) for n in TABLES}
        return analytics.coverage({n: (self.table(n), day[n]) for n in TABLES}, "ticker")

    def stocks(self) -> DataFrame:
        """kind, n, delisted of the securities master."""
        return analytics.flag_counts(self.table("securities_master"), {"delisted": F.col("isdelisted") == "Y"}, ["src_table"])

    def pulled(self, k: int = 12) -> DataFrame:
        """The ledger's last entries."""
        return analytics.top(self.table("snapshots"), k, "pulled_at", F.asc("source"))

    def optimize(self) -> dict[str, dict[str, int]]:
        """Rewrite each table in few sorted files; report rows, repeated keys and files before and after."""
        out = {}
        for name, table in TABLES.items():
            if table.key and self.exists(name):
                repeated = writes.key_violations(self.table(name), list(table.key)).count()
                files = len(self.table(name).inputFiles())
                out[name] = {"rows": self.write(name, self.table(name)), "repeated_keys": repeated, "files_before": files, "files_after": len(self.table(name).inputFiles())}
        return out
