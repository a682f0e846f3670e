"""Command line over a warehouse folder."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import urllib.error
import urllib.request
from collections.abc import Iterable

from pyspark.sql import SparkSession

from .operators.pit import Screen
from .sources import landing, providers
from .sources.schemas import FACTOR_FILES
from .sources.sync import bulk_files
from .warehouse import Warehouse


class Http:
    """The network, by the standard library."""

    def _open(self, url: str, method: str = "GET"):
        try:
            return urllib.request.urlopen(urllib.request.Request(url, method=method), timeout=120)
        except urllib.error.HTTPError as answer:
            providers.busy_on(answer.code, answer.headers.get("Retry-After"))
            raise

    def get_json(self, url: str) -> object:
        with self._open(url) as r:
            return json.load(r)

    def get_bytes(self, url: str) -> Iterable[bytes]:
        with self._open(url) as r:
            while piece := r.read(1 << 20):
                yield piece

    def stamp(self, url: str) -> str | None:
        with self._open(url, "HEAD") as r:
            return r.headers.get("Last-Modified")


def names_of(text: str | None) -> list[str]:
    """The parts of a comma-separated list, without blanks."""
    return [t.strip() for t in (text or "").split(",") if t.strip()]


def ticker_list(text: str | None) -> list[str]:
    return [t.upper() for t in names_of(text)]


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="asofmill")
    out.add_argument("--warehouse", default=os.environ.get("ASOFMILL_WAREHOUSE", "warehouse"))
    sub = out.add_subparsers(dest="command", required=True)
    day = dt.date.fromisoformat
    sub.add_parser("status")
    for name, loader in (("update-master", "tickers"), ("update-actions", "actions"), ("update-metrics", "metrics"), ("update-sf1", "fundamentals"), ("update-prices", "stocks"), ("update-funds", "funds"), ("update-sp500", "sp500"), ("update-descriptions", "descriptions")):
        sub.add_parser(name).set_defaults(loader=loader)
        sub.choices[name].add_argument("file")
    load = sub.add_parser("load-bulk")
    load.add_argument("table", choices=sorted(landing.LOADERS))
    load.add_argument("file")
    universe = sub.add_parser("update-universe")
    universe.add_argument("files", nargs="+", help="holdings files; of a ticker in several the first counts")
    universe.add_argument("--source", default="fund")
    classes = sub.add_parser("update-classifications")
    classes.add_argument("--as-of", type=day, default=dt.date.today())
    classes.add_argument("--ticker", default=None)
    classes.add_argument("--force", action="store_true")
    french = sub.add_parser("update-french-factors")
    french.add_argument("--folder", required=True)
    french.add_argument("--base-url", default=None)
    french.add_argument("--force", action="store_true")
    for name in ("build-piotroski", "build-quarterly"):
        sub.add_parser(name)
    sub.add_parser("build-ratios").add_argument("--as-of", type=day, default=None)
    pit = sub.add_parser("build-universe-pit")
    pit.add_argument("--history", action="store_true")
    pit.add_argument("--as-of", type=day, default=dt.date.today())
    pit.add_argument("--start", type=day, default=None)
    pit.add_argument("--end", type=day, default=None)
    pit.add_argument("--changed", action="store_true")
    pit.add_argument("--types", default=None)
    for field, kind in (("min_price", float), ("min_mcap", float), ("min_dvol", float), ("lookback", int), ("min_dvol_days", int), ("max_quote_age", int)):
        pit.add_argument("--" + field.replace("_", "-"), type=kind, default=getattr(Screen(), field))
    for name in ("bulk-download", "bulk-fromzero", "bulk-update"):
        bulk = sub.add_parser(name)
        bulk.add_argument("--status-url", required=True)
        bulk.add_argument("--base-url", required=True)
        bulk.add_argument("--folder", required=True)
        bulk.add_argument("--tables", default=None)
        bulk.add_argument("--force", action="store_true")
        bulk.add_argument("--no-derive", action="store_true")
        bulk.add_argument("--no-pit", action="store_true")
    sub.add_parser("optimize-db")
    held = sub.add_parser("statements")
    held.add_argument("ticker")
    held.add_argument("--dimension", default="ARY")
    shown = sub.add_parser("prices")
    shown.add_argument("ticker")
    for field in ("--start", "--end", "--as-of"):
        shown.add_argument(field, type=day, default=None)
    return out


def run(spark: SparkSession, words: list[str], fetcher=None):
    """Do what the words say; the result is printed and returned."""
    given = parser().parse_args(words)
    house, command = Warehouse(spark, given.warehouse), given.command
    if hasattr(given, "loader") or command == "load-bulk":
        out = house.load(given.table if command == "load-bulk" else given.loader, given.file)
    elif command == "update-universe":
        funds = []
        for name in given.files:
            with open(name) as f:
                funds.append(providers.fund_holdings(spark, f.read()))
        out = house.update_universe(providers.joint_holdings([rows for rows, _ in funds]), given.source, min((day for _, day in funds if day), default=None))
    elif command == "update-classifications":
        out = house.classify(given.as_of, ticker_list(given.ticker), given.force)
    elif command == "update-french-factors" and given.base_url:
        net = fetcher or Http()
        os.makedirs(given.folder, exist_ok=True)
        urls = {k: f"{given.base_url}/{f[0]}" for k, f in FACTOR_FILES.items()}
        out = house.update_factors(net, given.folder, {k: (url, net.stamp(url)) for k, url in urls.items()}, given.force)
    elif command == "update-french-factors":
        out = {k: house.load_factor_file(k, os.path.join(given.folder, f[0])) for k, f in FACTOR_FILES.items() if os.path.exists(os.path.join(given.folder, f[0]))}
        house.describe_factors()
    elif command == "build-piotroski":
        out = house.build_piotroski()
    elif command == "build-quarterly":
        out = house.build_quarterly()
    elif command == "build-ratios":
        out = house.build_ratios(given.as_of)
    elif command == "build-universe-pit":
        screen = Screen(given.min_price, given.min_mcap, given.min_dvol, given.lookback, given.min_dvol_days, given.max_quote_age, tuple(names_of(given.types)) or Screen().categories)
        out = house.update_history(screen) if given.changed else house.build_history(screen, given.start, given.end) if given.history else house.build_universe(given.as_of, screen)
    elif command.startswith("bulk-"):
        net = fetcher or Http()
        status = net.get_json(given.status_url)
        wanted = names_of(given.tables) or list(landing.LOADERS)
        if unknown := sorted(set(wanted) - set(landing.LOADERS)):
            raise SystemExit(f"no such tables: {', '.join(unknown)}")
        files = {k: (f"{given.base_url}/{name}", stamp) for k in landing.LOADERS if k in wanted for name, stamp in bulk_files(status, k)[:1]}
        os.makedirs(given.folder, exist_ok=True)
        if command == "bulk-download":
            from .sources.sync import sync

            out = sync(net, given.folder, files, lambda name, path: os.path.getsize(path), force=given.force)
        else:
            out = house.bulk(net, given.folder, files, None, command == "bulk-fromzero", not given.no_derive, not given.no_pit, given.force)
    elif command == "optimize-db":
        out = house.optimize()
    elif command == "statements":
        out = [r.asDict() for r in house.statements(given.ticker.upper(), given.dimension).collect()]
    elif command == "prices":
        out = [tuple(r) for r in house.adjusted_prices(given.ticker.upper(), given.start, given.end, given.as_of).collect()]
    else:
        out = [tuple(r) for r in house.status().collect()]
        print(json.dumps([tuple(r) for r in [*house.stocks().collect(), *house.pulled().collect()]], default=str))
    print(json.dumps(out, default=str))
    return out


def main() -> None:
    import sys

    spark = SparkSession.builder.appName("asofmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, sys.argv[1:])


if __name__ == "__main__":
    main()
