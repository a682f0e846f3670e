"""Downloads that a manifest gates: a file is fetched only if its stamp has changed."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol


class Fetcher(Protocol):
    """What reaches the network; tests pass their own."""

    def get_json(self, url: str) -> object: ...

    def get_bytes(self, url: str) -> Iterable[bytes]: ...

    def stamp(self, url: str) -> str | None: ...


class Busy(Exception):
    """The server asks to wait so many seconds (none: as long as the caller thinks fit)."""

    def __init__(self, seconds: float | None = None):
        super().__init__(seconds)
        self.seconds = seconds


def patiently(action: Callable[[], object], attempts: int = 8, first_wait: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """The action's result; after ``Busy`` it is tried again, after the time asked for or twice the last wait."""
    wait = first_wait
    for left in reversed(range(attempts)):
        try:
            return action()
        except Busy as busy:
            if not left:
                raise
            sleep(busy.seconds if busy.seconds is not None else wait)
            wait *= 2


@dataclass
class Manifest:
    """Stamps of what has been loaded, as JSON beside the files."""

    path: str
    stamps: dict[str, dict] = field(default_factory=dict)

    @classmethod
    def read(cls, folder: str) -> Manifest:
        path = os.path.join(folder, "manifest.json")
        if not os.path.exists(path):
            return cls(path)
        with open(path) as f:
            return cls(path, json.load(f))

    def is_current(self, name: str, stamp: str | None) -> bool:
        return stamp is not None and self.stamps.get(name, {}).get("modified") == stamp

    def note(self, name: str, **what) -> None:
        """Write the entry; to be called when the load has succeeded, so that a failed one is tried again."""
        self.stamps[name] = what
        with open(f"{self.path}.new", "w") as f:
            json.dump(self.stamps, f, indent=1, sort_keys=True)
        os.replace(f"{self.path}.new", self.path)


def download(fetcher: Fetcher, url: str, target: str, sleep: Callable[[float], None] = time.sleep) -> str:
    """The file at ``url``, whole or not at all."""

    def fetch() -> str:
        with open(f"{target}.part", "wb") as out:
            for piece in fetcher.get_bytes(url):
                out.write(piece)
        os.replace(f"{target}.part", target)
        return target

    return patiently(fetch, sleep=sleep)


def sync(fetcher: Fetcher, folder: str, wanted: dict[str, tuple[str, str | None]], load: Callable[[str, str], int], force: bool = False, sleep: Callable[[float], None] = time.sleep) -> dict[str, int | None]:
    """Fetch and load what has changed. wanted: name -> (url, stamp). Rows loaded by name; None where nothing had changed."""
    manifest, out = Manifest.read(folder), {}
    for name, (url, stamp) in wanted.items():
        if not force and manifest.is_current(name, stamp):
            out[name] = None
            continue
        path = download(fetcher, url, os.path.join(folder, os.path.basename(url.split("?")[0])), sleep)
        out[name] = load(name, path)
        manifest.note(name, modified=stamp, rows=out[name])
    return out


def bulk_files(status: dict, table: str, history: str = "full") -> list[tuple[str, str]]:
    """(name, modified) of a table's files in a bulk status document."""
    return [(f["name"], f["modified"]) for t in (status if isinstance(status, list) else [status]) if t.get("table") == table for f in t["files"] if f.get("history") == history]
