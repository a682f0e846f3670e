"""Tables as versions: immutable folders of Parquet files by partition, and a small file that says which are current.

    table/_data/<generation>/part=<value>/*.parquet      written once, never changed
    table/_versions/<number>.json                        partition -> its folder

A write puts the new content of the partitions it touches into a generation of its own and then
adds the next version file. Readers take the highest one, so they see the table as it was before or
after a write and nothing between; a job that dies leaves folders that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writes import last_by_key, replace_by_key

#: The column that lays a table out, and its value where a table has one partition only.
PART, WHOLE = "part", "all"
#: Versions whose folders are kept for readers that are still at them.
KEPT = 2


class Conflict(Exception):
    """Another write added the same version first; nothing was changed."""


@dataclass
class Merge:
    """What a merge did: rows given, further observed figures, partitions rewritten, the new version."""

    rows: int = 0
    figures: dict[str, int] = field(default_factory=dict)
    parts: list[str] = field(default_factory=list)
    version: int = 0


def figures_of(seen: Observation, *names: str) -> dict[str, object]:
    """What an observation was told; zeros where no row was there to be observed, since Spark then plans nothing to observe it by."""
    try:
        got = seen.get
    except Py4JJavaError:
        got = {}
    return {n: got.get(n) or 0 for n in names or got}


def _path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    at, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _remove(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


class VersionedTable:
    """The table in the folder ``path``; ``part`` gives a row's partition (none: the table is one).

    ``part`` depends on key columns only, so a row and what replaces it share a partition.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: tuple[str, ...] = (), part: Column | None = None, sort: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.key, self.sort = spark, path.rstrip("/"), schema, list(key), list(sort or key)
        self.part = F.coalesce(part.cast("string"), F.lit("none")) if part is not None else F.lit(WHOLE)

    # ---- reading ----

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in _children(self.spark, f"{self.path}/_versions") if n.endswith(".json")]

    def parts(self, version: int | None = None) -> dict[str, str]:
        """partition -> folder of a version (the current one); none where nothing was ever written."""
        known = self.versions()
        if not known:
            return {}
        return json.loads(self._text(f"{self.path}/_versions/{known[-1] if version is None else version:08d}.json"))

    def _text(self, path: str) -> str:
        at, fs = _path(self.spark, path)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """Rows of the current version, or of some of its partitions; columns that older files lack are null."""
        held = self.parts()
        folders = [f"{self.path}/{held[p]}" for p in (held if parts is None else parts) if p in held]
        return self.spark.read.schema(self.schema).parquet(*folders).select(*self.schema.names) if folders else self.spark.createDataFrame([], self.schema)

    # ---- writing ----

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """The rows in a new generation; partition -> folder."""
        generation = f"_data/{uuid.uuid4().hex}"
        laid = rows.withColumn(PART, self.part).repartition(PART, *self.key[:1]).sortWithinPartitions(PART, *self.sort)
        laid.write.partitionBy(PART).option("maxRecordsPerFile", 5_000_000).parquet(f"{self.path}/{generation}")
        return {c.partition("=")[2]: f"{generation}/{c}" for c in _children(self.spark, f"{self.path}/{generation}") if c.startswith(f"{PART}=")}

    def _switch(self, parts: dict[str, str], after: int) -> int:
        """Add the version that follows ``after``; the file appears whole or not at all."""
        number = after + 1
        target, fs = _path(self.spark, f"{self.path}/_versions/{number:08d}.json")
        waiting, _ = _path(self.spark, f"{self.path}/_versions/.{uuid.uuid4().hex}")
        stream = fs.create(waiting, False)
        stream.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        stream.close()
        if fs.exists(target) or not fs.rename(waiting, target):
            fs.delete(waiting, False)
            raise Conflict(f"version {number} of {self.path} was written meanwhile")
        return number

    def _tidy(self) -> None:
        """Drop versions but the last ones, and the folders that only those named."""
        known = self.versions()
        for number in known[:-KEPT]:
            _remove(self.spark, f"{self.path}/_versions/{number:08d}.json")
        named = {f.split("/")[1] + "/" + f.split("/")[2] for n in known[-KEPT:] for f in self.parts(n).values()}
        for generation in _children(self.spark, f"{self.path}/_data"):
            own = _children(self.spark, f"{self.path}/_data/{generation}")
            gone = [c for c in own if c.startswith(f"{PART}=") and f"{generation}/{c}" not in named]
            if len(gone) == len([c for c in own if c.startswith(f"{PART}=")]):
                _remove(self.spark, f"{self.path}/_data/{generation}")
            else:
                for c in gone:
                    _remove(self.spark, f"{self.path}/_data/{generation}/{c}")

    def overwrite(self, rows: DataFrame) -> Merge:
        """The table's whole content anew; rows may be derived from the table itself."""
        before, seen = self.versions(), Observation()
        parts = self._write(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        made = Merge(figures_of(seen, "rows")["rows"], {}, sorted(parts), self._switch(parts, before[-1] if before else 0))
        self._tidy()
        return made

    def merge(
        self, rows: DataFrame, order: list[Column | str], figures: dict[str, Column] | None = None, changed: Callable[[DataFrame, DataFrame], None] | None = None, later: str | None = None
    ) -> Merge:
        """Replace rows by key, and rewrite the partitions that the rows fall into, no others.

        ``rows`` (the table's columns, those of ``order`` and of the ``figures``) are computed once: they are written
        aside, counted as they pass, and merged from there. Of several rows of a key the last in ``order`` counts.
        ``changed`` is called with the old and the new rows of the partitions touched before the version is switched. With ``later``, a column
        that the table keeps, a row only replaces one of its key whose value there is smaller (or null).
        """
        before, seen = self.versions(), Observation()
        aside = f"{self.path}/_staging/{uuid.uuid4().hex}"
        watched = rows.withColumn(PART, self.part).observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (figures or {}).items()])
        watched.write.partitionBy(PART).parquet(aside)
        try:
            found = figures_of(seen, "rows", *(figures or {}))
            touched = [c.partition("=")[2] for c in _children(self.spark, aside) if c.startswith(f"{PART}=")]
            held = self.parts()
            if touched:
                new = self.spark.read.schema(rows.schema).parquet(*[f"{aside}/{PART}={p}" for p in touched])
                old = self.read(touched)
                if later is not None:
                    new = last_by_key(new, self.key, order)
                    was = old.select(*[F.col(k).alias(f"__{k}") for k in self.key], F.col(later).alias("__later")).filter(F.col("__later").isNotNull())
                    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.key])
                    new = new.join(was, same & (F.col("__later") >= F.col(later)), "left_anti")
                if changed is not None:
                    changed(old, last_by_key(new, self.key, order).select(*self.schema.names))
                parts = held | self._write(replace_by_key(old, new, self.key, order))
                version = self._switch(parts, before[-1] if before else 0)
                self._tidy()
            else:
                version = before[-1] if before else 0
            return Merge(found.pop("rows"), found, touched, version)
        finally:
            _remove(self.spark, aside)

    def replace_where(self, rows: DataFrame, gone: Callable[[DataFrame], DataFrame], parts: list[str]) -> Merge:
        """In the named partitions, what ``gone`` leaves of the old rows and the new ``rows``, all of which belong there; other partitions stay."""
        before, seen, held = self.versions(), Observation(), self.parts()
        made = gone(self.read(parts)).unionByName(rows.observe(seen, F.count(F.lit(1)).alias("rows")))
        written = self._write(made)
        now = {p: f for p, f in held.items() if p not in parts} | written
        version = self._switch(now, before[-1] if before else 0)
        self._tidy()
        return Merge(figures_of(seen, "rows")["rows"], {}, sorted(written), version)
