"""A table laid out as a vendor's server holds it, so that an answer costs what it holds and not what the table does.

Spark writes the rows into the shared folder in files of at most ``FILE`` rows, in order of a key if there is one. The index has a line for each
file, and an answer opens only the files that hold its rows. The last few files that a process has opened stay in its memory.
"""

from __future__ import annotations

import datetime as dt
import uuid
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import shared_folder
from .archives import qualified, store_of

#: Rows of a file at most.
FILE = 100_000


@lru_cache(maxsize=4)
def _table(path: str) -> pa.Table:
    store, at = store_of(path)
    with store.open_input_file(at) as file:
        return pq.ParquetFile(file).read().combine_chunks()


@lru_cache(maxsize=4)
def _places(path: str, key: str) -> dict[str, tuple[int, int]]:
    """Where the rows of each key begin and end in a file that is in order of it."""
    runs = pc.run_end_encode(_table(path).column(key).combine_chunks())
    runs = runs.combine_chunks() if isinstance(runs, pa.ChunkedArray) else runs
    ends = runs.run_ends.to_pylist()
    return {k: place for k, *place in zip(runs.values.to_pylist(), [0, *ends[:-1]], ends, strict=True)}


class Shelf:
    """Files in order: path, rows, least and greatest key of each."""

    def __init__(self, files: list[tuple[str, int, str | None, str | None]], key: str | None):
        self.key = key
        self.paths, self.counts, self.low, self.high = ([f[i] for f in files] for i in range(4))
        self.ends = np.cumsum(self.counts).tolist()

    def page(self, offset: int, limit: int) -> list[dict]:
        """``limit`` rows from ``offset`` on, in the order in which they lie."""
        out, i = [], bisect_right(self.ends, offset)
        while i < len(self.paths) and len(out) < limit:
            at = offset + len(out) - (self.ends[i] - self.counts[i])
            out += _table(self.paths[i]).slice(at, limit - len(out)).to_pylist()
            i += 1
        return out

    def of(self, keys: list[str], on: str, first: dt.date, last: dt.date, cap: int) -> list[dict]:
        """Rows of the keys whose day ``on`` lies between two days, both included; the first ``cap`` of them."""
        out: list[dict] = []
        for key in keys:
            # files overlap in their ends only: those of one key follow each other
            i = bisect_right(self.low, key) - 1
            while i >= 0 and self.high[i] >= key and len(out) < cap:
                begin, end = _places(self.paths[i], self.key).get(key, (0, 0))
                own = _table(self.paths[i]).slice(begin, end - begin)
                days = own.column(on)
                within = pc.and_(pc.greater_equal(days, pa.scalar(first)), pc.less_equal(days, pa.scalar(last)))
                out += own.filter(within).slice(0, cap - len(out)).to_pylist()
                i -= 1
        return out


def lay(rows: DataFrame, key: str | None = None, *then: str) -> Shelf:
    """The rows in files of the shared folder: as they lie, or in order of a text ``key`` (rows without it are left out), and ``then`` of further columns.

    A key of any size is spread over files by the further columns. The index that the driver keeps is a line for each ``FILE`` rows.
    """
    spark = rows.sparkSession
    folder = qualified(spark, f"{shared_folder(spark)}/shelf-{uuid.uuid4().hex[:12]}")
    if key:
        rows = rows.filter(F.col(key).isNotNull()).repartitionByRange(key, *then).sortWithinPartitions(key, *then)
    rows.write.option("maxRecordsPerFile", FILE).parquet(folder)
    ends = [F.min(key), F.max(key)] if key else [F.lit(None).cast("string"), F.lit(None).cast("string")]
    held = spark.read.schema(rows.schema).parquet(folder).groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)), *ends).collect()
    files = [tuple(r) for r in held]
    return Shelf(sorted(files, key=lambda f: (f[2], f[3], f[0]) if key else f[0]), key)
