"""Helpers shared by the training-data operators: staging, guarded broadcasts, vectorised word spans."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words in the contracts that take words ``[^\x20\x09-\x0D]+``.
BLANK_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); one of our own only where that is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = "file://" + tempfile.mkdtemp(prefix="asofmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


_cleaned: set[str] = set()


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    if folder in _cleaned:
        return
    _cleaned.add(folder)

    def remove() -> None:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the JVM has gone: nothing is left to ask
            pass

    atexit.register(remove)


def quoted(names: list[str]) -> list[str]:
    """Column names as references, whatever characters they hold."""
    return [f"`{n.replace('`', '``')}`" for n in names]


#: Whether Spark removes a query's shuffle files when it ends, instead of when the driver's garbage collection finds them unused.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Most bytes of a batch that goes to a Python worker (rows of more come alone); Spark's own limit is 10,000 rows or 64 MB, which the executor holds twice for each task.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session with these settings, and then as it was."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: What was staged within each ``settled`` that is under way.
_steps: list[list[str]] = []


def stage(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, and survives lost executors.

    The shuffle files behind it go as soon as it is written, since nothing reads them again. ``batch``: most bytes that go to Python at once, where rows are long.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/asofmill-{spark.sparkContext.applicationId}"
    _remove_at_exit(spark, folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex[:12]}"
    with _held(spark, {FREE_SHUFFLES: "true"} | ({ARROW_BYTES: str(batch)} if batch else {})):
        df.write.parquet(path)
    if _steps:
        _steps[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(staged: DataFrame) -> None:
    """Remove what ``stage`` wrote, once nothing is left to be computed from it."""
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        _remove(staged.sparkSession, folder)


def settled(make: Callable[[], DataFrame], name: str, batch: int | None = None) -> DataFrame:
    """``stage(make(), name, batch)``; all that ``make`` staged on the way is removed as soon as that is written."""
    _steps.append([])
    try:
        kept = stage(make(), name, batch)
    finally:
        staged = _steps.pop()
    for folder in staged[:-1]:
        _remove(kept.sparkSession, folder)
    if _steps:
        _steps[-1].append(staged[-1])
    return kept


#: Rows of a key list that may be broadcast (16 to 32 bytes each); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def guarded(small: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` with a broadcast hint if its counted ``rows`` are at most ``most``; else as it is, for a shuffled join."""
    return F.broadcast(small) if rows <= most else small


def within_share(chance: Column, rows: Column, wanted: int) -> Column:
    """Whether a 64-bit hash lies in the part of its range that holds about twice ``wanted`` of so many rows (always, for few rows)."""
    return (rows <= 2 * wanted) | ((chance / F.lit(2.0**64) + 0.5) * rows <= 2.0 * wanted)


def sample_of(rows: DataFrame, n: int, most: int, *key: str) -> DataFrame:
    """``most`` of n rows (all, if fewer): those with the smallest hashes of their different keys.

    Only twice as many pass the first filter, so that no task hands on more than its share.
    """
    chance = F.xxhash64(*key)
    return rows.filter(within_share(chance, F.lit(n), most)).orderBy(chance, *key).limit(most)


def split_text_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each (a longer text comes alone)."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())).fill_null(0).to_numpy(zero_copy_only=False)
        at, total = 0, 0
        for i, n in enumerate(lengths):
            if total and total + n > most:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += int(n)
        if at < len(lengths):
            yield batch.slice(at)


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after another, each followed by a newline (null as empty), and where each begins (and the end)."""
    raw = column.cast(pa.large_binary()).fill_null(b"")
    closed = pc.binary_join_element_wise(raw, pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    if isinstance(closed, pa.ChunkedArray):
        closed = closed.combine_chunks()
    if not len(closed):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset : closed.offset + len(closed) + 1]
    data = np.frombuffer(closed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def byte_class(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.bool_)
    out[list(members)] = True
    return out


IS_WORD_BYTE = ~byte_class(BLANK_BYTES)


def word_spans(data: np.ndarray, begins: np.ndarray, word_byte: np.ndarray = IS_WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-last byte of every word, and of each text the index of its first word (and the number of words)."""
    inside = word_byte[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]  # every text ends in a newline, so each word has its end
    return starts, ends, np.searchsorted(starts, begins)


_BASE, _BASE_INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= 1 << 22:
            _powers[int(base)] = known
    return known[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, by prefix sums of a polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=total[1:])
    own = (total[ends] - total[starts]) * powers(_BASE_INVERSE, len(data))[starts]
    return mix64(own ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def window_hashes(values: np.ndarray, at: np.ndarray, width: int, base: int) -> np.ndarray:
    """A 64-bit hash of values[i : i + width] for each i of ``at``."""
    base64 = np.uint64(base)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base64, len(values)), out=total[1:])
    inverse = powers(np.uint64(pow(base, -1, 1 << 64)), len(values) + 1)
    return mix64((total[at + width] - total[at]) * inverse[at])
