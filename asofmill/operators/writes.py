"""Keyed writes: replacement, per-column and preserving upserts, ledgers, resumable work lists.

Plain Parquet has no MERGE. Each function gives the table's new content as a DataFrame;
``versions`` writes it beside the old one and then switches to it.
"""

from __future__ import annotations

import atexit
import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _same(a: DataFrame, b: DataFrame, key: list[str]) -> Column:
    on = F.lit(True)
    for k in key:
        on = on & a[k].eqNullSafe(b[k])
    return on


def last_by_key(rows: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, null parts being equal to each other: the last in ``order``."""
    ranked = rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) if isinstance(c, str) else c.desc() for c in order])))
    return ranked.filter("__nth = 1").drop("__nth")


def first_by_key(rows: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``."""
    ranked = rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("__nth = 1").drop("__nth")


def replace_by_key(old: DataFrame, new: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """``old`` with whole rows of ``new`` in place of those with the same key; of several new ones the last in ``order`` counts.

    Old rows are unique already, so they are only filtered: the sort covers the new rows alone.
    """
    fresh = last_by_key(new, key, order).select(*old.columns)
    kept = old.join(fresh.select(*key), _same(old, fresh, key), "left_anti")
    return kept.unionByName(fresh)


def column_upsert(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """``old`` in which rows of ``new`` (unique by key) set their own ``columns``, null values too; all other columns stay."""
    a, b = old.withColumn("__old", F.lit(True)).alias("a"), new.select(*key, *columns).withColumn("__new", F.lit(True)).alias("b")
    on = F.lit(True)
    for k in key:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    out = []
    for c in old.columns:
        if c in key:
            out.append(F.when(F.col("__old"), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
        elif c in columns:
            out.append(F.when(F.col("__new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c))
        else:
            out.append(F.col(f"a.{c}").alias(c))
    return a.join(b, on, "full_outer").select(*out)


def preserve_upsert(old: DataFrame, new: DataFrame, key: list[str], preserved: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old``, but keep the old values of the ``preserved`` columns; other old rows stay."""
    held = old.select(*key, *[F.col(c).alias(f"__{c}") for c in preserved])
    fresh = new.select(*[c for c in old.columns if c not in preserved])
    joined = fresh.join(held, _same(fresh, held, key), "left")
    made = joined.select(*[F.col(f"__{c}").alias(c) if c in preserved else fresh[c] for c in old.columns])
    return old.join(fresh.select(*key), _same(old, fresh, key), "left_anti").unionByName(made)


def keyed_update(old: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``old`` with ``columns`` set where ``values`` (unique by key) has one; the rest as it was."""
    new = values.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = old.join(new, old[key] == F.col("__key"), "left")
    return joined.select(*[F.coalesce(F.col(f"__{c}"), old[c]).alias(c) if c in columns else old[c] for c in old.columns])


def worklist(wanted: DataFrame, covered: DataFrame, key: str, upto: Column | None = None) -> DataFrame:
    """Rows of ``wanted`` whose key ``covered`` lacks, or holds only up to an earlier day than ``upto`` (by its column date)."""
    done = covered.groupBy(key).agg(F.max("date").alias("__last")).filter(F.col("__last") >= upto) if upto is not None else covered.select(key).distinct()
    return wanted.join(done.select(F.col(key).alias("__done")), wanted[key] == F.col("__done"), "left_anti")


def ledger_row(spark: SparkSession, source: str, as_of: dt.date | None, row_count: int, pulled_at: dt.datetime | None = None) -> DataFrame:
    """One row of the provenance ledger."""
    now = pulled_at or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    return spark.createDataFrame([(source, now, as_of, row_count)], "source string, pulled_at timestamp_ntz, as_of date, row_count int")


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


@contextmanager
def aside(rows: DataFrame, folder: str) -> Iterator[DataFrame]:
    """The rows, written into ``folder`` once and read back, for what several steps read; removed at the end."""
    spark, path = rows.sparkSession, f"{folder}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def kept(rows: DataFrame, folder: str) -> DataFrame:
    """The rows, written into ``folder`` once and read back, for a result that outlasts the step; removed when the application ends."""
    held = ExitStack()
    found = held.enter_context(aside(rows, folder))

    def remove() -> None:
        try:
            held.close()
        except Exception:  # the JVM has gone: nothing is left to ask
            pass

    atexit.register(remove)
    return found


def key_violations(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that several rows have, and how many."""
    return rows.groupBy(*key).count().filter("count > 1")
