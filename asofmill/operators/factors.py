"""Daily factor returns: one wide table from overlapping files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_files(files: list[tuple[DataFrame, list[str]]], columns: list[str], old: DataFrame | None = None) -> DataFrame:
    """date and ``columns`` from several files, each a frame and the columns that it owns; a later file wins.

    A file sets its own columns on its own days, nulls too, and no others: one grouping by day
    of all rows, where the last file that owns a column on a day gives the value.
    """
    parts = [(old, columns)] if old is not None else []
    parts += files

    def tagged(i: int, rows: DataFrame, own: list[str]) -> DataFrame:
        return rows.select("date", *[(F.struct(F.lit(i).alias("nth"), F.col(c).alias("v")) if c in own else F.lit(None).cast("struct<nth:int,v:double>")).alias(c) for c in columns])

    every = reduce(DataFrame.unionByName, [tagged(i, rows, own) for i, (rows, own) in enumerate(parts)])
    return every.groupBy("date").agg(*[F.max_by(F.col(f"{c}.v"), F.col(f"{c}.nth")).alias(c) for c in columns])


def long_form(factors: DataFrame, columns: list[str]) -> DataFrame:
    """date, factor, v."""
    return factors.unpivot(["date"], columns, "factor", "v")


def coverage(factors: DataFrame, columns: list[str], days_per_year: int = 252) -> DataFrame:
    """factor, n_days, first_date, last_date, mean, yearly_mean of the days that have a value."""
    rows = long_form(factors, columns).filter(F.col("v").isNotNull())
    total = F.sum(F.col("v").cast("decimal(28,10)")).cast("double")
    return rows.groupBy("factor").agg(F.count("v").alias("n_days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), (total / F.count("v")).alias("mean")).withColumn(
        "yearly_mean", F.col("mean") * days_per_year
    )


def growth(rows: DataFrame, by: list[str], percent: Column) -> DataFrame:
    """rows with ``growth``: what one unit has become after each day's return, in percent (above -100)."""
    w = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("growth", F.exp(F.sum(F.log1p(percent / 100)).over(w)))
