"""As-of joins: for each row the latest row of another table at or before its day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], ties: list[str] | None = None) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` with equal ``by`` and ``on`` at or before its own.

    Rows of one day are ordered by ``ties``, the last counts. Null values are passed over, each
    column by itself. Both tables are laid in one order and the last value is carried along, so
    it takes one shuffle by ``by`` and no pairs.
    """
    ties = ties or []
    kinds = {f.name: f.dataType for f in right.schema}
    rest = [c for c in left.columns if c not in by and c != on]
    a = left.select(*by, on, F.lit(1).alias("__side"), *[F.lit(None).cast(kinds[t]).alias(f"__t_{t}") for t in ties], *[F.lit(None).cast(kinds[v]).alias(f"__v_{v}") for v in values], F.struct(*rest).alias("__row"))
    shape = a.schema["__row"].dataType
    b = right.filter(F.col(on).isNotNull()).select(*by, on, F.lit(0).alias("__side"), *[F.col(t).alias(f"__t_{t}") for t in ties], *[F.col(v).alias(f"__v_{v}") for v in values], F.lit(None).cast(shape).alias("__row"))
    order = Window.partitionBy(*by).orderBy(F.col(on), F.col("__side"), *[F.col(f"__t_{t}") for t in ties]).rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).select("*", *[F.last(f"__v_{v}", ignorenulls=True).over(order).alias(v) for v in values])
    return both.filter("__side = 1").select(*[F.col(c) if c in by or c == on else F.col(f"__row.{c}").alias(c) for c in left.columns], *values)


def latest_upto(rows: DataFrame, by: list[str], on: str, day: Column, values: list[str], ties: list[str] | None = None) -> DataFrame:
    """For each ``by`` the ``values`` of its last row at or before ``day`` (null ones too)."""
    order = F.struct(F.col(on), *[F.col(t) for t in ties or []])
    return rows.filter(F.col(on) <= day).groupBy(*by).agg(*[F.max_by(v, order).alias(v) for v in values])


def latest_rows(rows: DataFrame, by: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The last ``n`` rows of each ``by``."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*[F.desc(c) if isinstance(c, str) else c for c in order]))
    return rows.withColumn("__nth", nth).filter(F.col("__nth") <= n).drop("__nth")
