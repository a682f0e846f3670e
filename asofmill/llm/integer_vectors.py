"""Vectors as small integers, for operators that need the same result to the last bit wherever they run."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def most_component(width: int) -> int:
    """Largest component whose squared distances and inner products, over so many components, stay below 2**60."""
    return math.isqrt((1 << 58) // max(1, width))


def usable_width(rows: DataFrame) -> int:
    """The most frequent number of components of ``v``, the larger of two equally frequent ones; 0 without rows."""
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return width.w if width else 0


def integer_vectors(vectors: DataFrame, vector: str, scale: int, width: int | None, *columns: Column) -> tuple[DataFrame, int]:
    """``columns`` and q, the vector's components x as floor(scale * x), of the vectors with ``width`` components (the most frequent number, if None).

    Null vectors and those with null or non-finite components are left out, and so are those with a component
    beyond ``most_component``: what is added up of them need not fit in a long.
    """
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(*columns, v.alias("v")).filter(F.col("v").isNotNull())
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if width is None:
        width = usable_width(rows)
    most = float(most_component(width))
    rows = rows.filter((F.size("v") == width) & F.forall("v", lambda x: F.abs(x) * float(scale) <= most))
    q = F.transform("v", lambda x: F.floor(x * float(scale)).cast("int"))
    return rows.select(*[c for c in rows.columns if c != "v"], q.alias("q")), width


def matrix_of(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of equally long integer lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
