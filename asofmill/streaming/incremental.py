"""Incremental loads: files that land in a folder replace rows of a table by key, whatever order they come in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.versions import VersionedTable
from ..sources.landing import SEQUENCE
from ..sources.schemas import TABLES

#: When a row's file was written, and its name: what came later counts.
ORDER = T.StructType([T.StructField("file_modification_time", T.TimestampType()), T.StructField("file_path", T.StringType())])


def followed(spark: SparkSession, table: str, path: str, day: str | None = None) -> VersionedTable:
    """The table at ``path``, whose rows also keep the file that they came from; laid out by the year of ``day`` (a key column)."""
    target = TABLES[table]
    schema = T.StructType([*target.schema.fields, T.StructField(SEQUENCE, ORDER)])
    return VersionedTable(spark, path, schema, target.key, F.year(day) if day else None)


def follow(
    spark: SparkSession, folder: str, columns: list[str], transform: Callable[[DataFrame], DataFrame], table: str, path: str, checkpoint: str, once: bool = True, day: str | None = None
) -> StreamingQuery:
    """Start a stream over CSV files (header, all text) in ``folder`` into the versioned table at ``path`` (``followed``).

    ``transform`` gives rows of the table ``table`` with the column ``SEQUENCE`` that it gets
    (the loaders of ``landing`` do). A row replaces the one of its key only if its file was written later than that one's. So a batch that
    is run again after a failure changes nothing, nor does a file that arrives late or twice. A batch rewrites the
    years that its rows fall into. With ``once`` the stream ends when it has read what is there.
    """
    target = TABLES[table]
    lines = spark.readStream.option("header", True).schema(", ".join(f"`{c}` string" for c in columns)).csv(folder)
    lines = lines.withColumn(SEQUENCE, F.struct("_metadata.file_modification_time", "_metadata.file_path").cast(ORDER))

    def apply(batch: DataFrame, number: int) -> None:
        rows = transform(batch).select("*")
        followed(batch.sparkSession, table, path, day).merge(target.conform(rows, SEQUENCE), [SEQUENCE], later=SEQUENCE)

    started = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (started.trigger(availableNow=True) if once else started).start()
