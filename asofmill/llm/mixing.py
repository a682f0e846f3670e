"""Mixing sources to target weights by nested hash thresholds.

Every row gets a fixed hash; a source that has to give part of its words gives the rows whose
hash lies under a threshold. The thresholds come from histograms: words by source and hash
bucket, then by finer bucket inside the one bucket where the budget runs out, then by the few
hashes left there. Nothing is sorted, and one pass over the rows applies the thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, guarded, quoted, stage

#: Hexadecimal digits of the hash that each histogram resolves, and those of the whole hash.
BUCKET_DIGITS, HASH_DIGITS = 3, 15


def words_in(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits as hexadecimal digits, from the id, or the text where there is no id. Rows that agree in it are taken together."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), text), F.lit(""))), 1, HASH_DIGITS)


def targets(sized: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target: the total times ``share`` dealt by weight, no source above ``most`` times its size.

    Sources take the weights in turn, in code-point order with null last. What a full source
    leaves is dealt again by weight until no source is above its limit. That is one level L at
    which the sum of min(limit, L * weight) is the total: in order of limit / weight, a source is
    full if the level, with all before it full, is above its own. One row per source meets in a
    task here, never a row per document.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(n)) + 1).cast("int"))
    every = Window.partitionBy()
    level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("rank"))
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    return (
        by_source.withColumn("rank", F.row_number().over(rank))
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("weights", F.sum("weight").over(every))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("open", F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("full", F.col("left") * F.col("weight") > F.col("limit") * F.col("open"))
        .withColumn("free", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(every), F.lit(0.0)))
        .withColumn("rest", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every))
        .withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.col("free") * F.col("weight") / F.col("rest")))
        .select("source", "source_size", "target")
    )


def _boundary(words: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """The first bucket of each source with which the words pass the source's remainder, and what is left before it."""
    run = Window.partitionBy(*keys).orderBy(bucket)
    return (
        words.withColumn("upto", F.sum("words").over(run))
        .filter(F.col("upto") > F.col("left"))
        .groupBy(*keys)
        .agg(F.min_by(F.struct(F.col(bucket), (F.col("left") - F.col("upto") + F.col("words")).alias("left")), bucket).alias("b"))
        .select(*keys, F.col(f"b.{bucket}").alias(bucket), F.col("b.left").alias("left"))
    )


def _by_source(rows: DataFrame, other: DataFrame, sources: int, *more: str) -> DataFrame:
    """rows joined with a row for each source (and, under it, the columns ``more``)."""
    other = other.select(*[F.col(c).alias(f"__other_{c}" if c in ("source", *more) else c) for c in other.columns])
    on = F.col("source").eqNullSafe(F.col("__other_source"))
    for c in more:
        on = on & (F.col(c) == F.col(f"__other_{c}"))
    return rows.join(guarded(other, sources, 100_000), on).drop("__other_source", *[f"__other_{c}" for c in more])


def thresholds(sized: DataFrame, weights: tuple[float, ...], share: float, most: float) -> tuple[DataFrame, int]:
    """One row for each source, and how many there are: source, source_size, target, whole (times that each row is taken) and limit.

    Rows whose hash is below ``limit`` are taken once more; with a null limit all are if
    something is left over, else none (then limit is empty).
    """
    plan = stage(
        targets(sized, weights, share, most)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int"))
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-targets",
    )
    sources = plan.count()
    rows = sized.withColumn("low", F.substring("hash", 1, BUCKET_DIGITS)).withColumn("mid", F.substring("hash", BUCKET_DIGITS + 1, BUCKET_DIGITS))
    first = rows.groupBy("source", "low").agg(F.sum("size").alias("words"))
    edge = _boundary(_by_source(first, plan.select("source", "left"), sources), ["source"], "low")
    second = _by_source(rows, edge, sources, "low").groupBy("source", "low", "mid").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    edge = stage(_boundary(second, ["source", "low"], "mid"), "mix-edge")
    third = _by_source(rows, edge, sources, "low", "mid").groupBy("source", "hash").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    limit = _boundary(third, ["source"], "hash").select(F.col("source").alias("limit_source"), F.col("hash").alias("limit"))
    plan = plan.join(limit, F.col("source").eqNullSafe(F.col("limit_source")), "left").drop("limit_source")
    none = (F.col("left") <= 0) | (F.col("source_size") == 0)
    return stage(plan.withColumn("limit", F.when(none, "").otherwise(F.col("limit"))).drop("left"), "mix-plan"), sources


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and hash of every row."""
    return stage(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("hash")), "mix-sizes")


def _copies() -> Column:
    return (F.col("whole") + F.when(F.col("limit").isNull() | (F.col("hash") < F.col("limit")), 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """How often each document is to be taken so that the sources' words come to the target weights.

    Returns doc_id, size, source_size, target, copies (whole takes of the document) and taken
    (= copies * size), one row per input row. A source with target t and size s takes every
    document floor(t / s) times, and once more those whose hash lies under its threshold: the
    longest run of hashes, in their order, whose words stay within the remainder.

    Null and empty texts have size 0. Rows that agree in id (or, without id, in text) are taken
    alike. A null source is a source of its own, last in order. Only doc_id, text and source are
    read, so other columns may have any names. An empty table gives no rows.
    """
    sized = sizes(docs)
    plan, sources = thresholds(sized, weights, share, most)
    taken = _by_source(sized, plan, sources).withColumn("copies", _copies())
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


def take(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """The rows of docs that the mix takes, with all their columns and ``copies`` (1 or more; it replaces a column of that name)."""
    plan, sources = thresholds(sizes(docs), weights, share, most)
    names = [c for c in docs.columns if c != "copies"]
    held = docs.select(F.col("source"), row_hash(F.col("doc_id"), F.col("text")).alias("hash"), F.struct(*quoted(names)).alias("row"))
    return _by_source(held, plan, sources).withColumn("copies", _copies()).filter("copies > 0").select(*[F.col("row")[c].alias(c) for c in names], "copies")
