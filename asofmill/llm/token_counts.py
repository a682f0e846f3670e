"""Exact histogram of encoded lengths, and what suffix sums over it answer.

Texts are encoded once, in tasks; after that only (length, documents) rows remain. Sums over
longer lengths give, for every context limit, the documents and tokens that fit, the truncated
total and every quantile.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import split_text_batches, stage

#: A public byte-level vocabulary of 50,256 ranks and its split pattern.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lengths that one block of the suffix sums holds.
BLOCK = 1024

_encodings: dict[int, tiktoken.Encoding] = {}


def encoding_of(raw: bytes) -> tiktoken.Encoding:
    """The encoding of a rank file's content; one for each process."""
    key = hash(raw)
    if key not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        _encodings[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


#: Runs of blanks that are taken out of a text before it is split: the pattern's search gives up on much longer ones.
_BLANKS = re.compile(r"\s{4096,}")


def n_tokens(encoding: tiktoken.Encoding, text: str) -> int:
    """Tokens of a text, special ones read as text. Of a very long run of blanks all but the last is one piece by the pattern, and is encoded as such."""
    count = lambda part: len(encoding.encode(part, disallowed_special=()))  # noqa: E731  encode_ordinary ends the process where this raises
    try:
        return count(text)
    except ValueError:
        total, at = 0, 0
        for run in _BLANKS.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            total += count(text[at : run.start()]) + len(encoding._encode_single_piece(text[run.start() : end].encode()))
            at = end
        return total + count(text[at:])


def read_vocabulary(spark: SparkSession, path: str) -> bytes:
    """The rank file (a few MB at most), from any store that Spark reads; a bare path is one of the driver's own files."""
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """n_tokens of every text, one row each, repeated rows too; null and empty texts have 0, an empty table has no rows, and long texts are encoded whole."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(docs.sparkSession, vocabulary))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoding_of(shared.value)
        for batch in split_text_batches(batches, "text"):
            made = np.fromiter((n_tokens(encoding, t) if t else 0 for t in batch.column(0).to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(made)], names=["n_tokens"])

    return docs.select(F.col("text").cast("string")).mapInArrow(rows, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """One row for each length that occurs.

    n_tokens, n_docs; docs_upto and docs_from (as long at most, at least); tokens_from; total
    (all tokens); truncated_total (tokens left if every text is cut to n_tokens); quantile (the
    share of documents as long at most). An empty table gives no rows.

    Sums run inside blocks of ``BLOCK`` lengths and over the blocks' own sums, so no task holds
    more than a block of lengths or the list of blocks.
    """
    # written, since two branches read it: texts are encoded once
    counts = stage(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    counts = counts.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = (
        counts.groupBy("block")
        .agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            F.col("block").alias("own"),
            F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
            F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
            F.sum("d").over(every).alias("all_docs"),
            F.sum("t").over(every).alias("total"),
        )
    )
    here = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    docs_from = F.col("later_docs") + F.sum("n_docs").over(here)
    tokens_from = F.col("later_tokens") + F.sum("tokens").over(here)
    return (
        counts.join(blocks, F.col("block") == F.col("own"))
        .withColumn("docs_from", docs_from)
        .withColumn("tokens_from", tokens_from)
        .withColumn("docs_upto", F.col("all_docs") - F.col("docs_from") + F.col("n_docs"))
        .withColumn("truncated_total", F.col("total") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from"))
        .withColumn("quantile", F.col("docs_upto") / F.col("all_docs"))
        .select("n_tokens", "n_docs", "docs_upto", "docs_from", "tokens_from", "total", "truncated_total", "quantile")
    )


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit: limit, docs_over (longer ones), tokens_over (theirs), truncated_total. Any limits; one pass over the histogram."""
    limit = F.explode(F.array(*[F.lit(int(x)) for x in sorted(set(limits))]).cast("array<bigint>"))
    wanted = hist.sparkSession.range(1).select(limit.alias("limit"))
    over = F.col("n_tokens") > F.col("limit")
    found = (
        hist.select("n_tokens", "n_docs", limit.alias("limit"))
        .groupBy("limit")
        .agg(
            F.sum(F.when(over, F.col("n_docs"))).alias("docs_over"),
            F.sum(F.when(over, F.col("n_docs") * F.col("n_tokens"))).alias("tokens_over"),
            F.sum(F.col("n_docs") * F.least("n_tokens", "limit")).alias("truncated_total"),
        )
    )
    return wanted.join(found, "limit", "left").na.fill(0)


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """For each share (0 to 1): the smallest length that so many of the documents do not pass."""
    return hist.select(F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"), "n_tokens", "quantile").filter(
        F.col("quantile") >= F.col("share")
    ).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
