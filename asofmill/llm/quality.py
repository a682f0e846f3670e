"""Quality scores learned from preference pairs (Bradley-Terry).

A document's worth is a linear function of what its whole text looks like: shares of kinds of
bytes and of pairs of bytes, and how its words and lines repeat. A good document is preferred
to a poor one with probability s(w . (x_good - x_poor)); w minimises the logistic loss over
pairs drawn from a bounded sample of labelled documents. A quantile of the sample's worths is
the threshold; scores are shifted so that it has the score ``CUT``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import joined_bytes, sample_of, span_hashes, split_text_batches, word_spans

#: Score of the threshold; labelled documents of each label in the bounded sample; pairs of bytes are counted in so many buckets.
CUT, PER_LABEL, PAIRS = 0.3, 5_000, 128

_SINGLE = b".,;:!?*#%&$|@+=_-/\\\"'()[]{}<>~^`"


def _byte_kinds() -> np.ndarray:
    kind = np.full(256, 5, np.uint8)  # control bytes
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 0, 1, 2, 6
    kind[32], kind[10] = 3, 4
    kind[list(_SINGLE)] = 7 + np.arange(len(_SINGLE))
    return kind


KINDS = _byte_kinds()
N_KINDS = int(KINDS.max()) + 1
N_FEATURES = N_KINDS + PAIRS + 12


def features(column: pa.Array) -> np.ndarray:
    """(texts, N_FEATURES) of whole texts; an empty or null text has zeros."""
    data, begins = joined_bytes(column)
    n = len(begins) - 1
    size = (np.diff(begins) - 1).astype(np.float64)
    some = np.maximum(size, 1)[:, None]
    of_byte = np.repeat(np.arange(n), np.diff(begins))
    kinds = np.bincount(of_byte * N_KINDS + KINDS[data], minlength=n * N_KINDS).reshape(n, N_KINDS).astype(np.float64)
    kinds[:, 4] -= 1  # the newline that closes each text is not its own
    pair = (data[:-1].astype(np.int64) * 259 + data[1:] * 31) % 1021 % PAIRS if len(data) else np.zeros(0, np.int64)
    inner = of_byte[:-1] == of_byte[1:]
    pairs = np.bincount(of_byte[:-1][inner] * PAIRS + pair[inner], minlength=n * PAIRS).reshape(n, PAIRS)
    starts, ends, first = word_spans(data, begins)
    words = np.diff(first)
    of_word = np.repeat(np.arange(n), words)
    hashes, length = span_hashes(data, starts, ends), ends - starts
    some_words = np.maximum(words, 1)
    share = lambda mask: np.bincount(of_word[mask], minlength=n) / some_words
    first_byte, last_byte = data[starts], data[ends - 1]
    upper = (first_byte >= 65) & (first_byte <= 90)
    order = np.lexsort((hashes, of_word))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
    distinct = np.bincount(of_word[order][new], minlength=n)
    at = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, of_word[order][at], np.diff(np.append(at, len(order))))
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    wide = np.bincount(of_word, weights=length, minlength=n) / some_words
    lines = kinds[:, 4] + 1
    out = np.concatenate(
        (
            np.sqrt(np.maximum(kinds, 0) / some),
            np.sqrt(pairs / some),
            np.stack(
                (
                    np.log1p(size), np.log1p(words), wide,
                    np.sqrt(np.bincount(of_word, weights=(length - wide[of_word]) ** 2, minlength=n) / some_words),
                    distinct / some_words, np.log1p(words) - np.log1p(distinct), np.sqrt(top / some_words), np.sqrt(share(again)),
                    share(upper), share(upper & (last_byte >= 65) & (last_byte <= 90)), share((last_byte < 48) & (last_byte != 46) & (last_byte != 44)), np.log1p(words / lines),
                ),
                axis=1,
            ),
        ),
        axis=1,
    )
    out[size == 0] = 0
    return out


class Ranking:
    """Weights, and how a worth becomes a score."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray, threshold: float, constant: float | None = None):
        self.mean, self.scale, self.weight, self.threshold, self.constant = mean, scale, weight, threshold, constant

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        above = np.clip(self.worth(x) - self.threshold, -30, 30)
        return 1 / (1 + (1 - CUT) / CUT * np.exp(-above))


def fit(good: np.ndarray, poor: np.ndarray, n_good: int, n_poor: int, steps: int = 800, batch: int = 1024, rate: float = 0.03, ridge: float = 1e-4) -> Ranking:
    """Pairwise logistic loss on random (good, poor) pairs by Adam. n_good, n_poor: the labels' counts in all training rows."""
    width = N_FEATURES
    if not len(good) or not len(poor):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0 if len(poor) else 0.5)
    every = np.concatenate((good, poor))
    mean, scale = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-3)
    model = Ranking(mean, scale, np.zeros(width), 0.0)
    a, b = (np.clip((x - mean) / scale, -8, 8) for x in (good, poor))
    random = np.random.default_rng(17)
    m = v = np.zeros(width)
    for step in range(1, steps + 1):
        differ = a[random.integers(0, len(a), batch)] - b[random.integers(0, len(b), batch)]
        miss = 1 / (1 + np.exp(np.clip(differ @ model.weight, -30, 30)))
        g = -(miss @ differ) / batch + ridge * model.weight
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        model.weight = model.weight - rate * (1 - (step - 1) / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    # the threshold is the quantile of the worths, weighted as all training labels are, that parts the labels best
    worth = np.concatenate((a @ model.weight, b @ model.weight))
    weight = np.concatenate((np.full(len(a), n_good / len(a)), np.full(len(b), n_poor / len(b))))
    gain = np.concatenate((-weight[: len(a)], weight[len(a) :]))
    order = np.argsort(worth, kind="stable")
    parted = np.concatenate(([0.0], np.cumsum(gain[order])))
    best = int(parted.argmax())
    ranked = worth[order]
    low, high = ranked[max(0, best - 1)], ranked[min(best, len(ranked) - 1)]
    model.threshold = float((low + high) / 2 if best else ranked[0] - 1)
    return model


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null without an id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Ranking:
    """Learn from labelled documents outside the held-out fold (crc32 modulo 5 is 0): at most ``per_label`` of each label, by a hash of their ids.

    Of several rows of one id, one is learned from, by a hash of its text. Empty tables give a
    model without weights (see ``classify``).
    """
    ship(docs.sparkSession)
    known = (
        labels.filter((fold("doc_id", 5) != 0) & F.col("quality").isin(0, 1))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    of_label = lambda q: sample_of(known.filter(F.col("quality") == q), counts.get(q, 0), per_label, "labelled")
    chosen = of_label(0).union(of_label(1))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    # of an id's several rows one is learned from, so at most 2 * per_label rows reach the driver
    texts = texts.groupBy("labelled", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.hash("text"))).alias("text")).select("quality", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_text_batches(batches, "text"):
            made = features(batch.column(1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in made], pa.binary())], names=["quality", "x"])

    sample = texts.mapInArrow(rows, "quality int, x binary").toPandas()
    sample = sample.sort_values(["quality", "x"], kind="stable") if len(sample) else pd.DataFrame({"quality": [], "x": []})
    of = lambda q: np.frombuffer(b"".join(map(bytes, sample.x[sample.quality == q])), np.float32).reshape(-1, N_FEATURES).astype(np.float64)
    return fit(of(1), of(0), counts.get(1, 0), counts.get(0, 0))


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """doc_id, score (0 to 1, eight digits) and predicted (1 if the score is at least ``CUT``), one row for every input row. Only doc_id and text are read."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_text_batches(batches, "text"):
            made = np.round(shared.value.score(features(batch.column(1))), 8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made), pa.array((made >= CUT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Without good labels every score is 0, without poor ones 0.5. A null or empty text is scored
    like any other, by features that are all 0; a very long one is read whole. Repeated rows come
    back repeated, with equal scores; an empty table gives no rows. Ids labelled more than once count by their
    smallest label; null and other labels and null ids are not learned from.
    """
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return score(docs, train(docs, labels)).select("doc_id", held_out.alias("held_out"), "score", "predicted")
