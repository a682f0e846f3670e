"""Removal of word windows that occur elsewhere, found through difference-cover anchors.

A window of W consecutive words is a repeat if the same W words also start anywhere else. Only
positions i with i modulo P in a difference cover are hashed, P - 1 + A = W for anchors of A
words: for any two places of equal windows there is a shift under P that puts both on the cover,
so equal windows share an anchor at the same shift. Anchors met twice are extended: the windows
that can hold one are hashed whole (96 bits) and counted; those met twice are removed.

Each task first looks for repeats among its own texts. Of an anchor or window it sends at most
two rows under its own key and marks the rest as settled, under keys that spread them. So a
passage in a third of all texts brings at most two rows per task into one group, not one per place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import BROADCAST_ROWS, guarded, joined_bytes, mix64, span_hashes, split_text_batches, stage, window_hashes, word_spans

#: Perfect difference sets: modulo the key every difference occurs.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
ANCHOR_BASE, WINDOW_BASES = 0xD6E8FEB86659FD93, (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
SLICE = 1 << 22
#: Keys that a task remembers.
SEEN = 1 << 22


def cover_for(window: int) -> tuple[int, int]:
    """Period and anchor length for a window: the largest period that leaves two fifths of the window to the anchor."""
    period = max(p for p in COVERS if window - p + 1 >= max(1, 0.4 * window))
    return period, window - period + 1


class Settled:
    """What a task has sent so far: which keys once, and which at least twice.

    ``SEEN`` keys are remembered; beyond them it starts anew, which only settles less in the task.
    """

    def __init__(self) -> None:
        self.once = self.twice = np.zeros(0, np.uint64)

    @staticmethod
    def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(keys), bool)
        return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys

    @staticmethod
    def _with(known: np.ndarray, new: np.ndarray) -> np.ndarray:
        new = np.sort(new)
        return np.insert(known, np.searchsorted(known, new), new)

    def flags(self, key: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Keys to send and flags of one slice: 0 one of its kind so far, 1 a row under its own key that has others, 2 a further one (with a key that spreads it)."""
        order = np.lexsort((key,) if second is None else (second, key))
        new = np.ones(len(key), bool)
        if len(key):
            new[1:] = key[order][1:] != key[order][:-1]
            if second is not None:
                new[1:] |= second[order][1:] != second[order][:-1]
        several = ~new
        several[:-1] |= ~new[1:]
        name = key if second is None else mix64(key ^ (second.astype(np.uint64) << np.uint64(32)))
        firsts = name[order][new]
        met, done = self._among(firsts, self.once), self._among(firsts, self.twice)
        flag = np.empty(len(key), np.int8)
        sent = np.where(new, several.astype(np.int8), 2)
        at = np.flatnonzero(new)
        sent[at[met]] = 1  # its row of an earlier slice went as one of its kind: this one tells of the repeat
        sent[at[done]] = 2
        flag[order] = sent
        again = several[at] & ~met & ~done
        # a key with several rows in this slice has gone under its own key once, marked: all its later rows are settled
        self.once = np.delete(self.once, np.searchsorted(self.once, firsts[met]))
        self.once = self._with(self.once, firsts[~(met | done | again)])
        self.twice = self._with(self.twice, firsts[met | again])
        if len(self.once) + len(self.twice) > SEEN:
            self.once = self.twice = np.zeros(0, np.uint64)
        spread = mix64(name + np.arange(len(key), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return np.where(flag == 2, spread, key), flag


def _anchors(window: int):
    period, width = cover_for(window)
    on_cover = np.isin(np.arange(period), COVERS[period])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = Settled()
        for batch in split_text_batches(batches, "text", SLICE):
            data, begins = joined_bytes(batch.column(1))
            starts, ends, first = word_spans(data, begins)
            counts = np.diff(first)
            place = np.arange(len(starts)) - np.repeat(first[:-1], counts)
            n = np.repeat(counts, counts)
            at = np.flatnonzero((n >= window) & (place + width <= n) & on_cover[place % period])
            if not len(at):
                continue
            hashed = window_hashes(span_hashes(data, starts, ends), at, width, ANCHOR_BASE)
            key, flag = settled.flags(hashed)
            of = np.repeat(np.arange(len(counts)), counts)[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(batch.column(0).to_numpy()[of]), pa.array(place[at] * 4 + flag, pa.int64())], names=["key", "row_a", "place"]
            )

    return rows


def _windows(window: int):
    period, _ = cover_for(window)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = Settled()
        for batch in split_text_batches(batches, "text", SLICE):
            row_no, text, anchors, copies = (batch.column(i) for i in range(4))
            data, begins = joined_bytes(text)
            starts, ends, first = word_spans(data, begins)
            counts = np.diff(first)
            held = anchors.offsets.to_numpy()
            where = anchors.values.to_numpy()[held[0] : held[-1]] + np.repeat(first[:-1], np.diff(held))
            # a window that begins up to period - 1 words before an anchor, or at it, holds the anchor
            low = np.maximum(where - period + 1, np.repeat(first[:-1], np.diff(held)))
            open_ = np.zeros(len(starts) + 1, np.int64)
            np.add.at(open_, low, 1)
            np.add.at(open_, where + 1, -1)
            place = np.arange(len(starts)) - np.repeat(first[:-1], counts)
            at = np.flatnonzero((np.cumsum(open_)[:-1] > 0) & (place + window <= np.repeat(counts, counts)))
            if not len(at):
                continue
            words = span_hashes(data, starts, ends)
            one = window_hashes(words, at, window, WINDOW_BASES[0])
            two = (window_hashes(mix64(words + np.uint64(1)), at, window, WINDOW_BASES[1]) >> np.uint64(32)).astype(np.uint32)
            key, flag = settled.flags(one, two)
            of = np.repeat(np.arange(len(counts)), counts)[at]
            flag = np.where((copies.to_numpy()[of] > 1) & (flag == 0), 1, flag)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(two.view(np.int32)), pa.array(row_no.to_numpy()[of]), pa.array(place[at] * 4 + flag, pa.int64())],
                names=["key", "key_b", "row_no", "place"],
            )

    return rows


def _cut(window: int):
    """Words that no repeated window covers. Columns: doc_id, row_a, row_b, text, copies, places (starts of repeated windows, or null)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_text_batches(batches, "text", SLICE):
            texts, places = batch.column(3).cast(pa.large_binary()).to_pylist(), batch.column(5)
            total, removed, kept = [], [], []
            for i, text in enumerate(texts):
                words = (text or b"").split()
                total.append(len(words))
                if places[i].is_valid:
                    edge = np.zeros(len(words) + 1, np.int32)
                    starts = places[i].values.to_numpy()
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), batch.column(4)],
                names=["doc_id", "row_a", "row_b", "n_words", "n_removed", "kept", "copies"],
            )

    return rows


CUT_SCHEMA = "doc_id long, row_a long, row_b int, n_words long, n_removed long, kept string, copies long"


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words, joined by one space), one row for every input row.

    A word goes if a window of ``window`` words that covers it also starts anywhere else, in the
    same text too; all are judged on the input. Words are what blanks (space and 0x09 to 0x0D)
    separate. Null texts have no words; texts shorter than the window lose none. Repeated rows
    are repeats of each other. Only doc_id and text are read; other columns may have any names.
    """
    ship(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row_a"), F.hash(F.col("text"), F.col("doc_id")).alias("row_b"), "text")

    def met_again(rows: DataFrame, *key: str) -> DataFrame:
        """Rows whose key others have too, or that were settled in their task; place without its flag."""
        again = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        return again.filter((F.col("n") > 1) | (F.col("place") % 4 > 0)).withColumn("place", F.floor(F.col("place") / 4).cast("int"))

    anchors = keyed.select("row_a", "text").mapInArrow(_anchors(window), "key long, row_a long, place long")
    held = stage(met_again(anchors, "key").groupBy("row_a").agg(F.collect_set("place").alias("anchors")), "anchors")
    n_held = held.count()
    near = keyed
    if n_held <= BROADCAST_ROWS:  # else the join below reads every text
        near = keyed.join(F.broadcast(held.select(F.col("row_a").alias("held_a"))), F.col("row_a") == F.col("held_a"), "left_semi")
    candidates = stage(
        near.join(held, "row_a")
        .groupBy("row_a", "row_b")
        .agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("anchors").alias("anchors"), F.count(F.lit(1)).alias("copies"))
        .withColumn("row_no", F.monotonically_increasing_id()),
        "candidates",
    )
    places = (
        met_again(candidates.select("row_no", "text", "anchors", "copies").mapInArrow(_windows(window), "key long, key_b int, row_no long, place long"), "key", "key_b")
        .groupBy("row_no")
        .agg(F.collect_set("place").alias("places"))
    )
    cut = stage(
        candidates.join(places, "row_no").select("doc_id", "row_a", "row_b", "text", "copies", "places").mapInArrow(_cut(window), CUT_SCHEMA), "cut"
    )
    gone = guarded(cut.select(F.col("row_a").alias("cut_a"), F.col("row_b").alias("cut_b")), cut.count())
    whole = (
        keyed.join(gone, (F.col("row_a") == F.col("cut_a")) & (F.col("row_b") == F.col("cut_b")), "left_anti")
        .select("doc_id", "row_a", "row_b", "text", F.lit(1).cast("long").alias("copies"), F.lit(None).cast("array<int>").alias("places"))
        .mapInArrow(_cut(window), CUT_SCHEMA)
    )
    out = ["doc_id", "n_words", "n_removed", "kept"]
    return whole.select(*out).unionByName(cut.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*out))
