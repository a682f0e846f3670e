"""Hard-negative mining by a two-dimensional deal of an exact matrix product that is reduced as it is made.

Rows are packed in blocks and dealt to segments, anchors in blocks and dealt to groups; a task holds one segment
and meets the anchor blocks of one group one after another. A first pass multiplies each anchor with the rows of
its own label, a second with all others, so every score is made once. Scores never leave the task: a tile of them
is looked through for those that come before the best found so far, and a segment hands on at most the best few of
each anchor. Products are made in 32-bit floats where these hold every sum exactly, else in doubles or in longs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import settled, stage
from .integer_vectors import integer_vectors, matrix_of

#: Rows and anchors of a tile of scores (4 MB as 32-bit floats), and components multiplied at once.
ROWS, ANCHORS, DIMS = 2048, 512, 256
#: Components that a segment has at most (32 MB as 16-bit integers), anchors of a group, rows of a packed block.
SEGMENT, GROUP, PACKED = 1 << 24, 1 << 18, 1024
#: Anchor blocks that are filled together, by label, from a bucket of anchors.
BUCKET = 8
#: One segment of so many is met before the others.
SCOUTED = 16
#: Segments for each core, where there are rows enough, and most bytes that go to Python at once.
SEGMENTS_A_CORE, BATCH = 3, 4 << 20
#: Below every score, and above every score, id and row.
_LEAST, _MOST = -np.iinfo(np.int64).max, np.iinfo(np.int64).max
#: Kinds of numbers, and the square of the bound below which each holds all sums exactly.
_KINDS = ((np.float32, 1 << 48), (np.float64, 1 << 106))


def square(q: np.ndarray) -> int:
    """The largest squared length of a row."""
    return int(np.einsum("ij,ij->i", q, q, dtype=np.int64).max(initial=0))


def kind_for(a: int, b: int) -> type:
    """The fastest numbers that hold every partial sum of products of rows of such squared lengths (none is beyond the product of the lengths)."""
    return next((kind for kind, most in _KINDS if a * b < most), np.int64)


def product(a: np.ndarray, b: np.ndarray, kind: type | None = None, dims: int = DIMS, out: np.ndarray | None = None) -> np.ndarray:
    """a @ b.T, exact, in numbers of ``kind`` (those that hold it, if None), written into the bytes ``out`` if there are enough."""
    kind = kind or kind_for(square(a), square(b))
    shape = len(a), len(b)
    size = len(a) * len(b) * np.dtype(kind).itemsize
    out = np.empty(shape, kind) if out is None or len(out) < size else out[:size].view(kind).reshape(shape)
    for at in range(0, max(1, a.shape[1]), dims):
        left, right = a[:, at : at + dims].astype(kind, copy=False), b[:, at : at + dims].astype(kind, copy=False)
        if at:
            out += left @ right.T
        else:
            np.matmul(left, right.T, out=out)
    return out


def share(score: np.ndarray, part: int, whole: int, up: bool) -> np.ndarray:
    """part / whole of integers, rounded up or down, without the product of large ones."""
    rest = part * (score % whole)
    return part * (score // whole) + (-(-rest // whole) if up else rest // whole)


class Best:
    """The ``most`` best of each key: highest score first, then smallest id and row."""

    def __init__(self, keys: int, most: int) -> None:
        self.most = most
        self.score = np.full((keys, most), _LEAST)
        self.id, self.row = np.full((keys, most), _MOST), np.full((keys, most), _MOST)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        touched = np.unique(key)
        if not len(touched):
            return
        key = np.concatenate((key, np.repeat(touched, self.most)))
        score, ids, rows = (np.concatenate((new, old[touched].ravel())) for new, old in ((score, self.score), (ids, self.id), (rows, self.row)))
        order = np.lexsort((rows, ids, -score, key))
        kept = order[np.searchsorted(key[order], touched)[:, None] + np.arange(self.most)]  # every key has as many rows at least
        self.score[touched], self.id[touched], self.row[touched] = score[kept], ids[kept], rows[kept]

    def needed(self, first_id: int) -> np.ndarray:
        """The least score of each key that may still come among its best, at ids from ``first_id`` on."""
        last = self.score[:, -1]
        return last + ((last > _LEAST) & (self.id[:, -1] < first_id))

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Key and rank of what was found."""
        return np.nonzero(self.score > _LEAST)


def bound(tile: np.ndarray, most: int) -> np.ndarray:
    """Of each row a score that ``most`` columns reach at least: the ``most``-th best of the best of some columns each."""
    parts = 16 * most
    wide = tile.shape[1] // parts
    if not wide:
        return np.full(len(tile), _least(tile), tile.dtype)
    return np.partition(tile[:, : wide * parts].reshape(len(tile), parts, wide).max(axis=2), -most, axis=1)[:, -most]


def _least(tile: np.ndarray) -> float:
    return -np.inf if tile.dtype.kind == "f" else _LEAST


def _places(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(inside), inside.shape[1])  # nonzero() of two dimensions takes many times as long


def first_of(tile: np.ndarray, low: np.ndarray, most: int, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the scores from ``low`` on (that are ``inside``); of a row with many, of the ``most`` best at least. Of equal ones the first columns come first."""
    there = tile >= low[:, None]
    if inside is not None:
        there &= inside
    i, j = _places(there)
    many = np.bincount(i, minlength=len(tile)) > 16 * most
    if not many.any():
        return i, j
    kept = ~many[i]
    many = np.flatnonzero(many)
    own = np.where(there[many], tile[many], _least(tile))
    near = own >= bound(own, most)[:, None]
    near &= there[many]
    if len(tied := np.flatnonzero(np.count_nonzero(near, axis=1) > 16 * most)):
        only = np.zeros((len(tied), own.shape[1]), np.bool_)
        np.put_along_axis(only, np.argsort(-own[tied], axis=1, kind="stable")[:, :most], True, axis=1)
        near[tied] &= only
    more = _places(near)
    return np.concatenate((i[kept], many[more[0]])), np.concatenate((j[kept], more[1]))


def in_windows(tile: np.ndarray, low: np.ndarray, high: np.ndarray, most: int, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and window of the (allowed) scores from ``low`` to ``high``, which have a column for each window; of many in a window, of the ``most`` best at least."""
    least = low.min(axis=1)
    there = tile >= least[:, None]
    i, j = _places(there)
    many = np.bincount(i, minlength=len(tile)) > 16 * most
    kept = ~many[i] if allowed is None else ~many[i] & allowed[i, j]
    i, j = i[kept], j[kept]
    score = tile[i, j][:, None]
    at, window = np.nonzero((score >= low[i]) & (score <= high[i]))
    found = [(i[at], j[at], window)]
    if many.any():
        many = np.flatnonzero(many)
        own = tile[many]
        for w in range(low.shape[1]):
            inside = own <= high[many, w, None]
            if allowed is not None:
                inside &= allowed[many]
            row, column = first_of(own, low[many, w], most, inside)
            found.append((many[row], column, np.full(len(row), w)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _as(limit: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Limits as numbers of the tile's kind, whose scores all lie between the largest integers that it holds."""
    if tile.dtype == np.int64:
        return limit
    most = 1 << (24 if tile.dtype == np.float32 else 53)
    return np.clip(limit, -most, most).astype(tile.dtype)


class Segment:
    """Rows that a task holds. Those of a label with a tile of rows or more lie together, the others in a pool; each of these by id."""

    def __init__(self, pieces: list[tuple[np.ndarray, ...]], size: int) -> None:
        q, rows, ids, labels = (np.concatenate(x) for x in zip(*pieces, strict=True))
        pieces.clear()
        values, inverse, counts = np.unique(labels, return_inverse=True, return_counts=True)
        large = counts >= size
        order = np.lexsort((rows, ids, np.where(large[inverse], inverse, -1)))
        self.q, self.row, self.id, self.label = q[order], rows[order], ids[order], labels[order]
        self.square = square(self.q)
        pool = int(counts[~large].sum())
        self.by_label = np.argsort(self.label[:pool], kind="stable")
        self.sorted_labels = self.label[self.by_label]
        ends = pool + np.cumsum(counts[large])
        self.runs = dict(zip(values[large].tolist(), zip((ends - counts[large]).tolist(), ends.tolist(), strict=True), strict=True))
        cut = lambda begin, end: [slice(at, min(at + size, end)) for at in range(begin, end, size)]
        #: All tiles, with the label where all rows have the same.
        self.tiles = [(x, None) for x in cut(0, pool)] + [(x, label) for label, run in self.runs.items() for x in cut(*run)]

    def of_label(self, label: int, size: int) -> list:
        """Where the rows of a label are, ``size`` of them each: slices, or places in the pool."""
        if label in self.runs:
            begin, end = self.runs[label]
            return [slice(at, min(at + size, end)) for at in range(begin, end, size)]
        begin, end = np.searchsorted(self.sorted_labels, [label, label + 1])
        return [self.by_label[at : min(at + size, end)] for at in range(begin, end, size)]


def _longs(value) -> np.ndarray:
    return np.frombuffer(value, np.int64)


def _matrix(value: bytes, width: int) -> np.ndarray:
    """Packed components; how many bytes each has is written first."""
    return np.frombuffer(value, f"i{value[0]}", offset=8).reshape(-1, width)


def _pack(q: np.ndarray) -> bytes:
    size = 2 if not q.size or max(-int(q.min()), int(q.max())) < 1 << 15 else 4
    return bytes([size] * 8) + np.ascontiguousarray(q, f"i{size}").tobytes()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}


def _closed(records: Iterator[dict]) -> Iterator[dict | None]:
    yield from records
    yield None


def _batch(kinds: str, **columns) -> pa.RecordBatch:
    """One row of packed columns."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    named = [x.split() for x in kinds.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes() if isinstance(x := columns[n], np.ndarray) else x], types[t]) for n, t in named], names=[n for n, _ in named])


_BLOCK = "part int, no int, n int, asking int, q binary, row binary, vec_id binary, label binary, asks binary"
_ANCHORS = "bucket int, ab long, q binary, row binary, vec_id binary, label binary"
_FOUND = "ab long, key binary, score binary, id binary, other binary"
_ASKING = f"{_ANCHORS}, positive_score binary, positive_id binary, positive_row binary"
_SEEDED = "bucket int, ab long, q binary, label binary, positive_score binary, seed binary"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column | str,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    whole: int = 100,
    scale: int = 256,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    rows_in_block: int = ROWS,
    anchors_in_block: int = ANCHORS,
    dims: int = DIMS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components x become floor(scale * x); a score is the inner product with the anchor, higher first, ties by the
    smaller id. Anchors are the rows with ``is_anchor`` (of vec_id and label). An anchor's positives are its first
    ``positives`` other rows of the same label (all, if fewer); for each, the first ``negatives`` rows of
    another label whose score lies from low / whole to high / whole of the positive's are returned (all, if fewer; none, if
    that is negative and low < high). Labels are integers.

    Rows without id, label or vector, with null or non-finite components, of another width than most or with a
    component beyond ``integer_vectors.most_component`` take no part. Rows of one id, also alike ones, are rows of
    their own: each asks, and is found, for itself. An empty table, or one without anchors, gives no rows. Only
    the three named columns are read.
    """
    spark = vectors.sparkSession
    ship(spark)
    named, width = integer_vectors(vectors, vector, scale, None, F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"))
    if not width:
        return spark.createDataFrame([], _RESULT)
    named = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    asks = F.expr(is_anchor) if isinstance(is_anchor, str) else is_anchor
    named = named.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.coalesce(asks, F.lit(False)).alias("asks"), "q")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, PACKED):
                some = batch.slice(at, PACKED)
                row, ids, labels = (some.column(c).to_numpy().astype(np.int64) for c in range(3))
                asking = some.column(3).to_numpy(zero_copy_only=False).astype(np.uint8)
                yield _batch(_BLOCK, part=part, no=no, n=len(row), asking=int(asking.sum()), q=_pack(matrix_of(some.column(4), width)), row=row, vec_id=ids, label=labels, asks=asking)
                no += 1

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The asking rows of the blocks, a row each."""
        for x in _records(batches):
            at = np.flatnonzero(np.frombuffer(x["asks"], np.uint8))
            q = _matrix(x["q"], width)[at]
            yield pa.RecordBatch.from_arrays([pa.array(_longs(x[c])[at]) for c in ("row", "vec_id", "label")] + [pa.array([_pack(v) for v in q], pa.binary())], names=["row", "vec_id", "label", "q"])

    def by_label(table: pa.Table) -> pa.Table:
        """A bucket's anchors in blocks, most of them of one label or two."""
        row, ids, labels = (table[c].to_numpy() for c in ("row", "vec_id", "label"))
        order = np.lexsort((row, ids, labels))
        q = np.concatenate([_matrix(v.as_py(), width).astype(np.int32) for v in table["q"]])
        parts = np.array_split(order, -(-len(order) // anchors_in_block))
        return pa.Table.from_batches([_batch(_ANCHORS, bucket=(bucket := table["bucket"][0].as_py()), ab=(bucket << 32) + n, q=_pack(q[x]), row=row[x], vec_id=ids[x], label=labels[x]) for n, x in enumerate(parts)])

    def mined() -> DataFrame:
        blocks = stage(named.mapInArrow(packed, _BLOCK), "row-blocks", BATCH)
        counts = blocks.agg(F.sum("n").alias("n"), F.sum("asking").alias("a")).first()
        if not counts.a:
            return spark.createDataFrame([], _RESULT)
        # as many segments as keep the cores busy, with tiles enough to be worth it, and of bounded size
        cores = spark.sparkContext.defaultParallelism
        in_segment = max(1, min(max(4 * rows_in_block, -(-counts.n // (SEGMENTS_A_CORE * cores))), SEGMENT // width))
        segments, buckets = -(-counts.n // in_segment), -(-counts.a // (BUCKET * anchors_in_block))
        in_group = max(1, GROUP // (BUCKET * anchors_in_block))
        asking = blocks.filter("asking > 0").select("q", "row", "vec_id", "label", "asks").mapInArrow(of_blocks, "row long, vec_id long, label long, q binary")
        anchors = stage(asking.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")).groupBy("bucket").applyInArrow(by_label, _ANCHORS), "anchor-blocks", BATCH)
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        segment = F.pmod(F.col("part").cast("long") * 7919 + F.col("no"), F.lit(segments)).cast("int")  # a partition's blocks one after another to all segments

        def met(asked: DataFrame, first: int, end: int, in_group: int) -> DataFrame:
            """For each task the blocks of its segment, one from ``first`` to before ``end``, and then its group's anchor blocks."""
            groups = -(-buckets // in_group)
            held = blocks.filter((segment >= first) & (segment < end)).select(((segment - first) * groups).alias("at"), every(groups).alias("group"), F.lit(0).alias("kind"), "q", "row", "vec_id", "label")
            come = asked.select((F.col("bucket") / in_group).cast("int").alias("group"), every(end - first).alias("s"), F.lit(1).alias("kind"), *asked.columns[1:])
            both = held.withColumn("task", F.col("at") + F.col("group")).drop("at", "group").unionByName(come.withColumn("task", F.col("s") * groups + F.col("group")).drop("s", "group"), allowMissingColumns=True)
            return both.repartitionById((end - first) * groups, "task").sortWithinPartitions("task", "kind")

        def gathered(asked: DataFrame, found: DataFrame) -> DataFrame:
            """Each anchor block, and then what was found for it."""
            both = asked.withColumn("kind", F.lit(0)).unionByName(found.withColumn("kind", F.lit(1)), allowMissingColumns=True)
            return both.repartition(min(BUCKET * buckets, 4 * cores), "ab").sortWithinPartitions("ab", "kind")

        def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Segment, dict, np.ndarray, int]]:
            """The task's segment with each anchor block, its components, and their largest squared length."""
            task, pieces, held = None, [], None
            for x in _records(batches):
                if x["task"] != task:
                    task, pieces, held = x["task"], [], None
                if x["kind"] == 0:
                    pieces.append((_matrix(x["q"], width), *(_longs(x[c]) for c in ("row", "vec_id", "label"))))
                elif held or pieces:
                    held = held or Segment(pieces, rows_in_block)
                    q = _matrix(x["q"], width)
                    yield held, x, q, square(q)

        def emitted(ab: int, best: Best, key: np.ndarray, at: tuple) -> pa.RecordBatch:
            return _batch(_FOUND, ab=ab, key=key.astype(np.int32), score=best.score[at], id=best.id[at], other=best.row[at])

        def same_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            room = rows_in_block * anchors_in_block
            space = np.empty(10 * room, np.uint8)
            for held, x, q, length in meetings(batches):
                rows, labels = _longs(x["row"]), _longs(x["label"])
                kind, best = kind_for(length, held.square), Best(len(rows), positives)
                for y in np.unique(labels):
                    own = np.flatnonzero(labels == y)
                    a = q[own].astype(kind)
                    for where in held.of_label(int(y), max(rows_in_block, room // len(own))):
                        ids, others = held.id[where], held.row[where]
                        tile = product(a, held.q[where], kind, dims, space)
                        least = _as(best.needed(int(ids[0]))[own], tile)
                        if best.score[own, -1].min() == _LEAST:
                            least = np.maximum(least, bound(tile, positives + 1))  # one of these may be the anchor itself
                        near = np.flatnonzero(tile.max(axis=1) >= least)
                        if not len(near):
                            continue
                        some = tile if len(near) == len(own) else tile[near]
                        i, j = first_of(some, least[near], positives + 1)
                        another = others[j] != rows[own[near[i]]]
                        i, j = i[another], j[another]
                        best.add(own[near[i]], some[i, j].astype(np.int64), ids[j], others[j])
                at = best.found()
                yield emitted(x["ab"], best, at[0], at)

        def other_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            space = np.empty(10 * rows_in_block * anchors_in_block, np.uint8)
            for held, x, q, length in meetings(batches):
                labels, bottom, top = _longs(x["label"]), *limits(x)
                kind, best = kind_for(length, held.square), Best(bottom.size, negatives)
                a, waiting, due = q.astype(kind), [], 0
                for n, (where, y) in enumerate(held.tiles):
                    ids, others = held.id[where], held.row[where]
                    least = np.maximum(bottom, best.needed(int(ids[0])).reshape(bottom.shape))
                    asks = np.flatnonzero((least.min(axis=1) < _MOST) & (labels != y if y is not None else True))
                    if not len(asks):
                        continue
                    tile = product(a if len(asks) == len(a) else a[asks], held.q[where], kind, dims, space)
                    near = np.flatnonzero(tile.max(axis=1) >= _as(least[asks].min(axis=1), tile))
                    if not len(near):
                        continue
                    some, own = tile if len(near) == len(asks) else tile[near], asks[near]
                    allowed = None if y is not None else held.label[where][None, :] != labels[own, None]
                    i, j, w = in_windows(some, _as(least[own], some), _as(top[own], some), negatives, allowed)
                    waiting.append((own[i] * positives + w, some[i, j].astype(np.int64), ids[j], others[j]))
                    if n >= due or sum(len(x[0]) for x in waiting) > 64 * len(best.score):  # seldom, once most tiles add little
                        best.add(*map(np.concatenate, zip(*waiting, strict=True)))
                        waiting, due = [], n + 1 + n // 2
                if waiting:
                    best.add(*map(np.concatenate, zip(*waiting, strict=True)))
                at = best.found()
                anchor, other = at[0] // positives, best.row[at]
                order = np.lexsort((other, anchor))  # what several of an anchor's windows hold is sent once
                new = np.ones(len(order), np.bool_)
                new[1:] = (np.diff(anchor[order]) != 0) | (np.diff(other[order]) != 0)
                at = tuple(c[order[new]] for c in at)
                yield emitted(x["ab"], best, anchor[order[new]], at)

        def limits(x: dict) -> tuple[np.ndarray, np.ndarray]:
            """Least and largest score of the window below each positive: none, where there is no such positive."""
            score = _longs(x["positive_score"]).reshape(-1, positives)
            there = score > _LEAST
            bottom, top = share(score, low, whole, True), share(score, high, whole, False)
            there &= bottom <= top
            if x.get("seed"):
                bottom = np.maximum(bottom, _longs(x["seed"]).reshape(bottom.shape))
            return np.where(there, bottom, _MOST), np.where(there, top, _LEAST)

        def found_of(x: dict) -> tuple[np.ndarray, ...]:
            return np.frombuffer(x["key"], np.int32).astype(np.int64), *(_longs(x[c]) for c in ("score", "id", "other"))

        def first_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, best = None, None
            for x in _closed(_records(batches)):
                if x is None or x["kind"] == 0:
                    if block:
                        yield _batch(_ASKING, **{c: block[c] for c in ("bucket", "ab", "q", "row", "vec_id", "label")}, positive_score=best.score, positive_id=best.id, positive_row=best.row)
                    block, best = x, x and Best(len(_longs(x["row"])), positives)
                else:
                    best.add(*found_of(x))

        def gathered_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Best]]:
            """Each anchor block, and the best in its windows."""
            block, best, window = None, None, None
            for x in _closed(_records(batches)):
                if x is None or x["kind"] == 0:
                    if block:
                        yield block, best
                    block = x
                    if x:
                        window = limits(x)
                        best = Best(window[0].size, negatives)
                else:
                    anchor, *rest = found_of(x)
                    for w in range(positives):
                        inside = (window[0][anchor, w] <= rest[0]) & (rest[0] <= window[1][anchor, w])
                        best.add(anchor[inside] * positives + w, *(c[inside] for c in rest))

        def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The anchor blocks with the last of the best scores in each window, below which nothing needs to be looked for."""
            for block, best in gathered_negatives(batches):
                yield _batch(_SEEDED, **{n: block[n] for n in ("bucket", "ab", "q", "label", "positive_score")}, seed=np.ascontiguousarray(best.score[:, -1]))

        def first_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, best in gathered_negatives(batches):
                key, rank = best.found()
                of = [_longs(block["vec_id"])[key // positives], _longs(block["positive_id"])[key], (rank + 1).astype(np.int32), best.id[key, rank], _longs(block["positive_score"])[key], best.score[key, rank]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in of], names=[c.split()[0] for c in _RESULT.split(", ")])

        met_own = stage(met(anchors.drop("vec_id"), 0, segments, in_group).mapInArrow(same_label, _FOUND), "same-label", BATCH)
        asked = stage(gathered(anchors, met_own).mapInArrow(first_positives, _ASKING), "positives", BATCH)
        sought, found = asked.select("bucket", "ab", "q", "label", "positive_score"), None
        # a few segments come first: what they hold spares the others most of their finds
        if scouts := segments // SCOUTED:
            some = max(1, min(in_group, buckets * scouts // (SEGMENTS_A_CORE * cores)))
            found = stage(met(sought, 0, scouts, some).mapInArrow(other_labels, _FOUND), "scouted", BATCH)
            sought = stage(gathered(sought, found).mapInArrow(seeded, _SEEDED), "seeds", BATCH)
        rest = stage(met(sought, scouts, segments, in_group).mapInArrow(other_labels, _FOUND), "other-labels", BATCH)
        return gathered(asked.drop("bucket", "q", "row", "label", "positive_row"), found.unionByName(rest) if found else rest).mapInArrow(first_negatives, _RESULT)

    return settled(mined, "negatives", BATCH)


def oracle(positives: int = 5, negatives: int = 5) -> str:
    """DuckDB SQL for the registered query: all scores of all anchors."""
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT row, unnest(range(1, len(q) + 1)) AS place, unnest(q) AS x FROM kept),
scores AS (
  SELECT a.row AS anchor, b.row, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM parts a JOIN kept k ON k.row = a.row AND k.vec_id % 100 = 0 JOIN parts b ON a.place = b.place GROUP BY a.row, b.row),
named AS (
  SELECT s.anchor, a.vec_id AS anchor_id, a.label AS anchor_label, s.row, k.vec_id, k.label, s.score FROM scores s JOIN kept a ON a.row = s.anchor JOIN kept k ON k.row = s.row),
best AS (
  SELECT anchor, row, vec_id AS positive_id, score AS positive_score FROM named WHERE label = anchor_label AND row <> anchor
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= {positives}),
ranked AS (
  SELECT n.anchor_id, b.positive_id, n.vec_id AS negative_id, b.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY b.anchor, b.row ORDER BY n.score DESC, n.vec_id, n.row) AS rank
  FROM best b JOIN named n ON n.anchor = b.anchor AND n.label <> n.anchor_label AND 80 * b.positive_score <= 100 * n.score AND n.score <= b.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {negatives}
"""
