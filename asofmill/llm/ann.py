"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is halved again and again at medians, so that its parts are equal; their means
are the centroids. Every vector goes to its nearest centroid's list and, near a boundary, to the
lists of others that are hardly farther. Centroids are searched along a graph held in memory: a
best-first walk over each centroid's nearest ones. A query opens the lists whose centroid is not
much farther than its nearest one, scores all vectors there by exact cosine, and keeps the best.

How much farther is measured, not assumed: the nearest neighbours of a bounded sample of queries are found among all
rows, and the ratio is the one at which the wanted share of them lies in an opened list. So recall does not
depend on how many vectors there are, or how they lie; the work does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import guarded, sample_of, stage

#: The bounded sample, vectors wanted in a list, centroids at most, and vectors of a list (and queries) that one group scores.
SAMPLE, LIST_SIZE, MOST_LISTS, PART = 20_000, 128, 4_096, 4_096
#: A vector is copied to at most COPIES lists whose centroid is at most COPY_RATIO times as far as the nearest one: only those near a boundary are.
COPIES, COPY_RATIO = 2, 1.01
#: Share of the nearest neighbours that are to be found, queries by which the ratio for it is measured, and lists that a query opens at least.
RECALL, MEASURED, LEAST_PROBES = 0.96, 256, 2
#: Neighbours from which on a quantile is trusted; with fewer, all of them have to be found.
TRUSTED = 200
#: The walk over centroids expands those up to SLACK (or the ratio asked for) times as far as the nearest met, WALK at most, with DEGREE neighbours each.
SLACK, WALK, DEGREE = 1.12, 256, 16


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither overflow nor vanish; their cosines are the same to the last bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Centroids:
    """Balanced centroids of a sample, and the graph in which they are searched."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 3):
        sample = np.unique(sample, axis=0)
        self.points = self._halve(sample, max(1, lists), np.random.default_rng(seed))
        k = len(self.points)
        near = self.points @ self.points.T
        np.fill_diagonal(near, -2)
        degree = min(DEGREE, max(0, k - 1))
        self.links = np.argsort(-near, axis=1, kind="stable")[:, :degree]
        # a ring makes every centroid reachable
        self.links = np.concatenate((self.links, (np.arange(k)[:, None] + 1) % k), axis=1)
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 8)).astype(int))

    @staticmethod
    def _halve(points: np.ndarray, lists: int, random: np.random.Generator) -> np.ndarray:
        todo, out = [(points, lists)], []
        while todo:
            own, parts = todo.pop()
            if parts < 2 or len(own) < 2:
                mean = own.mean(axis=0)
                out.append(mean if np.abs(mean).max() > 1e-9 else own[0])
                continue
            a, b = own[random.choice(len(own), 2, replace=False)]
            for _ in range(4):  # two means of equal size
                side = own @ (a - b)
                order = np.argsort(side, kind="stable")
                cut = len(own) * (parts // 2) // parts
                low, high = own[order[:cut]], own[order[cut:]]
                b, a = low.mean(axis=0), high.mean(axis=0)
            todo += [(high, parts - parts // 2), (low, parts // 2)]
        return unit(np.array(out))

    def walk(self, queries: np.ndarray, ratio: float, least: int, expand: int) -> np.ndarray:
        """Cosines (queries, centroids) of the centroids met by a best-first walk; -2 where the walk did not come.

        It goes on from the nearest centroid not yet expanded while that is at most ``ratio`` times
        as far as the nearest one met (and for ``least`` steps).
        """
        k, q = len(self.points), len(queries)
        seen = np.full((q, k), -2.0)
        seen[:, self.entries] = queries @ self.points[self.entries].T
        open_ = np.where(seen > -2, seen, -3.0)
        for step in range(min(expand, k)):
            best = open_.argmax(axis=1)
            reached = open_[np.arange(q), best]
            nearest = seen.max(axis=1)
            on = np.flatnonzero((reached > -3) & ((step < least) | (1 - reached <= ratio * ratio * (1 - nearest) + 1e-12)))
            if not len(on):
                break
            open_[on, best[on]] = -3
            next_ = self.links[best[on]]
            new = seen[on[:, None], next_] == -2
            at, which = np.nonzero(new)
            cosine = (queries[on[at]] * self.points[next_[at, which]]).sum(axis=1)
            seen[on[at], next_[at, which]] = cosine
            open_[on[at], next_[at, which]] = cosine
        return seen

    def lists(self, vectors: np.ndarray, ratio: float, least: int, most: int, expand: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the vector and list: the nearest lists met, up to ``ratio`` times the least distance, at least and at most so many."""
        out = []
        for at in range(0, len(vectors), 1024):
            cosine = self.walk(vectors[at : at + 1024], max(SLACK, ratio), 4, expand)
            order = np.argsort(-cosine, axis=1, kind="stable")[:, :most]
            ranked = np.take_along_axis(cosine, order, axis=1)
            far = np.sqrt(np.maximum(0, 2 - 2 * ranked))
            keep = (ranked > -2) & ((far <= ratio * far[:, :1] + 1e-12) | (np.arange(order.shape[1]) < least))
            row, column = np.nonzero(keep)
            out.append((row + at, order[row, column]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, by sums along the row only: equal vectors get equal scores."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def best_of(
    queries: np.ndarray, query_rows: np.ndarray, query_lists: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int
) -> list[tuple[int, int, int, float]]:
    """The k best other vectors of each query in the lists it opened: (query's row, vector's row, its id, cosine), ties to the smaller id.

    A query comes once for each list it opened, a vector once for each list it is in.
    """
    out, names = [], unit(vectors)
    asking, first, of = np.unique(query_rows, return_index=True, return_inverse=True)
    at_list = np.argsort(lists, kind="stable")
    known, starts = np.unique(lists[at_list], return_index=True)
    held = dict(zip(known.tolist(), np.split(at_list, starts[1:]), strict=True))
    order = np.argsort(of, kind="stable")
    edge = np.searchsorted(of[order], np.arange(0, len(asking) + 256, 256))
    for block, (low, high) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
        own = slice(256 * block, 256 * block + 256)
        asked = order[low:high]
        close = np.full((len(asking[own]), len(vectors)), -3.0)
        units = unit(queries[first[own]])
        for name in np.unique(query_lists[asked]).tolist():
            if name in held:
                some = of[asked[query_lists[asked] == name]] - 256 * block
                close[np.ix_(some, held[name])] = units[some] @ names[held[name]].T
        close[asking[own, None] == rows[None, :]] = -3
        spot = max(0, close.shape[1] - COPIES * k)
        kth = np.partition(close, spot, axis=1)[:, spot]
        for i, row in enumerate(close):
            found = np.flatnonzero((row >= kth[i] - 1e-9) & (row > -3))
            found = found[np.unique(rows[found], return_index=True)[1]]  # a copy counts once
            exact = cosines(np.broadcast_to(queries[first[own][i]], (len(found), queries.shape[1])), vectors[found])
            best = np.lexsort((rows[found], ids[found], -exact))[:k]
            out += [(int(asking[own][i]), int(rows[found[j]]), int(ids[found[j]]), float(exact[j])) for j in best]
    return out


def usable(vectors: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int]:
    """vec_id, v (doubles) of the vectors that take part, and their width: the most frequent one, the larger of two equally so."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(finite)
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return rows.filter(F.size("v") == (width.w if width else 0)), width.w if width else 0


def nearest_of_sample(rows: DataFrame, queries: np.ndarray, query_rows: np.ndarray, k: int, width: int) -> DataFrame:
    """query (number), row: the k nearest other rows of each query among all ``rows`` (row, v). Tasks hand on k rows for each query and batch."""
    shared = rows.sparkSession.sparkContext.broadcast((unit(queries), query_rows))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, own = shared.value
        for batch in batches:
            names, close = batch.column(0).to_numpy(), asked @ unit(_matrix(batch.column(1), width)).T
            close[own[:, None] == names[None, :]] = -3
            top = np.argpartition(-close, min(k, close.shape[1]) - 1, axis=1)[:, :k]
            score = np.take_along_axis(close, top, axis=1)
            query, column = np.nonzero(score > -3)
            yield pa.RecordBatch.from_arrays([pa.array(query.astype(np.int32)), pa.array(names[top[query, column]]), pa.array(score[query, column])], names=["query", "row", "score"])

    found = rows.select("row", "v").mapInArrow(best, "query int, row long, score double")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "row"))).filter(F.col("rank") <= k).select("query", "row")


def measured_ratio(rows: DataFrame, asked: DataFrame, held: DataFrame, centroids: Centroids, k: int, recall: float, width: int) -> float:
    """How many times as far as the nearest centroid a list's may lie so that ``recall`` of the sampled queries' nearest rows are in an opened list.

    The driver gets ``MEASURED`` queries, and of each k rows with the lists that hold them.
    """
    n = asked.count()
    sample = sample_of(asked, n, MEASURED, "row").select("row", "v").toPandas()
    if not len(sample):
        return 1.0
    queries = np.array(sample["v"].tolist(), np.float64)
    true = stage(nearest_of_sample(rows, queries, sample["row"].to_numpy(), k, width), "measured")
    lists = held.join(F.broadcast(true), "row").select("query", "row", "list").toPandas()  # at most COPIES of each
    if not len(lists):
        return 1.0
    far = np.sqrt(np.maximum(0, 2 - 2 * unit(queries) @ centroids.points.T))
    own = far[lists["query"], lists["list"]] / np.maximum(far.min(axis=1)[lists["query"]], 1e-12)
    needed = lists.assign(needed=own).groupby(["query", "row"])["needed"].min().to_numpy()
    return float(np.quantile(needed, recall, method="higher") if len(needed) >= TRUSTED else needed.max()) + 1e-9


def nearest(
    vectors: DataFrame,
    is_query: Column | str,
    k: int = 5,
    id_column: str = "vec_id",
    vector: str = "embedding",
    list_size: int = LIST_SIZE,
    copy_ratio: float = COPY_RATIO,
    probe_ratio: float | None = None,
    walk: int = WALK,
    part: int = PART,
    recall: float = RECALL,
    exact: bool = False,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest other vectors found for every row of ``vectors`` with ``is_query`` (of vec_id).

    score is the cosine of the original vectors in double precision; ties go to the smaller id. About ``recall`` of the nearest are
    found: lists are opened up to a ratio measured for it by ``MEASURED`` of the queries, or up to ``probe_ratio`` if that is given. With ``exact`` every
    list is opened, and all are found.
    A query gets k rows, or all candidates if there are fewer. Vectors that are null, zero, of
    another width than most, or hold null or non-finite components take no part, nor do rows
    without id; an empty table gives no rows. Every row is a candidate of its own: rows of one id are
    candidates of each other, and each that asks gets its own k rows. Only the two named columns are read.
    """
    ship(vectors.sparkSession)
    rows, width = usable(vectors, id_column, vector)
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    if not width:
        return spark.createDataFrame([], schema)
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "vectors")
    n = rows.count()
    sample = sample_of(rows, n, SAMPLE, "row").select("v").toPandas()["v"]
    shared = spark.sparkContext.broadcast(Centroids(unit(np.array(sample.tolist(), np.float64)), min(-(-n // list_size), MOST_LISTS)))

    def route(ratio: float, least: int, most: int, expand: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = _matrix(batch.column(2), width)
                at, lists = shared.value.lists(unit(own), ratio, least, most, expand)
                for start in range(0, len(at), 8192):
                    some = pa.array(at[start : start + 8192])
                    yield pa.RecordBatch.from_arrays([pa.array(lists[start : start + 8192].astype(np.int32)), *[c.take(some) for c in batch.columns]], names=["list", *batch.schema.names])

        return run

    spec = "list int, row long, vec_id long, v array<double>"
    posted = stage(rows.mapInArrow(route(copy_ratio, 1, COPIES, walk), spec), "postings")
    asked = rows.filter(is_query)
    # lists share bundles of about ``part`` vectors, so a query brings k rows for each bundle, not for each list
    bundle = F.pmod(F.col("list"), F.lit(max(1, -(-posted.count() // part)))).alias("bundle")
    posted, sizes = posted.select(bundle, "*"), posted.groupBy(bundle).agg(F.ceil(F.count(F.lit(1)) / (2 * part)).cast("int").alias("parts"))

    def score(routes: DataFrame) -> DataFrame:
        """The k best of each bundle for the queries routed to its lists: parts of the bundle against blocks of the queries."""
        routes = routes.select(bundle, "*")
        asking = routes.groupBy("bundle").agg(F.ceil(F.count_distinct("row") / part).cast("int").alias("blocks"))
        cut = guarded(stage(sizes.join(asking, "bundle"), "cuts"), MOST_LISTS, MOST_LISTS)  # one row for each bundle: no more than lists
        block, own_part = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        held = posted.join(cut, "bundle").select("bundle", own_part.alias("part"), every("blocks").alias("block"), "list", "row", "vec_id", "v")
        wanted = routes.join(cut, "bundle").select("bundle", every("parts").alias("part"), block.alias("block"), "list", F.col("row").alias("query"), "v")

        def pairs(own: pa.Table, queries: pa.Table) -> pa.Table:
            found = []
            if own.num_rows and queries.num_rows:
                asked = (_matrix(queries["v"], width), queries["query"].to_numpy(), queries["list"].to_numpy())
                found = best_of(*asked, _matrix(own["v"], width), own["row"].to_numpy(), own["vec_id"].to_numpy(), own["list"].to_numpy(), k)
            return pa.table(list(zip(*found, strict=True)) or [[]] * 4, schema=pa.schema([("query", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

        key = ["bundle", "part", "block"]
        return held.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInArrow(pairs, "query long, row long, vec_id long, score double")

    lists = len(shared.value.points)
    if exact:
        probes = asked.select(F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list"), "row", "vec_id", "v")
    else:
        ratio = probe_ratio if probe_ratio is not None else measured_ratio(rows, asked, posted.select("list", "row"), shared.value, k, recall, width)
        probes = asked.select("row", "vec_id", "v").mapInArrow(route(ratio, LEAST_PROBES, lists, lists), spec)
    probes = stage(probes, "probes")
    found = stage(score(probes), "found")
    enough = min(k, n - 1)
    full = found.groupBy(F.col("query").alias("row")).agg(F.count_distinct("row").alias("n")).filter(F.col("n") >= enough)
    short = stage(asked.join(full, "row", "left_anti"), "short") if enough else None
    if short is not None and short.count():  # the lists opened held too few: open all
        found = found.union(score(short.select(F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list"), "row", "vec_id", "v")))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.groupBy("query", "row", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(named, "query").select("query_id", "rank", "vec_id", "score")
