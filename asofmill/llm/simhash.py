"""SimHash near-duplicates, linked by vantage-point trees.

Fingerprints are 64 bits; two are linked if at most ``max_bits`` bits differ. Over the whole 64
bits distances of unrelated texts crowd around 32, so a tree prunes little there. The bits are
therefore cut into slices: a pair within ``max_bits`` differs by at most max_bits // slices bits
in one slice at least, and that slice's tree is searched with that small radius. In each tree a
node holds a vantage point and a radius; a fingerprint lives in one leaf (its shard). Its ball
goes down whole where the triangle bound puts it on one side, and point by point across a
boundary, so it visits the other shards that hold a point of it, and no more. Inside a shard
all 64 bits are compared, so the pairs are exact.

Trees come from a bounded sample. A leaf with more residents than wanted is cut into parts by its
points (the slice's bits), whatever the sample was; a part that is still crowded is compared in
blocks of residents against blocks of visitors.

With several words of 64 bits and a wide ``max_bits`` no slice is sure to be nearly equal. Then a
``Forest`` of trees over random bits is searched without visits: a pair is found if it shares a
shard in one of them. Two fingerprints equal in a tree's bits always do, however many rows there
are, so the share of pairs found has a lower bound that does not depend on the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import byte_class, discard, guarded, joined_bytes, mix64, quoted, sample_of, settled, span_hashes, split_text_batches, stage, window_hashes, word_spans
from .components import components

SEED = 42
#: Fingerprints from which the trees are built (the bounded sample), residents wanted in a shard, leaves of a tree at most.
SAMPLE, LEAF, MOST_LEAVES = 32_768, 512, 4_096
#: Residents, and a quarter of the visitors, that one task compares at once.
CROWD = 4_096
#: Bytes of text whose shingle sets a worker makes at once, and of rows that it gets at once. Workers keep what they once took.
SLICE, BATCH = 1 << 18, 1 << 22


class Forest(NamedTuple):
    """``trees`` over ``bits`` random bits for each word of the fingerprints."""

    trees: int
    bits: int

    def spots(self, size: int, seed: int = 5) -> list[tuple[int, int]]:
        random = np.random.default_rng(seed)
        return [(word, sum(1 << int(b) for b in random.choice(64, self.bits, replace=False))) for word in range(size) for _ in range(self.trees)]


def _spread(hashes: np.ndarray, words: int) -> np.ndarray:
    """(hashes, words): the hashes themselves, and further scramblings of them."""
    return np.stack([hashes, *[mix64(hashes + np.uint64(w * 0x9E3779B97F4A7C15 % (1 << 64))) for w in range(1, words)]], axis=1)


def fingerprint(text: str | None, shingle: int, size: int = 1, repeats: bool = True) -> np.ndarray:
    """``size`` times 64 majority bits over the XXH64 of the word shingles, as 64-bit words; 0 without words.

    A shingle that occurs again counts again, unless ``repeats`` is off.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(size, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return _spread(np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64), size)[0]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spots = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spots), np.uint64)
    hashes = hashes if repeats else np.unique(hashes)
    ones = np.zeros(64 * size, np.int64)
    for at in range(0, len(hashes), 16_384):
        bits = np.unpackbits(_spread(hashes[at : at + 16_384], size).view(np.uint8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def _column(prints: np.ndarray) -> pa.Array:
    """Fingerprints (rows, words) as signed longs, or as bytes if they have several words."""
    if prints.shape[1] == 1:
        return pa.array(prints[:, 0].view(np.int64))
    width = 8 * prints.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(prints), [None, pa.py_buffer(np.ascontiguousarray(prints))]).cast(pa.binary())


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    if size == 1:
        return column.to_numpy(zero_copy_only=False).view(np.uint64)[:, None]
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, size)


def _kind(size: int) -> str:
    return "long" if size == 1 else "binary"


def fingerprints(docs: DataFrame, shingle: int = 4, size: int = 1, repeats: bool = True) -> DataFrame:
    """doc_id, row_a, row_b (two hashes of id and text, which name the row) and fp (the fingerprint: a signed long, or the bytes of several words)."""
    ship(docs.sparkSession)
    keyed = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row_a"), F.hash(F.col("text"), F.col("doc_id")).alias("row_b"), "text"
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_text_batches(batches, "text"):
            made = np.array([fingerprint(t, shingle, size, repeats) for t in batch.column(3).to_pylist()], np.uint64).reshape(-1, size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _column(made)], names=["doc_id", "row_a", "row_b", "fp"])

    return keyed.mapInArrow(rows, f"doc_id long, row_a long, row_b int, fp {_kind(size)}")


class VantageTree:
    """A vantage-point tree over the bits of ``mask``: which leaf a fingerprint lives in, and which its ball reaches."""

    def __init__(self, sample: np.ndarray, mask: int, leaves: int, seed: int):
        self.mask, self.leaves, nodes = np.uint64(mask), 0, []
        depth = max(0, int(np.ceil(np.log2(max(1, leaves)))))
        self.root = self._build(sample, depth, np.random.default_rng(seed), nodes)
        self.vantage = np.array([n[0] for n in nodes], np.uint64)
        self.radius, self.inside, self.outside = (np.array([n[i] for n in nodes], np.int64) for i in (1, 2, 3))

    def _build(self, members: np.ndarray, depth: int, random: np.random.Generator, nodes: list) -> int:
        """The new node's number; leaves count down from -1."""
        if depth and len(members) >= 8:
            for vantage in random.choice(members, min(4, len(members)), replace=False):
                far = np.bitwise_count((members ^ vantage) & self.mask)
                radius = int(np.median(far))
                inner = far <= radius
                if inner.all():
                    radius, inner = radius - 1, far <= radius - 1
                if inner.any():
                    at = len(nodes)
                    nodes.append(None)
                    nodes[at] = (vantage, radius, self._build(members[inner], depth - 1, random, nodes), self._build(members[~inner], depth - 1, random, nodes))
                    return at
        self.leaves += 1
        return -self.leaves

    def ball(self, reach: int) -> np.ndarray:
        """What to flip in a value for each point within ``reach`` of it; the value itself comes first."""
        bits = [1 << b for b in range(64) if int(self.mask) >> b & 1]
        return np.array([sum(some) for r in range(reach + 1) for some in combinations(bits, r)], np.uint64)

    def homes(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        leaf, todo = np.empty(len(points), np.int64), [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                leaf[at] = -node - 1
            elif len(at):
                near = np.bitwise_count((points[at] ^ self.vantage[node]) & self.mask) <= self.radius[node]
                todo += [(int(self.inside[node]), at[near]), (int(self.outside[node]), at[~near])]
        return leaf

    def shards(self, values: np.ndarray, reach: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Index of the value, leaf, part of the leaf, and whether it lives there: one row for each shard that holds a point of its ball.

        ``parts``: in how many parts each leaf is cut.
        """
        flips = self.ball(reach)
        whole, points, leaf = [(self.root, np.arange(len(values)))], [], []
        while whole:
            node, at = whole.pop()
            if not len(at):
                continue
            if node < 0 and parts[-node - 1] == 1:
                points.append((at, np.zeros(len(at), np.int64), np.full(len(at), -node - 1)))
                continue
            if node >= 0:
                far = np.bitwise_count((values[at] ^ self.vantage[node]) & self.mask).astype(np.int64)
                in_, out = far + reach <= self.radius[node], far - reach > self.radius[node]
                whole += [(int(self.inside[node]), at[in_]), (int(self.outside[node]), at[out])]
                at = at[~in_ & ~out]
            if len(at):  # across a boundary, or in a leaf of several parts: point by point
                leaf.append(np.repeat(at, len(flips)) * len(flips) + np.tile(np.arange(len(flips)), len(at)))
        if leaf:
            spot = np.concatenate(leaf)
            at, nth = spot // len(flips), spot % len(flips)
            points.append((at, nth, self.homes(values[at] ^ flips[nth])))
        if not points:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
        at, nth, of = (np.concatenate(x) for x in zip(*points, strict=True))
        part = (mix64((values[at] ^ flips[nth]) & self.mask) % parts[of].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((nth, part, of, at))  # of a value's points in one shard the first stays: the value itself, if it lives there
        at, nth, of, part = at[order], nth[order], of[order], part[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (of[1:] != of[:-1]) | (part[1:] != part[:-1])
        # a ball that went to its leaf whole came with its value
        return at[new], of[new], part[new], nth[new] == 0


def slice_masks(slices: int) -> list[int]:
    edge = [64 * k // slices for k in range(slices + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edge, edge[1:], strict=False)]


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints (..., words) that broadcast against each other."""
    out = np.bitwise_count(a[..., 0] ^ b[..., 0])
    if a.shape[-1] > 1:
        out = out.astype(np.uint16)
        for w in range(1, a.shape[-1]):
            out += np.bitwise_count(a[..., w] ^ b[..., w])
    return out


def spanning_links(home: np.ndarray, others: np.ndarray, max_bits: int) -> np.ndarray:
    """Links that join all that residents are linked to, without listing every pair: a breadth-first search. (links, 2, words)"""
    every = np.concatenate((home, others))
    linked, rows = [], max(1, (1 << 21) // max(1, len(every)))
    for at in range(0, len(home), rows):
        close = _far(home[at : at + rows, None], every[None, :]) <= max_bits
        linked.append(np.count_nonzero(close, axis=1) > 1)  # each is close to itself
    open_ = np.ones(len(every), bool)
    links = []
    for first in np.flatnonzero(np.concatenate(linked)) if linked else []:
        if not open_[first]:
            continue
        open_[first] = False
        queue = [int(first)]
        while queue:
            node = queue.pop()
            rest = np.flatnonzero(open_)
            found = rest[_far(every[rest], every[node]) <= max_bits]
            open_[found] = False
            links += [(node, int(x)) for x in found]
            queue += found.tolist()
    return every[np.array(links, np.int64).reshape(-1, 2)]


def closest_links(home: np.ndarray, others: np.ndarray, max_bits: int) -> np.ndarray:
    """Links within ``max_bits`` like ``spanning_links``, by the fewest differing bits first: a minimum spanning forest. (links, 2, words)"""
    every = np.concatenate((home, others))
    linked, rows = np.zeros(len(every), bool), max(1, (1 << 21) // max(1, len(every)))
    for at in range(0, len(home), rows):
        close = _far(home[at : at + rows, None], every[None, :]) <= max_bits
        linked[at : at + rows] |= np.count_nonzero(close, axis=1) > 1
        linked |= close[linked[at : at + len(close)]].any(axis=0)
    every = every[linked]
    best, parent = np.full(len(every), max_bits + 1, np.int64), np.zeros(len(every), np.int64)
    open_, links = np.ones(len(every), bool), []
    for _ in range(len(every)):
        node = int(np.where(open_, best, max_bits + 2).argmin())
        if best[node] <= max_bits:
            links.append((node, int(parent[node])))
        open_[node] = False
        far = _far(every, every[node]).astype(np.int64)
        nearer = open_ & (far < best)
        best[nearer], parent[nearer] = far[nearer], node
    return every[np.array(links, np.int64).reshape(-1, 2)]


def near_links(
    distinct: DataFrame, max_bits: int, slices: int = 3, size: int = 1, forest: Forest | None = None, leaf: int = LEAF, sample: int = SAMPLE, crowd: int = CROWD
) -> DataFrame:
    """u, v: links among the distinct fingerprints (column fp) that span what is found; each is a true pair.

    Without a ``forest`` all pairs within ``max_bits`` are found; the radius of a slice's tree then
    follows from the number of slices: its points are visited one by one, so few slices (a radius of 3
    or more) make many of them. With one, links are the closest that span what is found.
    """
    spark = distinct.sparkSession
    ship(spark)
    rows = distinct.count()
    leaves = min(MOST_LEAVES, -(-rows // leaf))
    taken = [r.fp for r in sample_of(distinct.select("fp"), rows, min(sample, 8 * leaves), "fp").collect()]
    values = np.array(taken, np.int64).view(np.uint64)[:, None] if size == 1 else np.frombuffer(b"".join(taken), np.uint64).reshape(-1, size)
    spots = forest.spots(size) if forest else [(word, mask) for word in range(size) for mask in slice_masks(slices)]
    trees = [VantageTree(values[:, word], mask, leaves, seed) for seed, (word, mask) in enumerate(spots)]
    radius = 0 if forest else max_bits // len(spots)
    grown = spark.sparkContext.broadcast(trees)
    first = np.concatenate(([0], np.cumsum([t.leaves for t in trees])))

    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(first[-1], np.int64)
        for batch in batches:
            own = _matrix(batch.column(0), size)
            for i, ((word, _), tree) in enumerate(zip(spots, grown.value, strict=True)):
                count[first[i] : first[i + 1]] += np.bincount(tree.homes(np.ascontiguousarray(own[:, word])), minlength=tree.leaves)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["leaf", "n"])

    # one row for each leaf: at most MOST_LEAVES for each tree
    lived = distinct.select("fp").mapInArrow(live, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect()
    parts = np.ones(first[-1], np.int64)
    for r in lived:
        parts[r.leaf] = -(-r.n // leaf) if r.n > 4 * leaf else 1
    shared = spark.sparkContext.broadcast((trees, parts))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, parts = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                column = batch.column(0).slice(start, 4096)
                own = _matrix(column, size)
                for i, ((word, _), tree) in enumerate(zip(spots, trees, strict=True)):
                    at, of, part, home = tree.shards(np.ascontiguousarray(own[:, word]), radius, parts[first[i] : first[i + 1]])
                    yield pa.RecordBatch.from_arrays([pa.array((of + first[i]) << 32 | part), column.take(pa.array(at)), pa.array(home)], names=["shard", "fp", "home"])

    kind = _kind(size)
    routed = stage(distinct.select("fp").mapInArrow(route, f"shard long, fp {kind}, home boolean"), "shards")
    crowds = routed.groupBy("shard").agg(F.count_if("home").alias("n"), F.count(F.lit(1)).alias("all")).filter((F.col("n") > crowd) | (F.col("all") > 8 * crowd))
    crowds = stage(crowds.select("shard", F.ceil(F.col("n") / crowd).cast("int").alias("ps"), F.ceil(F.col("all") / (4 * crowd)).cast("int").alias("qs")), "crowds")
    dealt = routed.join(guarded(crowds, crowds.count()), "shard", "left")
    # blocks of a crowded shard: residents p against all rows q; a resident is among both
    spread = lambda n, salt: F.pmod(F.xxhash64("fp", F.lit(salt)), F.col(n)).cast("int")
    block = lambda p, q, home: F.struct(p.alias("p"), q.alias("q"), home.alias("home"))
    resident = F.transform(F.sequence(F.lit(0), F.col("qs") - 1), lambda q: block(spread("ps", 1), q, F.lit(True)))
    visitor = F.transform(F.sequence(F.lit(0), F.col("ps") - 1), lambda p: block(p, spread("qs", 2), F.lit(False)))
    blocks = F.when(F.col("ps").isNull(), F.array(block(F.lit(0), F.lit(0), F.col("home")))).when(F.col("home"), F.concat(resident, visitor)).otherwise(visitor)
    dealt = dealt.select("shard", "fp", F.explode(blocks).alias("b")).select("shard", "b.p", "b.q", "fp", "b.home")

    def pairs(group: pa.Table) -> pa.Table:
        own = _matrix(group.column("fp"), size)
        home = group.column("home").to_numpy()
        links = (closest_links if forest else spanning_links)(own[home], own[~home], max_bits)
        return pa.table([_column(links[:, 0]), _column(links[:, 1])], names=["u", "v"])

    return dealt.groupBy("shard", "p", "q").applyInArrow(pairs, f"u {kind}, v {kind}").filter("u != v")


_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_WORD_BYTE = ~byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")


def shingle_sets(column: pa.Array, shingle: int) -> list[bytes]:
    """The different word shingles of each text, as sorted 64-bit hashes; fewer words are one shingle, none are none."""
    data, begins = joined_bytes(column)
    starts, ends, first = word_spans(_LOW[data], begins, _WORD_BYTE)
    words = span_hashes(_LOW[data], starts, ends)
    counts = np.diff(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    at = np.flatnonzero(place + shingle <= np.repeat(counts, counts))
    hashes = window_hashes(words, at, shingle, 0xA0761D6478BD642F) if len(at) else np.zeros(0, np.uint64)
    edge = np.searchsorted(at, first)
    out = []
    for i, n in enumerate(counts.tolist()):
        own = hashes[edge[i] : edge[i + 1]] if n >= shingle else window_hashes(words, first[i : i + 1], n, 0xE7037ED1A0B428DB) if n else hashes[:0]
        out.append(np.unique(own).tobytes())
    return out


def _with_sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches (their last column is the text), each with the shingle sets of its texts."""
    for batch in split_text_batches(batches, "text", SLICE):
        yield batch, shingle_sets(batch.column(batch.num_columns - 1), shingle)


def jaccard(a: bytes, b: bytes) -> float:
    """Common share of two sorted sets; 1 of two empty ones."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    both = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
    return both / (len(x) + len(y) - both)


def _alike(docs: DataFrame, prints: DataFrame, candidates: DataFrame, shingle: int, similarity: float, size: int) -> DataFrame:
    """u, v: those of the candidate links, and of links to the least of a group of candidates, whose texts share so much of their shingles.

    First each group's members are held against its least one; then every candidate link between
    members that this did not join. So a group of close copies costs one comparison for each
    member, and no candidate link is dropped without having been compared.
    """
    candidates = stage(candidates.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "candidates")
    groups = stage(components(candidates), "candidate-groups")
    rows = prints.join(groups.select(F.col("node").alias("fp")), "fp", "left_semi").groupBy("fp").agg(F.min(F.struct("row_a", "row_b")).alias("row"))
    wanted = stage(rows.select("fp", F.col("row.row_a").alias("want_a"), F.col("row.row_b").alias("want_b")), "wanted")
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row_a"), F.hash(F.col("text"), F.col("doc_id")).alias("row_b"), F.col("text").cast("string").alias("text"))
    on = (F.col("row_a") == F.col("want_a")) & (F.col("row_b") == F.col("want_b"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, made in _with_sets(batches, shingle):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["fp", "shingles"])

    kind = _kind(size)
    texts = keyed.join(guarded(wanted, wanted.count()), on).select("fp", "text").mapInArrow(sets, f"fp {kind}, shingles binary")
    texts = stage(texts.groupBy("fp").agg(F.first("shingles").alias("shingles")), "shingles", BATCH)

    def verified(links: DataFrame) -> DataFrame:
        held = links.join(texts.select(F.col("fp").alias("u"), F.col("shingles").alias("a")), "u").join(texts.select(F.col("fp").alias("v"), F.col("shingles").alias("b")), "v")
        return held.select("u", "v", "a", "b").mapInArrow(_compared(similarity), f"u {kind}, v {kind}")

    stars = stage(verified(groups.filter("node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))), "stars-alike", BATCH)
    joined = lambda x, as_: stars.select(F.col("u").alias(x), F.col("v").alias(as_))
    rest = candidates.join(joined("u", "of_u"), "u", "left").join(joined("v", "of_v"), "v", "left")
    rest = rest.filter(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v")
    return stars.union(verified(rest))


#: Different shingles up to which single ones are keys; longs of a set's parities.
FEW, PARITIES = 32, 8


def set_keys(own: np.ndarray, similarity: float) -> tuple[np.ndarray, bool]:
    """Keys of a set of hashes, of which any two sets of that Jaccard similarity share one; and whether that could not be made sure.

    Sets of n and more members that are so alike differ in (1 - s) / s * n of them at most, n being the smaller's. The range of hashes is cut into parts, as many as
    the size calls for (by powers of two; a size near the lower end is also cut like those below it). With one part more than that
    difference that is not empty, one at least is the same in both. Parts of the most members come first (equal parts have equally many, so both sets
    order them alike): they are hardly shared by chance, as single members that many sets hold are. Of ``FEW`` members or fewer, single ones are keys: as many of the least as a pair
    can lack, and one.
    """
    n, out, short = len(own), [], False
    v = np.sort(mix64(own))
    if n * similarity <= FEW:
        out.append(mix64(v[: n - int(np.ceil(similarity * n - 1e-9)) + 1] ^ np.uint64(FEW)))
    if n >= FEW:
        need = int((1 - similarity) / similarity * n + 1e-9) + 1
        size = FEW << int(np.log2(n // FEW))
        for parts in (size, size // 2):
            if parts < FEW or n * similarity > 2 * parts:
                continue
            part = ((v >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            start = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            short |= len(start) < need
            fullest = np.argsort(start - np.append(start[1:], n), kind="stable")[:need]
            held = np.add.reduceat(mix64(v + np.uint64(0x9E3779B97F4A7C15)), start)[fullest]
            out.append(mix64(held ^ mix64(part[start[fullest]] * np.uint64(0x2545F4914F6CDD1D) + np.uint64(parts))))
    return np.concatenate(out), short


def _parities(own: np.ndarray) -> bytes:
    """How often members fall into each class, modulo two: sets differ in no fewer members than these in bits."""
    return np.packbits(np.bincount((mix64(own) & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1).tobytes()


def _rest_alike(docs: DataFrame, prints: DataFrame, links: DataFrame, shingle: int, similarity: float, size: int) -> DataFrame:
    """u, v: further links, so that with ``links`` all texts of that similarity are joined, directly or through others.

    Every different set of shingles is keyed by ``set_keys``. Sets that share a key, are not joined by ``links`` and whose sizes and parities
    allow the similarity are compared. Sets for which keys are not sure are compared with all of their size.
    """
    hashed = docs.select(F.xxhash64("doc_id", "text").alias("row_a"), F.hash(F.col("text"), F.col("doc_id")).alias("row_b"), F.col("text").cast("string").alias("text"))
    signs = [f"p{w}" for w in range(PARITIES)]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _with_sets(batches, shingle):
            sets = [np.frombuffer(x, np.uint64) for x in found]
            kept = [i for i, x in enumerate(sets) if len(x)]  # those without words have one fingerprint
            if not kept:
                continue
            made = [set_keys(sets[i], similarity) for i in kept]
            signed = np.frombuffer(b"".join(_parities(sets[i]) for i in kept), np.int64).reshape(-1, PARITIES)
            edges = np.cumsum([0, *[len(m[0]) for m in made]])
            keys = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate([m[0] for m in made]).view(np.int64)))
            names = np.array([xxhash.xxh3_64_intdigest(sets[i].tobytes()) for i in kept], np.uint64).view(np.int64)
            at = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(names), pa.array([len(sets[i]) for i in kept], pa.int32()), pa.array([m[1] for m in made]), keys, *[pa.array(signed[:, w]) for w in range(PARITIES)]],
                names=["row_a", "row_b", "id", "n", "short", "keys", *signs],
            )

    sets = stage(hashed.mapInArrow(keyed, f"row_a long, row_b int, id long, n int, short boolean, keys array<long>, {', '.join(f'{c} long' for c in signs)}"), "sets", BATCH)
    roots = stage(components(links), "roots-so-far")
    named = prints.select("row_a", "row_b", "fp").distinct().join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("row_a", "row_b", "fp", F.coalesce("root", "fp").alias("root"))
    # of equal sets one is compared; they have one fingerprint
    chosen = stage(sets.groupBy("id").agg(F.min(F.struct("row_a", "row_b")).alias("row")).select("id", "row.row_a", "row.row_b"), "chosen-sets")
    nodes = stage(sets.drop("keys", "row_a", "row_b").dropDuplicates(["id"]).join(chosen, "id").join(named, ["row_a", "row_b"]), "nodes")
    first = sets.join(guarded(chosen.select("row_a", "row_b"), chosen.count()), ["row_a", "row_b"], "left_semi")
    entries = first.select("id", F.explode("keys").alias("k")).withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("k"))).filter("c > 1")
    shared = stage(entries.select("k", "id"), "shared-keys")
    discard(sets)
    total = F.col("n_u") + F.col("n_v")
    apart = sum((F.bit_count(F.col(f"{c}_u").bitwiseXOR(F.col(f"{c}_v"))) for c in signs), F.lit(0))
    possible = (F.col("root_u") != F.col("root_v")) & (F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * similarity - 1e-6) & (apart <= total * ((1 - similarity) / (1 + similarity)) + 1e-6)
    side = lambda rows, of: rows.select(*[F.col(c).alias(f"{c}_{of}") for c in rows.columns])
    kind = _kind(size)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, made in _with_sets(batches, shingle):
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.binary())], names=["id", "fp", "shingles"])

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stage(pairs.distinct(), "pairs")
        ids = pairs.select(F.col("id_u").alias("id")).union(pairs.select("id_v")).distinct()
        wanted = stage(ids.join(nodes, "id").select("id", "fp", F.col("row_a").alias("want_a"), F.col("row_b").alias("want_b")), "wanted-sets")
        on = (F.col("row_a") == F.col("want_a")) & (F.col("row_b") == F.col("want_b"))
        texts = hashed.join(guarded(wanted, wanted.count()), on).select("id", "fp", "text").mapInArrow(again, f"id long, fp {kind}, shingles binary")
        texts = stage(texts.dropDuplicates(["id"]), "sets-compared", BATCH)
        held = pairs.join(texts.select(F.col("id").alias("id_u"), F.col("fp").alias("u"), F.col("shingles").alias("a")), "id_u").join(texts.select(F.col("id").alias("id_v"), F.col("fp").alias("v"), F.col("shingles").alias("b")), "id_v")
        return stage(held.select("u", "v", "a", "b").mapInArrow(_compared(similarity), f"u {kind}, v {kind}"), "rest-alike", BATCH)

    def open_keys(nodes: DataFrame) -> DataFrame:
        """Entries (k, and the columns of nodes) of keys whose sets are not joined yet."""
        held = shared.join(nodes.select("id", "n", "root", *signs), "id")
        mixed = held.groupBy("k").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("k")
        return stage(held.join(mixed, "k", "left_semi"), "open-keys")

    # a large group is joined by its least members first, so that few of its pairs are left to be made
    held = open_keys(nodes)
    least = held.groupBy("k").agg(F.min(F.struct("id", "n", "root", *signs)).alias("v")).select(F.col("k").alias("k_v"), *[F.col(f"v.{c}").alias(f"{c}_v") for c in ("id", "n", "root", *signs)])
    found = verified(side(held, "u").join(least, (F.col("k_u") == F.col("k_v")) & (F.col("id_u") != F.col("id_v")) & possible).select("id_u", "id_v"))
    over = components(found.join(nodes.select(F.col("fp").alias("u"), F.col("root").alias("a")).distinct(), "u").join(nodes.select(F.col("fp").alias("v"), F.col("root").alias("b")).distinct(), "v").select(F.col("a").alias("u"), F.col("b").alias("v")))
    discard(held)
    nodes = stage(nodes.join(over.select(F.col("node").alias("root"), F.col("root").alias("joined")), "root", "left").withColumn("root", F.coalesce("joined", "root")).drop("joined"), "nodes-joined")
    held = open_keys(nodes)
    pairs = side(held, "u").join(side(held, "v"), (F.col("k_u") == F.col("k_v")) & (F.col("id_u") < F.col("id_v")) & possible).select("id_u", "id_v")
    unsure = nodes.filter("short")
    if not unsure.isEmpty():
        pairs = pairs.union(side(unsure, "u").join(side(nodes, "v"), possible).select("id_u", "id_v"))
    return found.union(verified(pairs))


def _compared(similarity: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # views of the batch, not copies
            near = [jaccard(a.as_buffer(), b.as_buffer()) >= similarity for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    return rows


def near_duplicates(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, slices: int = 3, size: int = 1, repeats: bool = True, forest: Forest | None = None, similarity: float | None = None
) -> DataFrame:
    """doc_id, row_a, row_b, fp and component_id: the smallest doc_id that a row's fingerprint reaches by links of ``max_bits``.

    ``size`` words of 64 bits make a fingerprint (with or without ``repeats`` of its shingles). Without a
    ``forest`` trees over ``slices`` of each word find all pairs; with one, pairs that share a shard
    count. With ``similarity`` links are candidates: only those count whose texts' different
    shingles have that Jaccard similarity, at least.

    Texts without words (null and empty ones too) have fingerprint 0 and are linked like any
    other. Rows without doc_id take part, but give no component_id unless their component has an
    id. Repeated rows come back repeated; an empty table gives no rows. Very long texts are read
    whole. Only doc_id and text are read.
    """
    prints = stage(fingerprints(docs, shingle, size, repeats), "fingerprints", BATCH)
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    # the shards, and whatever else is written on the way, go before the next step begins
    links = settled(lambda: near_links(classes, max_bits, slices, size, forest), "links-found")
    if similarity is not None:
        near = settled(lambda: _alike(docs, prints, links, shingle, similarity, size), "links-alike", BATCH)
        links = near.union(settled(lambda: _rest_alike(docs, prints, near, shingle, similarity, size), "links-rest"))
    roots = settled(lambda: components(links), "roots")
    groups = roots.join(classes, roots.node == classes.fp).groupBy("root").agg(F.min("first").alias("component_id"))
    of = roots.join(groups, "root").select(F.col("node").alias("fp"), "component_id")
    # written, so that the join below is of two plain exchanges, which Spark can split where one fingerprint has many rows
    named = stage(classes.join(of, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "named")
    return prints.join(named, "fp")


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """One row of every group of ``near_duplicates(docs, **how)``, that with the smallest doc_id (without ids, any fixed one); columns unchanged.

    Rows alike in id and text are one choice: one of them stays.
    """

    def fates() -> DataFrame:
        found = near_duplicates(docs, **how)
        # without an id in the whole group, its rows are told apart by fingerprint alone
        group = F.struct(F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")))
        found = stage(found.groupBy("row_a", "row_b").agg(F.min("doc_id").alias("doc_id"), F.min(group).alias("group"), F.count(F.lit(1)).alias("copies")), "rows")
        best = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_a", "row_b")).alias("best"))
        chosen = best.select(F.col("best.row_a").alias("row_a"), F.col("best.row_b").alias("row_b"), F.lit(True).alias("chosen"))
        return found.join(chosen, ["row_a", "row_b"], "left").filter("chosen IS NULL OR copies > 1").select(F.col("row_a").alias("__fate_a"), F.col("row_b").alias("__fate_b"), F.col("chosen").alias("__chosen"))

    # lists of what goes are short beside the texts, which then need not move
    fate = settled(fates, "fate")
    a, b, n = (f"__{x}" for x in ("row_a", "row_b", "row_n"))
    on = (F.col(a) == F.col("__fate_a")) & (F.col(b) == F.col("__fate_b"))
    keyed = docs.withColumns({a: F.xxhash64("doc_id", "text"), b: F.hash(F.col("text"), F.col("doc_id"))})
    kept = keyed.join(guarded(fate, fate.count()), on, "left_anti").select(*quoted(docs.columns))
    copied = fate.filter("__chosen")
    several = copied.count()
    if not several:
        return kept
    same = Window.partitionBy(a, b).orderBy(F.lit(1))
    first = keyed.join(guarded(copied, several), on, "left_semi").withColumn(n, F.row_number().over(same)).filter(F.col(n) == 1)
    return kept.unionByName(first.select(*quoted(docs.columns)))
