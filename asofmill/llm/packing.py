"""Packing documents into sequences by cutting-stock column generation.

A document is cut into whole sequences and a rest. The histogram of the rests' lengths, in units of
a few tokens, is a cutting-stock problem: how often is each pattern of lengths used, so that all
rests are placed in as few sequences as possible? Its linear program starts from patterns of one
length; a knapsack over the dual prices finds the pattern that improves it most, until none does
by much. Rounded down, its patterns are laid out over the rests, ranked within their length; what
the rounding leaves is placed by first fit over the counts. Rests that fill sequences worst are then
cut along the gaps of all others, so that nothing is padded but what does not add up to a whole
sequence, and that is laid out in powers of two.

The driver holds the histograms and the patterns, whose number the number of lengths bounds.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..shipping import ship
from .common import guarded, split_text_batches, stage
from .token_counts import PATTERN

#: Tokens of a sequence, tokens of a unit of length, and the id that ends a document.
LENGTH, UNIT, END = 2048, 8, 1
#: The linear program ends within this share of its bound, or after so many columns.
GAP, COLUMNS = 5e-4, 4000
#: Rows of a bucket of the distributed ranks; tokens of a cell in which cuts meet gaps; parts of the sequences of one fill.
BUCKET, CELL, PARTS = 50_000, 1 << 16, 16


def read_tokenizer(spark: SparkSession, path: str) -> bytes:
    """A tokenizer's JSON (a few MB), from any store that Spark reads; a bare path is one of the driver's own files."""
    if "://" not in path:
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def encoder_of(raw: bytes) -> Callable[[str], np.ndarray]:
    """text -> ids as ``tokenizers`` gives them without special tokens added.

    A byte-level vocabulary whose ids follow its merges is read by tiktoken, which gives the same ids
    several times as fast; texts that it can't split (very long runs of blanks), and all other vocabularies, are left to ``tokenizers``.
    """
    own = Tokenizer.from_str(raw.decode())
    slow = lambda text: np.array(own.encode(text, add_special_tokens=False).ids, np.uint32)
    told = json.loads(raw)
    model, before, added = told["model"], told.get("pre_tokenizer") or {}, told.get("added_tokens") or []
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")) and not told.get("normalizer")
    if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or not plain:
        return slow
    special = {x["content"]: x["id"] for x in added}
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocabulary.get(a + b) for a, b in merges]
    if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added) or None in ids or ids != sorted(ids) or len(ids) + 256 != len(vocabulary):
        return slow
    letters = _byte_of_letter()
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={bytes(letters[c] for c in k): v for k, v in vocabulary.items()}, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32, copy=False)
        except ValueError:
            return slow(text)

    return encode


_encoders: dict[int, Callable[[str], np.ndarray]] = {}

CHUNKS = "doc_id long, start long, length int, doc_tokens long, crc long, ids binary"


def chunks_of(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, start, length, doc_tokens, crc, ids: every document's whole sequences (without ids) and its rest, encoded once."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizer(docs.sparkSession, tokenizer))
    last = np.array([end], np.uint32)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        encode = _encoders[key] = _encoders.get(key) or encoder_of(shared.value)
        for batch in split_text_batches(batches, "text"):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate((encode(text), last)) if text else last
                raw, n = ids.astype("<u4").tobytes(), len(ids)
                for at in range(0, n, length):
                    piece = raw[4 * at : 4 * (at + length)]
                    own = len(piece) // 4
                    out.append((doc_id, at, own, n, zlib.crc32(piece), piece if own < length else None))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            for at in range(0, len(out), 4096):
                columns = zip(*out[at : at + 4096], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in CHUNKS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, CHUNKS)


def best_pattern(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of ``sizes`` that fits ``room``: an unbounded knapsack by dynamic programming."""
    use = np.flatnonzero(values > 1e-12)
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    order = use[np.argsort(sizes[use], kind="stable")]
    own, worth = sizes[order], values[order]
    fits = np.searchsorted(own, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c], last[c] = best[c - 1], -1
        if fits[c]:
            got = best[c - own[: fits[c]]] + worth[: fits[c]]
            i = int(got.argmax())
            if got[i] > best[c]:
                best[c], last[c] = got[i], i
    pattern, c = np.zeros(len(values), np.int64), room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[order[last[c]]] += 1
            c -= int(own[last[c]])
    return float(best[room]), pattern


def relaxed(counts: np.ndarray, sizes: np.ndarray, room: int, gap: float = GAP, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray, float]:
    """Patterns (rows) and how often each is used in the linear program, and its lower bound of sequences.

    The simplex method on the patterns that the knapsack prices. Every pattern's part is a pattern too, so counts are met exactly.
    """
    m = len(sizes)
    each = room // sizes
    patterns = np.diag(each)
    inverse = np.diag(1.0 / each)
    used = counts / each
    bound = float(counts @ sizes) / room
    for _ in range(columns):
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(prices, sizes, room)
        bound = max(bound, used.sum() / max(worth, 1.0))  # prices over the best pattern's worth are feasible in the dual
        if worth <= 1 + 1e-9 or used.sum() <= bound * (1 + gap):
            break
        step = inverse @ pattern
        can = step > 1e-9
        ratio = np.full(m, np.inf)
        ratio[can] = used[can] / step[can]
        leaves = int(ratio.argmin())
        used -= ratio[leaves] * step
        used[leaves] = ratio[leaves]
        np.maximum(used, 0, out=used)
        pivot = inverse[leaves] / step[leaves]
        inverse -= step[:, None] * pivot
        inverse[leaves] = pivot
        patterns[leaves] = pattern
    return patterns, used, bound


def patterns_of(counts: np.ndarray, sizes: np.ndarray, room: int, gap: float = GAP, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray, float]:
    """Patterns (rows), how many sequences each gets, and the lower bound: together they place exactly ``counts`` pieces of each size."""
    if not len(sizes):
        return np.zeros((0, 0), np.int64), np.zeros(0, np.int64), 0.0
    patterns, used, bound = relaxed(counts.astype(float), sizes, room, gap, columns)
    times = np.floor(used + 1e-7).astype(np.int64)
    for p in np.flatnonzero(times):  # rounding errors never place more than there is
        own = patterns[p] > 0
        left = counts - np.delete(times, p) @ np.delete(patterns, p, axis=0)
        times[p] = max(0, min(times[p], int((left[own] // patterns[p][own]).min())))
    left = counts - times @ patterns
    more, often = [], []
    by_size = np.argsort(-sizes, kind="stable")
    while left.any():
        pattern, free = np.zeros(len(sizes), np.int64), room
        for k in by_size:
            pattern[k] = min(left[k], free // sizes[k])
            free -= pattern[k] * sizes[k]
        own = pattern > 0
        n = int((left[own] // pattern[own]).min())
        more.append(pattern)
        often.append(n)
        left = left - n * pattern
    keep = times > 0
    return np.array([*patterns[keep], *more]), np.array([*times[keep], *often], np.int64), bound


def layout(patterns: np.ndarray, times: np.ndarray) -> dict[str, np.ndarray]:
    """For every class the ranks that each pattern takes: arrays k, low (first rank), each (pieces a sequence), base (first sequence), ordered by class and rank."""
    base = np.concatenate(([0], np.cumsum(times)))[:-1]
    p, k = np.nonzero(patterns)
    order = np.lexsort((p, k))
    p, k = p[order], k[order]
    taken = patterns[p, k] * times[p]
    low = np.cumsum(taken) - taken
    first = np.searchsorted(k, k)
    return {"k": k, "low": low - low[first], "each": patterns[p, k], "base": base[p]}


def running(rows: DataFrame, n: int, value: Column, upto: str, name: str, *group: str) -> DataFrame:
    """rows (with a unique ``row``) and ``upto``: the sum of ``value`` over all rows before them in their group, in an order of its own.

    Groups of any size: rows are dealt to buckets of some ``BUCKET`` rows by hash, and buckets' sums are added up first.
    """
    buckets = max(1, -(-n // BUCKET))
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")).withColumn("__value", value.cast("long"))
    sums = rows.groupBy(*group, "__bucket").agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.select(*group, "__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before")), name)
    within = Window.partitionBy(*group, "__bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(guarded(sums, sums.count()), [*group, "__bucket"])
    return joined.withColumn(upto, F.col("__before") + F.coalesce(F.sum("__value").over(within), F.lit(0))).drop("__bucket", "__value", "__before")


def weakest(fills: list[tuple[int, int, int]], length: int) -> tuple[int, int]:
    """The last (fill, part) of the sequences to take apart: the fewest, from the least full ones, whose tokens fill the gaps of the others.

    fills: (fill, part, sequences). (-1, -1) if there are no gaps.
    """
    fills = sorted(fills)
    gaps, tokens, last = sum(n * (length - fill) for fill, _, n in fills), 0, (-1, -1)
    for fill, part, n in fills:
        if tokens >= gaps:
            break
        tokens, gaps, last = tokens + n * fill, gaps - n * (length - fill), (fill, part)
    return last


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, unit: int = UNIT, end: int = END, gap: float = GAP, columns: int = COLUMNS
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row for every piece of a document, all documents in sequences of ``length`` tokens at most.

    A document is its ids and then ``end``; null and empty texts are that one id. Pieces of more than a sequence's length are
    cut into whole sequences first; rests stay whole unless they are used to fill gaps. All sequences are full but those at
    the end, whose lengths are different powers of two, so nothing is padded where such lengths need no padding. ``length`` is a
    multiple of ``unit``. Every row is a document of its own, whether its id is null or repeated or its text is another's; an
    empty table gives no rows. Very long texts are encoded whole. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    names = ["doc_id", "start", "length", "doc_tokens", "crc"]
    chunks = stage(chunks_of(docs, tokenizer, length, end).withColumn("row", F.monotonically_increasing_id()), "chunks")
    rests = chunks.filter(F.col("length") < length).select("row", *names, F.ceil(F.col("length") / unit).cast("int").alias("k"))
    hist = sorted((r.k, r["count"]) for r in rests.groupBy("k").count().collect())  # a row for each length in units
    sizes, counts = np.array([k for k, _ in hist], np.int64), np.array([n for _, n in hist], np.int64)
    patterns, times, _ = patterns_of(counts, sizes, length // unit, gap, columns)
    plan = layout(patterns, times) if len(sizes) else None
    n, sequences = int(counts.sum()), int(times.sum())
    shared = spark.sparkContext.broadcast((plan, sizes, counts))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, sizes, counts = shared.value
        keys = (np.cumsum(counts) - counts)[plan["k"]] + plan["low"]  # ranks of one class follow those of the class before
        begins = np.cumsum(counts) - counts
        for batch in batches:
            k, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (6, 7))
            k = np.searchsorted(sizes, k)
            at = np.searchsorted(keys, begins[k] + rank, side="right") - 1
            sequence = plan["base"][at] + (rank - plan["low"][at]) // plan["each"][at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(sequence)], names=["row", *names, "sequence"])

    spec = "row long, doc_id long, start long, length int, doc_tokens long, crc long, sequence long"
    if n:
        ranked = running(rests, n, F.lit(1), "rank", "ranks", "k").select("row", *names, "k", "rank")
        own = Window.partitionBy("sequence")
        before = own.orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
        laid = ranked.mapInArrow(placed, spec).select(
            "*", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), F.sum("length").over(own).cast("int").alias("fill"), F.pmod(F.xxhash64("sequence"), F.lit(PARTS)).cast("int").alias("part")
        )
        laid = stage(laid, "placed")
    else:
        laid = spark.createDataFrame([], f"{spec}, offset long, fill int, part int")
    fills = [(r.fill, r.part, r["count"]) for r in laid.filter("offset = 0").groupBy("fill", "part").count().collect()]  # lengths times PARTS at most
    last = weakest(fills, length)
    taken = F.struct("fill", "part") <= F.struct(F.lit(last[0]), F.lit(last[1]))
    kept = laid.filter(~taken).select(*names, F.col("sequence").alias("sequence_id"), "offset")
    apart = _cut(spark, laid, taken, [x for x in fills if x[:2] <= last], [x for x in fills if x[:2] > last], sequences, length)
    apart = stage(apart, "cuts")
    # ids move for the rests that are cut, and for no others
    rows = apart.select("row").distinct()
    held = chunks.select("row", "doc_id", "doc_tokens", F.col("start").alias("begin"), "ids").join(guarded(rows, rows.count()), "row", "left_semi")
    cut = apart.join(held, "row").select(
        "doc_id", (F.col("begin") + F.col("from")).alias("start"), "length", "doc_tokens",
        F.crc32(F.substring("ids", (F.col("from") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))).alias("crc"), "sequence_id", "offset",
    )
    # ids of whole sequences come after all others: twice as many numbers as rests place bound those
    whole = chunks.filter(F.col("length") == length).select(*names, (F.col("row") + 2 * sequences + 64).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return kept.union(cut).union(whole).select("doc_id", "start", F.col("length").cast("long"), F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _cut(spark: SparkSession, laid: DataFrame, taken: Column, apart: list, others: list, sequences: int, length: int) -> DataFrame:
    """row, from (tokens of the rest before), length, sequence_id, offset: the rests of sequences ``taken`` apart, cut along the gaps of the others.

    Both lie along one line of tokens, the rests without gaps, the gaps one after another and then new sequences; within a
    cell of the line each stretch belongs to the last rest and the last gap that began.
    """
    schema = "row long, `from` long, length long, sequence_id long, offset long"
    tokens, gaps = sum(n * fill for fill, _, n in apart), sum(n * (length - fill) for fill, _, n in others)
    if not tokens:
        return spark.createDataFrame([], schema)
    pieces = laid.filter(taken)
    pieces = running(pieces, -(-tokens // 64), F.col("length"), "at", "cut-pieces")
    pieces = pieces.select("at", F.col("length").cast("long").alias("size"), "row", F.lit(None).cast("long").alias("sequence"), F.lit(None).cast("long").alias("offset"))
    open_ = laid.filter(~taken & (F.col("offset") == 0) & (F.col("fill") < length)).select(F.col("sequence").alias("row"), "fill")
    open_ = running(open_, max(1, sum(n for fill, _, n in others if fill < length)), F.lit(length) - F.col("fill"), "at", "gaps")
    nothing = F.lit(None).cast("long").alias("row")
    gap_rows = open_.select("at", (F.lit(length) - F.col("fill")).cast("long").alias("size"), nothing, F.col("row").alias("sequence"), F.col("fill").cast("long").alias("offset"))
    left = tokens - gaps
    new = spark.range(left // length).select((F.col("id") * length + gaps).alias("at"), F.lit(length).cast("long").alias("size"), nothing, (F.col("id") + sequences).alias("sequence"), F.lit(0).cast("long").alias("offset"))
    tail, at, number = [], gaps + left // length * length, sequences + left // length
    for bit in reversed(range(length.bit_length())):
        if (left % length) >> bit & 1:
            tail.append((at, 1 << bit, None, number, 0))
            at, number = at + (1 << bit), number + 1
    ends = spark.createDataFrame(tail, "at long, size long, row long, sequence long, offset long")
    line = pieces.union(gap_rows).union(new).union(ends)
    first, last = F.floor(F.col("at") / CELL), F.floor((F.col("at") + F.col("size") - 1) / CELL)
    line = line.withColumn("cell", F.explode(F.sequence(first, last))).withColumn("begin", F.greatest("at", F.col("cell") * CELL)).withColumn("stop", F.least(F.col("at") + F.col("size"), (F.col("cell") + 1) * CELL))
    order = Window.partitionBy("cell").orderBy("begin")
    met = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    piece = F.last(F.when(F.col("row").isNotNull(), F.struct("row", "at")), ignorenulls=True).over(met)
    gap = F.last(F.when(F.col("sequence").isNotNull(), F.struct("sequence", "at", "offset")), ignorenulls=True).over(met)
    upto = F.coalesce(F.lead("begin").over(order), F.max("stop").over(Window.partitionBy("cell")))
    stretches = line.select("begin", piece.alias("piece"), gap.alias("gap"), upto.alias("upto")).filter("upto > begin")
    return stretches.select("piece.row", (F.col("begin") - F.col("piece.at")).alias("from"), (F.col("upto") - F.col("begin")).alias("length"), F.col("gap.sequence").alias("sequence_id"), (F.col("gap.offset") + F.col("begin") - F.col("gap.at")).alias("offset"))
