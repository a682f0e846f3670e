"""Benchmark decontamination by templates.

Numbers, names and units become typed slots; what is left of a text is its template. Windows of
template words are hashed, and windows of documents are joined with those of the benchmark. A
document and an item match along a shift where what stands in the slots fits: one value of the item
has one value in the document throughout a run of windows that overlap. Windows whose slots are
unchanged match whatever the others of their run hold. So a question with other numbers or names is found, and
two texts that merely share slot-ridden wording are not.

A capitalised word inside a sentence is a name. One that opens a sentence may be a name or a word, and no list decides: texts are
read both ways, each with its own slots and windows, and either reading may meet either.

With ``exact``, windows that are mostly slots, and items that are too short for a template, are
looked for as well, by their very words and values. An item of a word or two proves nothing, so such matches are told apart (``CONCLUSIVE``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import guarded, mix64, split_text_batches, stage, window_hashes

#: Template words of a window, words that an item needs to be looked for, and bits of the filter of benchmark windows.
WINDOW, LEAST, FILTER_BITS = 10, 8, 24
#: Template words that a window has at least for its match to be a proof.
CONCLUSIVE = 4
#: Bytes of benchmark windows that may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 48 << 20

# Words that fill slots.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion dozen half quarter third".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent degree degrees celsius fahrenheit "
    "mph kmh hz khz mhz ghz watt watts kw kwh volt volts joule joules byte bytes kb mb gb tb meter meters metre metres kilometer kilometers kilometre kilometres".split()
)

#: Bytes of text that a worker reads at once, different tokens that it remembers between them, bytes of rows that it gets at once. Workers keep what they once took.
SLICE, REMEMBERED, BATCH = 1 << 19, 50_000, 1 << 22
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:;\n]")
_PLAIN, _CAPITAL, _NUMBER, _UNIT, _STOP = range(5)
_NUMBER_SLOT, _UNIT_SLOT, _NAME_SLOT = 0x9AE16A3B2F90404F, 0xC949C7DEFB2D1E1D, 0xB492B66FBE98F273
_BASE = 0xD1342543DE82EF95
#: Added to the width of windows that are hashed with what their slots hold.
_EXACT = 1 << 32


class _Vocabulary(dict):
    """Token -> number; kinds, hashes and lower-case forms by number."""

    def __init__(self) -> None:
        self.kinds, self.hashes, self.forms = [], [], []

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token[0].isdigit() or low in NUMBER_WORDS:
            kind = _NUMBER
        elif token in ".!?:;\n":
            kind = _STOP
        elif low in UNITS:
            kind = _UNIT
        elif token[0].isupper() and token != "I" and token[1:] == low[1:]:
            kind = _CAPITAL
        else:
            kind = _PLAIN
        self[token] = n = len(self.kinds)
        self.kinds.append(kind)
        self.hashes.append(xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")))
        self.forms.append(low)
        return n


class Tokens:
    """Words of several texts, one after another: token, text, kind, and whether each opens a sentence."""

    def __init__(self, texts: list[str | None], vocabulary: _Vocabulary):
        found = [_TOKEN.findall(t) if t else [] for t in texts]
        n = np.fromiter(map(len, found), np.int64, len(found))
        token = np.fromiter((vocabulary[t] for tokens in found for t in tokens), np.int64, int(n.sum()))
        of = np.repeat(np.arange(len(texts)), n)
        kind = np.array(vocabulary.kinds, np.int8)[token] if len(token) else np.zeros(0, np.int8)
        opens = np.ones(len(token), bool)  # a sentence, at its first word
        opens[1:] = (kind[:-1] == _STOP) | (of[1:] != of[:-1])
        word = kind != _STOP
        self.texts, self.vocabulary = len(texts), vocabulary
        self.token, self.of, self.kind, self.opens = token[word], of[word], kind[word], opens[word]
        self.first = np.searchsorted(self.of, np.arange(len(texts) + 1))


class Templates:
    """Template words of several texts, by one reading of the words that open sentences: hash, slot or not, number of the word's form, and where each text begins."""

    def __init__(self, tokens: Tokens, names: bool):
        token, of, kind, vocabulary = tokens.token, tokens.of, tokens.kind, tokens.vocabulary
        same = np.zeros(len(token), bool)
        same[1:] = of[1:] == of[:-1]
        # a capital inside a sentence makes a name, and one at its beginning by this reading; a unit counts after a number only
        name = (kind == _CAPITAL) & (~tokens.opens | names)
        number = kind == _NUMBER
        unit = kind == _UNIT
        unit[1:] &= number[:-1] & same[1:]
        unit[:1] = False
        again = np.zeros(len(token), bool)
        again[1:] = name[1:] & name[:-1] & same[1:]  # first and last name are one slot
        hashes = np.array(vocabulary.hashes, np.uint64)[token] if len(token) else np.zeros(0, np.uint64)
        words = hashes.copy()
        for mask, slot in ((name, _NAME_SLOT), (number, _NUMBER_SLOT), (unit, _UNIT_SLOT)):
            hashes[mask] = slot
        stay = np.flatnonzero(~again)
        self.names, self.words, self.word = names, words[stay], stay
        self.hashes, self.slot, self.token, self.of = hashes[stay], (name | number | unit)[stay], token[stay], of[stay]
        self.first = np.searchsorted(self.of, np.arange(tokens.texts + 1))
        self.begins = tokens.first
        self.forms = vocabulary.forms

    def windows(self, width: int, texts: np.ndarray | None = None, exact: bool = False, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of ``width`` words that lies in one text and has half its words, at least, outside slots.

        With ``exact``, of each other window (of each, if shorter than ``least``), hashed with what its slots hold.
        """
        at = np.arange(max(0, len(self.hashes) - width + 1))
        plain = np.concatenate(([0], np.cumsum(~self.slot)))
        wording = (2 * (plain[at + width] - plain[at]) >= width) & (width >= least)
        keep = (self.of[at] == self.of[at + width - 1]) & (wording != exact)
        if texts is not None:
            keep &= texts[self.of[at]]
        at = at[keep]
        salt = np.uint64(width + (_EXACT if exact else 0))
        return at, mix64(window_hashes(self.words if exact else self.hashes, at, width, _BASE) + salt) if len(at) else np.zeros(0, np.uint64)

    def values(self, at: int, width: int) -> list[str]:
        return [self.forms[t] for t in self.token[at : at + width][self.slot[at : at + width]].tolist()]


def readings(texts: list[str | None], vocabulary: _Vocabulary) -> list[Templates]:
    """The texts with the words that open sentences read as words, and as names."""
    tokens = Tokens(texts, vocabulary)
    return [Templates(tokens, False), Templates(tokens, True)]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[Templates]]]:
    """Slices of the batches (their last column is the text), each with the readings of its texts."""
    vocabulary = _Vocabulary()
    for batch in split_text_batches(batches, "text", SLICE):
        if len(vocabulary) > REMEMBERED:
            vocabulary = _Vocabulary()
        yield batch, readings(batch.column(batch.num_columns - 1).to_pylist(), vocabulary)


#: Windows chosen of a reading: its width, first template words, hashes, and whether they are exact.
_Chosen = tuple[Templates, int, np.ndarray, np.ndarray, bool]


def _rows(ids: list[pa.Array], names: list[str], chosen: list[_Chosen]) -> pa.RecordBatch:
    join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
    of = pa.array(join([t.of[a] for t, _, a, _, _ in chosen], np.int64))
    values = [t.values(x, w) for t, w, a, _, _ in chosen for x in a.tolist()]
    columns = {
        "window": join([h.view(np.int64) for *_, h, _ in chosen], np.int64),
        **{n: x.take(of) for n, x in zip(names, ids, strict=True)},
        "place": join([a - t.first[t.of[a]] for t, _, a, _, _ in chosen], np.int32),
        "word": join([t.word[a] - t.begins[t.of[a]] for t, _, a, _, _ in chosen], np.int32),
        "names": join([np.full(len(a), t.names) for t, _, a, _, _ in chosen], bool),
        "slots": pa.array(values, pa.list_(pa.string())),
        "width": join([np.full(len(a), w) for _, w, a, _, _ in chosen], np.int32),
        "exact": join([np.full(len(a), e) for *_, a, _, e in chosen], bool),
    }
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


_WINDOW_ROW = "place int, word int, names boolean, slots array<string>, width int, exact boolean"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, least: int = LEAST, exact: bool = False) -> DataFrame:
    """window (hash), item_id, place, word, names (the reading), slots, width, exact: every window of each item; an item shorter than ``window`` is one window."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in split_text_batches(batches, "text"):
            chosen: list[_Chosen] = []
            for templates in readings(batch.column(1).to_pylist(), _Vocabulary()):
                n = np.diff(templates.first)
                kinds = [(w, False) for w in range(least, window + 1)] + [(w, True) for w in range(1, window + 1) if exact and not templates.names]
                chosen += [(templates, w, *templates.windows(w, np.minimum(n, window) == w, kind, least), kind) for w, kind in kinds]
            yield _rows([batch.column(0)], ["item_id"], chosen)

    return benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, f"window long, item_id long, {_WINDOW_ROW}")


def _filter_of(windows: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, set where a window's hash begins so; of one size however large the benchmark is."""
    spot = F.shiftrightunsigned("window", 64 - bits)
    found = windows.groupBy(F.bitmap_bucket_number(spot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")).collect()
    out = np.zeros((1 << bits) // 8 + 8192, np.uint8)
    for r in found:  # bucket k (from 1) holds the bits of 32768 spots; spot 0 is in bucket 0's last place
        start = (r.bucket - 1) * 4096 + 4096
        out[start : start + 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def _may_hold(filter_: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    spot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    bucket = np.where(spot > 0, 1 + (spot - 1) // 32768, 0)
    position = np.where(spot > 0, (spot - 1) % 32768, 0)
    return (filter_[bucket * 4096 + position // 8] >> (position % 8).astype(np.uint8)) & 1 == 1


def _once(templates: Templates, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each hash in each text: where a match says little, its places say nothing more."""
    order = np.lexsort((at, hashes, templates.of[at]))
    of, own = templates.of[at][order], hashes[order]
    first = np.ones(len(order), bool)
    first[1:] = (of[1:] != of[:-1]) | (own[1:] != own[:-1])
    keep = np.sort(order[first])
    return at[keep], hashes[keep]


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least: int = LEAST, filter_bits: int = FILTER_BITS, exact: bool = False, conclusive: int = CONCLUSIVE) -> DataFrame:
    """Pairs of a document and an item that share a template: one row for each pair (and each row of a repeated id).

    doc_id, row_a, row_b (they name the row), item_id, n_windows (different windows of the item
    that match), item_windows, coverage (their ratio), changed (slots
    whose value differs, at the shift with the most windows), verbatim (none does) and conclusive (the windows have ``conclusive``
    template words or more: a document that holds an item of one to three words need not have it from there).

    Null and empty texts match nothing. Items without id, with fewer than ``least`` template
    words, or without a window that is half wording match nothing, unless ``exact`` is set: then a
    window that is mostly slots, and a whole item that is too short, match the same words with the
    same values, however few. Equal windows of an item all count, and repeated items count once. Repeated rows alike in id and text get a row for both.
    Very long texts are read whole; an empty table on either side gives no rows. Only doc_id, text and item_id, text are read.
    """
    ship(docs.sparkSession)
    items = stage(benchmark_windows(benchmark, window, least, exact).distinct(), "items")
    widths = sorted((r.width, r.exact) for r in items.select("width", "exact").distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast((_filter_of(items, filter_bits), widths))
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row_a"), F.hash(F.col("text"), F.col("doc_id")).alias("row_b"), F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, wanted = shared.value
        for batch, both in _read(batches):
            chosen: list[_Chosen] = []
            for templates in both:
                for width, kind in wanted:
                    if kind and templates.names:
                        continue
                    at, hashes = templates.windows(width, None, kind, least)
                    hit = _may_hold(filter_, hashes, filter_bits)
                    at, hashes = at[hit], hashes[hit]
                    chosen.append((templates, width, *(_once(templates, at, hashes) if width < conclusive else (at, hashes)), kind))
            yield _rows(list(batch.columns[:3]), ["row_a", "row_b", "doc_id"], chosen)

    found = keyed.mapInArrow(rows, f"window long, row_a long, row_b int, doc_id long, {_WINDOW_ROW}").drop("word", "width", "exact")
    own = items.select("window", "item_id", F.col("place").alias("item_place"), "word", F.col("names").alias("item_names"), F.col("slots").alias("item_slots"), "width")
    weight = items.agg(F.sum(F.octet_length(F.concat_ws(",", "slots")) + 24 * F.size("slots") + 64)).first()[0] or 0
    pairs = found.join(F.broadcast(own) if weight <= BROADCAST_BYTES else own, "window").filter(F.size("slots") == F.size("item_slots"))
    key = ["row_a", "row_b", "doc_id", "item_id", "names", "item_names", "shift"]
    met = pairs.select(
        *key[:6], (F.col("place") - F.col("item_place")).alias("shift"), F.col("item_place").alias("at"), "word", "width", (F.col("slots") == F.col("item_slots")).alias("same"),
        F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("own")).alias("values"),
    ).distinct()
    ordered = Window.partitionBy(*key).orderBy("at")
    begins = F.coalesce(F.col("at") >= F.lag(F.col("at") + F.col("width")).over(ordered), F.lit(False))
    runs = (
        met.withColumn("begins", begins.cast("int"))
        .withColumn("run", F.sum("begins").over(ordered))
        .groupBy(*key, "run")
        .agg(F.collect_set(F.struct("word", "same")).alias("windows"), F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"), F.max("width").alias("width"))
    )
    # one value of the item stands for one value of the document, all along the run
    fits = F.size("values") == F.size(F.array_distinct(F.col("values.item")))
    along = (
        runs.withColumn("places", F.filter("windows", lambda w: fits | w["same"])["word"])
        .groupBy(*key)
        .agg(F.flatten(F.collect_set("places")).alias("places"), F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"), F.max("width").alias("width"))
        .filter(F.size("places") > 0)
        .withColumn("changed", F.size(F.filter("values", lambda v: v["item"] != v["own"])))
    )
    sizes = items.groupBy("item_id").agg(F.count_distinct("word").cast("int").alias("item_windows"))
    best = (
        along.groupBy("row_a", "row_b", "doc_id", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("n_windows"),
            F.max_by("changed", F.struct(F.size("places"), -F.col("changed"))).alias("changed"),
            (F.max("width") >= conclusive).alias("conclusive"),
        )
        .join(sizes, "item_id")
    )
    return best.select(
        "doc_id", "row_a", "row_b", "item_id", "n_windows", "item_windows", (F.col("n_windows") / F.col("item_windows")).alias("coverage"), "changed", (F.col("changed") == 0).alias("verbatim"), "conclusive"
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least: int = LEAST, exact: bool = False) -> DataFrame:
    """The rows of docs that match no item conclusively; columns unchanged.

    Rows with null or empty text stay, with an empty benchmark all do, and of an empty table none. Repeated rows go or stay together, whatever their id; null ids are ids
    of their own. Long texts are read whole. A document that holds an item of a word or two stays.
    """
    found = matches(docs, benchmark, window, least, exact=exact).filter("conclusive")
    bad = stage(found.select(F.col("row_a").alias("__bad_a"), F.col("row_b").alias("__bad_b")).distinct(), "contaminated", BATCH)
    on = (F.xxhash64("doc_id", "text") == F.col("__bad_a")) & (F.hash(F.col("text"), F.col("doc_id")) == F.col("__bad_b"))
    return docs.join(guarded(bad, bad.count()), on, "left_anti")
