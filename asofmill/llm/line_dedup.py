"""Line dedup by a segment-partition edit join, in DataFrame operations only.

Two lines are near-copies if at most ``max_edits`` characters have to be inserted, deleted or
replaced. A line of length n is cut into max_edits + 1 segments; a near-copy holds one of them
unchanged, at a place that the lengths and the number of edits bound. So each line puts its
segments into an index by (length, segment) and probes with the substrings that the indexes of
its own and the shorter lengths call for. Pairs are verified by a banded bit-parallel edit
distance on what lies between their common beginning and end.

Only hashes of segments move; texts are fetched for the lines that share a segment. A segment
that more than ``crowd`` different lines share makes no pairs: with one edit allowed, its lines
are keyed by all that lies outside one block (``BLOCKS`` of them, or the root of the length if that
is more), then by the line without one character of a shared block. Lines with such a key in common are near-copies; each is linked to
the least of them.

With more edits, lines of a crowded segment carry signatures: parities of the letter pairs they hold, of which an edit changes four
at most. They are linked to the least line of the segment, if near it; of those that are not linked by that, pairs leave the join only if their signatures
and then the lines themselves (of long ones the beginnings and ends) allow it. So lines that merely have much in common make no rows. Where more than ``SHARED`` lines
share a segment, what lies outside it is first cut into max_edits + 1 segments in its turn, one of which a near-copy also holds; and so once more (``DEPTH``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import guarded, quoted, settled, stage
from .components import components

#: Shortest line that is looked at; lines of one segment from which keys replace pairs; blocks of such a line at least.
LEAST, CROWD, BLOCKS = 16, 8, 8
#: Times that what lies outside shared segments is cut into segments again, for lines of segments that more than so many share.
DEPTH, SHARED = 3, 1024
#: Longs of a signature; characters of a segment that its key holds, from its beginning.
WORDS, KEYED = 4, 24
#: Letters after which the distance looks whether any diagonal is left, and of the beginnings that are compared first.
EARLY, BEGINNING = 16, 32
#: Letters of the beginnings and ends that pairs of crowded segments are compared by before they leave the join; shorter lines are compared whole.
HELD = 1024
BLANKS = " \t\r\x0b\x0c"


def _segment(n: Column, i: int | Column, parts: int | Column) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i (from 1) of a line of length n: the later ones take the remainder."""
    base, rest = F.floor(n / parts), n % parts
    longer = F.greatest(F.lit(0), rest - (parts - i + 1))
    return base * (i - 1) + longer + 1, base + (rest >= parts - i + 1).cast("int")


def _key(line: Column, length: Column, i: int | Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length, i if isinstance(i, Column) else F.lit(i), F.substring(line, start.cast("int"), size.cast("int")))


def segment_keys(line: Column, n: Column, max_edits: int) -> tuple[list[Column], list[Column]]:
    """Keys that a line puts into the index, and those that it probes (lines as long as itself, by other places, and shorter ones)."""
    parts = max_edits + 1
    own = [_key(line, n, i, *_segment(n, i, parts)) for i in range(1, parts + 1)]
    probes = []
    for less in range(max_edits + 1):
        for i in range(1, parts + 1):
            start, size = _segment(n - less, i, parts)
            low, high = max(1 - i, less - (parts - i)), min(i - 1, less + parts - i)
            probes += [_key(line, n - less, i, start + shift, size) for shift in range(low, high + 1) if less or shift]
    return own, probes


def _places(max_edits: int) -> list[tuple[int, int, int, int]]:
    """edits, i, less, shift of every key of a line: its segments (less and shift zero) and its probes, for each number of edits up to ``max_edits``."""
    out = []
    for edits in range(1, max_edits + 1):
        for less in range(edits + 1):
            for i in range(1, edits + 2):
                low, high = max(1 - i, less - (edits + 1 - i)), min(i - 1, less + edits + 1 - i)
                out += [(edits, i, less, shift) for shift in range(low, high + 1)]
    return out


def _entries(lines: DataFrame, max_edits: int, per_edit: int) -> DataFrame:
    """h1, h2, edits, i, less, shift, own, k: the index entries and probes of lines (h1, h2, line, n).

    The length of the indexed line decides how many edits it allows, and so its segments. The places are laid
    out as rows first, so that one short expression makes all keys: as a column each, they outgrow what Spark compiles.
    """
    places = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(p, ("edits", "i", "less", "shift"), strict=True)]) for p in _places(max_edits)])
    # four bytes a character, so that a place in a line needs no search for it
    laid = lines.select("h1", "h2", F.encode("line", "UTF-32").alias("line"), "n").select("h1", "h2", "line", "n", F.inline(places))
    allowed = F.greatest(F.lit(1), F.least(F.lit(max_edits), F.expr(f"(n - less) div {per_edit}")))
    start, size = _segment(F.col("n") - F.col("less"), F.col("i"), F.col("edits") + 1)
    # an unchanged segment has an unchanged beginning
    key = _key(F.col("line"), F.col("n") - F.col("less"), F.col("i"), (start + F.col("shift") - 1) * 4 + 1, F.least(size, F.lit(KEYED)) * 4)
    return laid.filter(F.col("edits") == allowed).select("h1", "h2", "edits", "i", "less", "shift", ((F.col("less") == 0) & (F.col("shift") == 0)).alias("own"), key.alias("k"))


def _each(values: Column, use) -> Column:
    """``use`` of every value, whatever further parameters it has."""
    return F.transform(values, lambda x: use(x))


def _finer(rows: DataFrame, max_edits: int) -> DataFrame:
    """k, own, id, less, begin, size: the entries (id, k, own, less, rest, m) of crowded segments, keyed by further segments of what lies outside theirs.

    ``rest`` is that part of the line and m its length in the indexed line, of which this one has ``less`` more. Two lines within
    ``max_edits`` that share a segment where the index says are so outside it too. A segment lies at ``begin`` of its line's rest.
    """
    parts = max_edits + 1
    made = []
    for j in range(1, parts + 1):
        begin, length = (x.cast("int") for x in _segment(F.col("m"), j, parts))

        def key(shift: Column, j: int = j, begin: Column = begin, length: Column = length) -> Column:
            place = (begin + shift).cast("int")
            return F.struct(F.xxhash64("k", F.lit(j), F.substring("rest", place, length)).alias("k"), (F.col("own") & (shift == 0)).alias("own"), place.alias("begin"), length.alias("size"))

        low, high = F.greatest(F.lit(1 - j), F.col("less") - (parts - j)), F.least(F.lit(j - 1), F.col("less") + parts - j)
        made.append(_each(F.sequence(low, high), key))
    return rows.select("id", "less", "rest", "m", F.explode(F.concat(*made)).alias("e")).select("e.k", "e.own", "id", "less", "rest", "m", "e.begin", "e.size")


def _outside(text: Column, begin: Column, size: Column) -> Column:
    """A text without ``size`` characters from ``begin`` (from 1) on."""
    return F.concat(F.substring(text, F.lit(1), begin - 1), F.substring(text, begin + size, F.char_length(text)))


def signature(line: Column) -> Column:
    """Four longs of 64 parities: how often the line holds letter pairs of each of 256 classes. An edit takes two pairs away and adds two at most, so it changes four bits."""

    def words(classes: Column) -> Column:
        def word(w: int) -> Column:
            def flip(bits: Column, x: Column) -> Column:
                bit = F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)))
                return F.when(F.shiftright(x, 6) == w, bits.bitwiseXOR(bit)).otherwise(bits)

            return F.aggregate(classes, F.lit(0).cast("long"), flip)

        return F.array(*[word(w) for w in range(WORDS)])

    def classes(letters: Column) -> Column:
        places = F.when(F.size(letters) > 1, F.sequence(F.lit(0), F.size(letters) - 2)).otherwise(F.array().cast("array<int>"))
        return let(F.transform(places, lambda i: F.xxhash64(F.get(letters, i), F.get(letters, i + 1)).bitwiseAND(F.lit(64 * WORDS - 1)).cast("int")), words)

    return let(F.split(line, ""), classes)


def differing(a: list[Column], b: list[Column]) -> Column:
    """Bits in which two signatures (their longs) differ."""
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)])


def shared_prefix(a: Column, b: Column, most: Column) -> Column:
    """Characters that a and b begin with alike, ``most`` at most: a search by halving steps."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])

    def within(most: Column) -> Column:
        def further(known: Column, step: Column) -> Column:
            longer = known + step
            return F.when((longer <= most) & (F.substring(a, F.lit(1), longer) == F.substring(b, F.lit(1), longer)), longer).otherwise(known)

        return F.aggregate(F.filter(steps, lambda step: step <= most), F.lit(0), further)

    return let(most, within)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used: Spark would repeat the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def within_edits(a: Column, b: Column, max_edits: int, allowed: Column | None = None) -> Column:
    """Whether two strings are at most ``max_edits`` edits apart (``allowed``, if given, which is no more): bit-parallel over the band of diagonals.

    Row e of the state is a word whose bit d + max_edits says that the first j + d characters of
    a and the first j of b are at most e edits apart. A character of b moves all diagonals of a
    row at once: the matching ones stay, and those of row e - 1 go on to e by one edit.
    """
    k = max_edits
    band = F.lit((1 << (2 * k + 1)) - 1).cast("long")
    start = F.array(*[F.lit(sum(1 << (d + k) for d in range(e + 1))).cast("long") for e in range(k + 1)])

    def through(letters: Column) -> Column:
        """The band moved along all of b; letters: those of a, in an array, since a place in a string has to be searched for."""
        mine, theirs = letters["a"], letters["b"]

        def advance(rows: Column, letter: Column) -> Column:
            # rows: the state, and the number of letters of b so far
            j, state = rows["j"], rows["state"]
            match = F.lit(0).cast("long")
            for d in range(-k, k + 1):
                match = match.bitwiseOR(F.when(F.get(mine, j + d) == letter, F.lit(1 << (d + k)).cast("long")).otherwise(F.lit(0).cast("long")))

            def row(e: int, known: list[Column], same: Column) -> Column:
                if e > k:
                    return F.array(*known)
                own = F.get(state, F.lit(e)).bitwiseAND(same)
                if e:
                    less = F.get(state, F.lit(e - 1))
                    own = own.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(known[-1], 1))
                return let(own.bitwiseAND(band), lambda x: row(e + 1, [*known, x], same))

            moved = let(match, lambda same: row(0, [], same))
            # with no diagonal left, what follows changes nothing
            return F.struct((j + 1).alias("j"), F.when(F.get(state, F.lit(k)) == 0, state).otherwise(moved).alias("state"))

        first = F.struct(F.lit(0).alias("j"), start.alias("state"))
        return F.get(F.aggregate(theirs, first, advance)["state"], F.lit(k) if allowed is None else allowed)

    n, m = F.char_length(a), F.char_length(b)
    ends = F.get(F.array(*[F.lit(1 << x).cast("long") for x in range(2 * k + 1)]), n - m + k)
    # an empty b has no character to advance by
    def after(letters: int | None) -> Column:
        """The row of the state after so many letters of b (all, if None)."""
        mine, theirs = (a, b) if letters is None else (F.substring(a, 1, letters + k), F.substring(b, 1, letters))
        return let(F.struct(F.split(mine, "").alias("a"), F.split(theirs, "").alias("b")), through)

    # most strings that are further apart leave the band at once, so the rest of them is not taken apart
    lost = (m > EARLY) & (after(EARLY) == 0)
    return F.when(F.abs(n - m) > k, F.lit(False)).when(m == 0, n <= (k if allowed is None else allowed)).when(lost, F.lit(False)).otherwise(after(None).bitwiseAND(ends) != 0)


def middles(a: Column, b: Column) -> Column:
    """What is left of a and b (fields a and b) when their common beginning and end are cut off."""

    def cut(x: Column) -> Column:
        left = F.least(F.char_length(a), F.char_length(b)) - x
        return let(
            let(F.struct(F.reverse(a).alias("a"), F.reverse(b).alias("b")), lambda r: shared_prefix(r["a"], r["b"], left)),
            lambda y: F.struct(F.substring(a, x + 1, F.char_length(a) - x - y).alias("a"), F.substring(b, x + 1, F.char_length(b) - x - y).alias("b")),
        )

    return let(shared_prefix(a, b, F.least(F.char_length(a), F.char_length(b))), cut)


def lines_of(docs: DataFrame, least: int, *more: Column) -> DataFrame:
    """row_a, row_b, doc_id, line_no, line, n: the lines of ``least`` characters or more, without blanks around them."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_a"), F.hash(F.col("text"), F.col("doc_id")).alias("row_b"), F.col("text").cast("string").alias("text"))
    split = keyed.select("row_a", "row_b", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    # a character set to trim by makes Spark take the line apart, so only lines that begin or end with a blank are trimmed
    edged = F.lit(False)
    for blank in BLANKS:
        edged = edged | F.col("raw").startswith(blank) | F.col("raw").endswith(blank)
    return split.withColumn("line", F.when(edged, F.btrim("raw", F.lit(BLANKS))).otherwise(F.col("raw"))).withColumn("n", F.char_length("line")).filter(F.col("n") >= least).select("row_a", "row_b", "doc_id", "line_no", "line", "n", *more)


def _id(h1: Column, h2: Column) -> Column:
    """The two hashes of a line as one text."""
    return F.concat(F.lpad(F.hex(h1), 16, "0"), F.lpad(F.hex(h2.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def _crowd_links(rows: DataFrame) -> DataFrame:
    """u, v for the lines (id, line, n) of crowded segments, one edit allowed: linear in the lines."""
    line, n = F.col("line"), F.col("n")

    def blocks(length: Column, own: bool) -> Column:
        """Of a line cut as one of ``length`` is, all but each block: the end is counted from the line's own end."""
        parts = F.greatest(F.lit(BLOCKS), F.ceil(F.sqrt(length))).cast("int")

        def outside(b: Column) -> Column:
            start, end = (F.floor(length * x / parts).cast("int") for x in (b, b + 1))
            return F.struct(
                F.xxhash64(length, b, F.substring(line, F.lit(1), start), F.lit("|"), F.substring(line, n - (length - end) + 1, length - end)).alias("k"),
                start.alias("start"), (n - length + end).alias("end"), F.lit(own).alias("own"),
            )

        return F.transform(F.sequence(F.lit(0), parts - 1), outside)

    keyed = rows.select("id", "line", "n", F.explode(F.concat(blocks(n, True), blocks(n - 1, False))).alias("b")).select("id", "line", "n", "b.own", "b.k", "b.start", "b.end")
    several = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.count_if("own").alias("o")).filter((F.col("c") > 1) & (F.col("o") > 0)).select("k")
    inner = keyed.join(several, "k", "left_semi")
    spots = F.sequence(F.col("start") + 1, F.col("end"))
    without = F.concat(F.substring(line, F.lit(1), F.col("at") - 1), F.substring(line, F.col("at") + 1, n))
    # lines of one length that agree but for the character at one place
    replaced = inner.filter("own").select("id", "line", "n", F.explode(spots).alias("at")).distinct().select("id", F.xxhash64(n, "at", without).alias("k"), F.hash(without).alias("k2"))
    least = replaced.groupBy("k", "k2").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    links = replaced.join(least, ["k", "k2"]).select(F.col("id").alias("u"), "v")
    # lines that become another by losing one character
    shorter = inner.filter(~F.col("own")).select("id", "line", "n", F.explode(spots).alias("at")).distinct().select(F.col("id").alias("u"), F.xxhash64(without).alias("h1"), F.hash(without).alias("h2"))
    whole = inner.filter("own").select("id", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2")).distinct()
    return links.union(shorter.join(whole, ["h1", "h2"]).select("u", F.col("id").alias("v"))).filter("u != v")


def _wide_links(shared: DataFrame, texts: DataFrame, verified, max_edits: int, crowd: int) -> DataFrame:
    """u, v for the entries (k, edits, i, less, shift, own, c, id) of shared segments, several edits allowed; pairs are those that ``verified`` keeps.

    A segment of ``crowd`` lines or fewer makes their pairs, so a line makes no more than that for each of its keys. The lines of others
    are linked through keys first, before any pairs are made: of lines that this has linked, none are. Of other lines of crowded segments, pairs whose
    signatures differ in more than four bits an edit never leave the join, nor do those whose lines (up to ``HELD`` letters; of longer ones the beginnings
    or ends) are too many edits apart: signatures alone let through lines that differ by a run of letters each.
    """

    def paired(entries: DataFrame) -> DataFrame:
        """Pairs of entries (k, own, id, root) of unlike roots."""
        a, b = (entries.filter(on).select("k", "own", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "root")]) for on, side in (("own", "u"), ("true", "v")))
        order = (F.col("id_u") < F.col("id_v")) | (~b["own"] & (F.col("id_u") != F.col("id_v")))
        return a.drop("own").join(b, (a["k"] == b["k"]) & (F.col("root_u") != F.col("root_v")) & order).select(F.col("id_u").alias("u"), F.col("id_v").alias("v"))

    signs = [f"s{w}" for w in range(WORDS)]

    def alike(entries: DataFrame) -> DataFrame:
        """Pairs of entries (k, own, id, root, the signature, n, begins and ends) of unlike roots whose signatures and letters allow so many edits."""
        a, b = (entries.filter(on).select("k", "own", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "root", "n", "begins", "ends", *signs)]) for on, side in (("own", "u"), ("true", "v")))
        # beginnings (or ends) of equal length are at most twice as many edits apart as the whole
        within = lambda c, edits: F.levenshtein(f"{c}_u", f"{c}_v", edits) >= 0
        letters = F.when(F.greatest("n_u", "n_v") <= HELD, within("begins", max_edits)).otherwise(within("begins", 2 * max_edits) & within("ends", 2 * max_edits))
        near = (differing([F.col(f"{c}_u") for c in signs], [F.col(f"{c}_v") for c in signs]) <= 4 * max_edits) & letters
        order = (F.col("id_u") < F.col("id_v")) | (~b["own"] & (F.col("id_u") != F.col("id_v")))
        return a.drop("own").join(b, (a["k"] == b["k"]) & (F.col("root_u") != F.col("root_v")) & order & near).select(F.col("id_u").alias("u"), F.col("id_v").alias("v"))

    def starred(entries: DataFrame) -> DataFrame:
        """Each entry (k, own, id and the signature) with the least line of its segment, if their signatures allow so many edits."""
        least = entries.filter("own").groupBy("k").agg(F.min(F.struct("id", *signs)).alias("v"))
        near = differing([F.col(c) for c in signs], [F.col(f"v.{c}") for c in signs]) <= 4 * max_edits
        return entries.join(least, "k").filter((F.col("id") != F.col("v.id")) & near).select(F.col("id").alias("u"), F.col("v.id").alias("v"))

    many = shared.filter(F.col("c") > crowd)
    few = shared.filter(F.col("c") <= crowd).select("k", "own", "id")
    n, less = F.col("n"), F.col("less")
    start, size = _segment(n - less, F.col("i"), F.col("edits") + 1)
    last, rest = many.filter(F.col("c") <= SHARED).select("k", "own", "id"), many.filter(F.col("c") > SHARED)
    if many.isEmpty():
        return verified(paired(few.withColumn("root", F.col("id"))).distinct())
    crowded = rest.select("id", "k", "edits", "i", "less", "shift", "own").join(texts, "id").withColumns({"begin": (start + F.col("shift")).cast("int"), "size": F.least(size, F.lit(KEYED)).cast("int")})
    outside = crowded.select("id", "k", "own", "less", _outside(F.col("line"), F.col("begin"), F.col("size")).alias("rest"), (n - less - F.col("size")).alias("m"))
    for depth in range(2, DEPTH + 1):
        if rest.isEmpty():
            break
        level = stage(_finer(outside, max_edits), "finer")
        keys = level.groupBy("k").agg(F.count_distinct("id").alias("c"), F.count_if("own").alias("o")).filter("c > 1 AND o > 0").select("k", "c")
        met = stage(level.join(keys, "k"), "shared-finer")
        last = last.union((met.filter(F.col("c") <= SHARED) if depth < DEPTH else met).select("k", "own", "id"))
        rest = met.filter(F.col("c") > SHARED)
        outside = rest.select("id", "k", "own", "less", _outside(F.col("rest"), F.col("begin"), F.col("size")).alias("rest"), (F.col("m") - F.col("size")).alias("m"))
    everyone = texts.join(many.select("id").distinct(), "id", "left_semi")
    edges = [F.substring("line", 1, HELD).alias("begins"), F.when(n > HELD - max_edits, F.substring("line", -HELD, HELD)).alias("ends")]
    signed = stage(everyone.select("id", "n", *edges, signature(F.col("line")).alias("s")).select("id", "n", "begins", "ends", *[F.get("s", F.lit(w)).alias(c) for w, c in enumerate(signs)]), "signatures")
    finer = stage(last.distinct().join(signed.select("id", *signs), "id"), "finest")
    first = starred(finer).distinct()
    links = stage(verified(first), "first-links")
    # lines next to one line, or next to lines that are, are linked already
    beside = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy(F.col("u").alias("id")).agg(F.least("id", F.min("v")).alias("root"))
    further = beside.select(F.col("id").alias("root"), F.col("root").alias("next"))
    beside = stage(beside.join(further, "root").select("id", F.least("root", "next").alias("root")), "beside")
    known = guarded(beside, beside.count())
    rooted = lambda entries: entries.join(known, "id", "left").withColumn("root", F.coalesce("root", "id"))
    unlike = rooted(finer)
    mixed = unlike.groupBy("k").agg(F.count_if("own").alias("o"), F.min("root").alias("low"), F.max("root").alias("high")).filter("o > 0 AND low != high").select("k")
    crowds = unlike.join(mixed, "k", "left_semi").join(signed.select("id", "n", "begins", "ends"), "id")
    return links.union(verified(paired(rooted(few)).union(alike(crowds)).distinct()))


def repeated_lines(docs: DataFrame, max_edits: int = 1, least: int = LEAST, crowd: int = CROWD, exact: int | None = None, per_edit: int = 1) -> DataFrame:
    """row_a, row_b, gone: for each row with lines to remove, their numbers (from 0).

    Of the lines that are linked by equality and by near-copies, directly or through others, the
    first stays: that with the smallest doc_id (rows without one come last), and in it the first.
    Rows alike in id and text are treated alike. A pair's edits are also at most its shorter line's
    length over ``per_edit`` (one edit always is allowed). Lines of ``exact`` characters (``least``, if
    not given) up to ``least`` are linked by equality alone.
    """
    exact = least if exact is None else min(exact, least)
    own, probes = segment_keys(F.col("line"), F.col("n"), max_edits)
    keys = [k.alias(f"k{i}") for i, k in enumerate([*own, *probes])]
    wide = max_edits > 1
    hashes = [F.xxhash64("line").alias("h1"), F.hash("line").alias("h2")]
    lines = stage(lines_of(docs, exact, *hashes, *([] if wide else keys)).drop("line"), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_a", "row_b", "line_no")
    # many keys of each line are made of its text, once
    told = lines_of(docs, exact, *hashes) if wide else lines
    extra = [F.first("line").alias("line")] if wide else [F.min(f"k{i}").alias(f"k{i}") for i in range(len(keys))]
    distinct = stage(told.groupBy("h1", "h2", "n").agg(F.min(place).alias("first"), F.max(place).alias("last"), *extra), "distinct-lines")

    compared = distinct.filter(F.col("n") >= least) if exact < least else distinct
    if wide:
        entries = _entries(compared, max_edits, per_edit)
    else:
        index = F.array(*[F.struct(F.col(f"k{i}").alias("k"), F.lit(i < len(own)).alias("own")) for i in range(len(keys))])
        entries = compared.select("h1", "h2", F.explode(index).alias("e")).select("h1", "h2", "e.k", "e.own")
    met = entries.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.count_if("own").alias("o")).filter((F.col("c") > 1) & (F.col("o") > 0)).select("k", "c")
    met = stage(met, "segments")
    shared = stage(entries.join(guarded(met, met.count()), "k").withColumn("id", _id(F.col("h1"), F.col("h2"))), "shared")
    wanted = stage(shared.select("h1", "h2", "id").distinct(), "wanted")
    texts = stage(
        (distinct if wide else lines_of(docs, least, *hashes))
        .select("h1", "h2", "line", "n")
        .join(guarded(wanted, wanted.count()), ["h1", "h2"])
        .groupBy("id")
        .agg(F.first("line").alias("line"), F.first("n").alias("n")),
        "texts",
    )

    def near(a: Column, b: Column, m: Column) -> Column:
        allowed = F.least(F.char_length(a), F.char_length(b)) / per_edit
        decided = within_edits(m["a"], m["b"], max_edits, F.greatest(F.lit(1), F.least(F.lit(max_edits), F.floor(allowed).cast("int"))))
        return F.when(_apart(F.substring(m["a"], 1, BEGINNING), F.substring(m["b"], 1, BEGINNING)), F.lit(False)).otherwise(decided)

    def _apart(a: Column, b: Column) -> Column:
        """Beginnings (or ends) of equal length are at most twice as many edits apart as the whole; most pairs are told apart by them."""
        return F.levenshtein(a, b, 2 * max_edits) < 0

    def verified(pairs: DataFrame) -> DataFrame:
        held = pairs.join(texts.select(F.col("id").alias("u"), F.col("line").alias("a")), "u").join(texts.select(F.col("id").alias("v"), F.col("line").alias("b")), "v")
        ends = [_apart(F.substring("a", at, BEGINNING), F.substring("b", at, BEGINNING)) for at in (1, -BEGINNING)]
        held = held.filter(~ends[0]).filter(~ends[1])
        return held.filter(let(middles(F.col("a"), F.col("b")), lambda m: near(F.col("a"), F.col("b"), m))).select("u", "v")

    if wide:
        links = _wide_links(shared, texts, verified, max_edits, crowd)
    else:
        few = shared.filter(F.col("c") <= crowd)
        a, b = few.filter("own").select("k", F.col("id").alias("u")), few.select("k", "own", F.col("id").alias("v"))
        pairs = a.join(b, "k").filter((F.col("u") < F.col("v")) | (~F.col("own") & (F.col("u") != F.col("v")))).select("u", "v").distinct()
        many = shared.filter(F.col("c") > crowd).select("id").distinct()
        links = verified(pairs).union(_crowd_links(texts.join(many, "id", "left_semi")))
    roots = stage(components(links), "line-roots")
    groups = stage(wanted.join(roots.select(F.col("node").alias("id"), "root"), "id").select("h1", "h2", "root"), "line-groups")
    firsts = distinct.select("h1", "h2", "first", "last").join(guarded(groups, groups.count()), ["h1", "h2"], "left")
    firsts = firsts.filter(F.col("root").isNotNull() | (F.col("first") != F.col("last")))
    linked = firsts.filter(F.col("root").isNotNull())
    of_group = linked.groupBy("root").agg(F.min("first").alias("group_first"))
    final = (
        linked.join(of_group, "root").select("h1", "h2", F.col("group_first").alias("first")).union(firsts.filter(F.col("root").isNull()).select("h1", "h2", "first"))
    )
    final = stage(final, "firsts")
    gone = lines.join(guarded(final, final.count()), ["h1", "h2"]).filter(place != F.col("first"))
    return gone.groupBy("row_a", "row_b").agg(F.collect_set("line_no").alias("gone"))


def dedup_lines(docs: DataFrame, max_edits: int = 1, least: int = LEAST, crowd: int = CROWD, exact: int | None = None, per_edit: int = 1) -> DataFrame:
    """docs with the text's repeated lines removed, and n_lines and n_removed as further columns; one row for every input row.

    Lines are what newlines separate; blanks around them and lines of fewer than ``least``
    characters (empty ones too) are not compared, and stay; with ``exact``, shorter ones of so many
    characters or more go too if they are equal to another. Repeated rows lose the same lines; an empty
    table gives no rows; very long lines are compared whole. Kept lines keep their blanks and their order. A null text stays null with 0 lines. Columns n_lines and n_removed of docs are
    replaced; all others stay.
    """
    gone = settled(lambda: repeated_lines(docs, max_edits, least, crowd, exact, per_edit).select(F.col("row_a").alias("__row_a"), F.col("row_b").alias("__row_b"), F.col("gone").alias("__gone")), "gone")
    changed = guarded(gone.select("__row_a", "__row_b"), gone.count())
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs = docs.select(*quoted(names)).withColumns({"__a": F.xxhash64("doc_id", "text"), "__b": F.hash(F.col("text"), F.col("doc_id"))})
    on = (F.col("__a") == F.col("__row_a")) & (F.col("__b") == F.col("__row_b"))
    lines = F.split("text", "\n", -1)
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    same = docs.join(changed, on, "left_anti").select(*quoted(names), F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    kept = let(lines, lambda parts: F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    cut = docs.join(changed, on, "left_semi").join(gone, on).select(*[kept.alias(c) if c == "text" else F.col(q) for c, q in zip(names, quoted(names), strict=True)], n_lines.cast("long").alias("n_lines"), F.size("__gone").cast("long").alias("n_removed"))
    return same.unionByName(cut)
