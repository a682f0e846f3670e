"""SimHash groups against brute force, for every way to slice the fingerprint."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from asofmill.llm import simhash


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(prints, max_bits=4):
    """prints: (id, fingerprint) rows; the smallest id reachable from each row."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(prints))]


SCHEMA = "doc_id long, text string, fp string, group string"


def docs_of(spark):
    words = [f"w{i}" for i in range(300)]
    base = " ".join(words)
    texts = [base, base.replace("w7 ", "x7 "), base.replace("w280", "y"), base.upper(), None, "", " \t\n", "one two", "One  two", "one three", "é" * 20_000]
    rows = [(i, t, "clash", None) for i, t in enumerate(texts)]
    return rows + [(None, base, None, None), (None, "alone here", None, None), (3, base.upper(), "clash", None), (50, "q " * 40_000, None, None)]


@pytest.mark.parametrize("slices", [2, 3, 5])
def test_groups_match_brute_force(spark, slices):
    rows = docs_of(spark)
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), slices=slices).collect()
    prints = [(r[0], brute_fingerprint(r[1])) for r in rows]
    want = sorted(((p[0], p[1], c) for p, c in zip(prints, brute_groups(prints))), key=repr)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == want


@pytest.mark.parametrize("slices,crowd,most", [(2, 4096, 4096), (3, 4096, 4096), (4, 4096, 4096), (5, 4096, 4), (3, 8, 4096), (3, 8, 4), (4, 4, 1)])
def test_links_of_random_fingerprints(spark, monkeypatch, slices, crowd, most):
    monkeypatch.setattr(simhash, "MOST_LEAVES", most)
    random = np.random.default_rng(5)
    values = set()
    for centre in random.integers(0, 1 << 63, 60).tolist():
        for _ in range(12):
            x = centre
            for bit in random.integers(0, 64, random.integers(0, 5)).tolist():
                x ^= 1 << bit
            values.add(x)
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 4, slices=slices, leaf=16, sample=256, crowd=crowd).collect()
    for u, v in links:
        assert ((u ^ v) % (1 << 64)).bit_count() <= 4
    parent = {s[0]: s[0] for s in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        parent[find(u)] = find(v)
    want = brute_groups(list(zip(range(len(values)), values)))
    groups = {}
    for s, w in zip(signed, want):
        groups.setdefault(find(s[0]), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    docs = spark.createDataFrame(docs_of(spark), SCHEMA)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [0, 4, 7, 9, 10, 50]
    assert [r.text for r in rows if r.doc_id is None] == ["alone here"]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_fingerprint_is_spark_xxhash(spark):
    text = "Alpha beta gamma delta"
    native = spark.createDataFrame([(text.lower(),)], "t string").select(F.xxhash64("t")).first()[0]
    assert int(simhash.fingerprint(text, 4)[0]) == native % (1 << 64)


def test_wide_fingerprints_find_near_copies(spark):
    import random

    chance = random.Random(6)
    word = lambda: "".join(chance.choices("abcdefghij", k=4))
    bases = [[word() for _ in range(200)] for _ in range(40)]
    rows, group = [], {}
    for i, base in enumerate(bases):
        for j in range(4):
            own = list(base)
            for at in chance.sample(range(200), 3 * bool(j)):  # three words of 200: about 0.86 of the shingles stay
                own[at] = word()
            rows.append((10 * i + j, " ".join(own), None, None))
            group[10 * i + j] = 10 * i
    rows += [(1000 + i, " ".join(word() for _ in range(chance.randrange(1, 9))), None, None) for i in range(60)]
    how = dict(shingle=5, max_bits=56, size=4, repeats=False, forest=simhash.Forest(10, 14), similarity=0.8)
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), **how).collect()
    assert all(r.component_id == r.doc_id for r in got if r.doc_id >= 1000)
    right = sum(r.component_id == group[r.doc_id] for r in got if r.doc_id < 1000)
    assert right >= 0.95 * len(group)
    assert len(simhash.keep_one(spark.createDataFrame(rows, SCHEMA), **how).collect()) <= 60 + len(bases) + 8


def brute_jaccard(a, b, shingle=5):
    x, y = ({tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set() for w in (t.lower().split() for t in (a, b)))
    return len(x & y) / len(x | y) if x | y else 1.0


def test_shingle_sets_and_jaccard():
    import pyarrow as pa

    texts = ["a b c d e f g", "A b c D e f g h", "a b", "", None, "x y z x y z x y z", "a\nb", "é b c d e"]
    sets = simhash.shingle_sets(pa.array(texts), 5)
    for a, x in zip(texts, sets):
        for b, y in zip(texts, sets):
            assert simhash.jaccard(x, y) == pytest.approx(brute_jaccard(a or "", b or ""))


def test_links_are_of_the_similarity_asked_for(spark):
    """Chains of copies that move away from each other: what is kept apart or joined is as brute force over all pairs says."""
    import random

    chance = random.Random(12)
    word = lambda: "".join(chance.choices("abcdefghij", k=5))
    texts = []
    for changes in (1, 2, 3, 4, 6):
        for _ in range(12):
            own = [word() for _ in range(150)]
            for _ in range(5):
                texts.append(" ".join(own))
                own = list(own)
                for at in chance.sample(range(150), changes):
                    own[at] = word()
    got = simhash.near_duplicates(spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA), shingle=5, max_bits=56, size=4, repeats=False, forest=simhash.Forest(10, 14), similarity=0.8)
    got = {r.doc_id: r.component_id for r in got.collect()}
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = [(i, j) for i in range(len(texts)) for j in range(max(0, i - 5), i) if brute_jaccard(texts[i], texts[j]) >= 0.8]
    for i, j in pairs:
        parent[max(find(i), find(j))] = min(find(i), find(j))
    assert len(pairs) > 100
    assert sum(got[i] == got[j] for i, j in pairs) >= 0.95 * len(pairs)
    assert all(find(i) == find(got[i]) for i in got)  # nothing else is joined


@pytest.mark.parametrize("rows", [4_000, 60_000])
def test_recall_of_the_forest_does_not_fall_with_the_table(spark, monkeypatch, rows):
    """Pairs at the rate of differing bits of similarity 0.8, among ever more others; all leaves are cut to their points."""
    monkeypatch.setattr(simhash, "MOST_LEAVES", 8)
    random = np.random.default_rng(rows)
    prints = random.integers(0, 1 << 63, (rows, 4), np.uint64) * np.uint64(2) + random.integers(0, 2, (rows, 4), np.uint64)
    pairs = 400
    flips = np.packbits(random.random((pairs, 256)) < 0.1515, axis=1).view(np.uint64)
    prints[pairs : 2 * pairs] = prints[:pairs] ^ flips
    frame = spark.createDataFrame([(bytes(x),) for x in prints], "fp binary").repartition(4)
    links = {frozenset((bytes(u), bytes(v))) for u, v in simhash.near_links(frame, 66, size=4, forest=simhash.Forest(10, 14), leaf=16).collect()}
    found = sum(frozenset((bytes(prints[i]), bytes(prints[pairs + i]))) in links for i in range(pairs))
    assert found >= 0.92 * pairs


def test_shards_stay_small_with_a_million_fingerprints():
    random = np.random.default_rng(3)
    values = random.integers(0, 1 << 62, 1_000_000, np.uint64) * np.uint64(4)
    leaves = min(simhash.MOST_LEAVES, -(-len(values) // simhash.LEAF))
    tree = simhash.VantageTree(values[: 8 * leaves], simhash.slice_masks(3)[1], leaves, 0)
    lives = np.bincount(tree.homes(values), minlength=tree.leaves)
    parts = np.where(lives > 4 * simhash.LEAF, -(-lives // simhash.LEAF), 1)
    at, of, part, home = tree.shards(values, 0, parts)
    assert home.all() and np.array_equal(np.sort(at), np.arange(len(values)))
    sizes = np.unique((of << 32) | part, return_counts=True)[1]
    assert sizes.max() <= 4 * simhash.LEAF
    at, of, part, home = tree.shards(values[:20_000], 1, parts)
    assert len(at) <= 22 * 20_000 and home.sum() == 20_000
    # every point of the ball is routed to where it lives
    seen = set(zip(at.tolist(), of.tolist(), part.tolist()))
    for flip in tree.ball(1).tolist():
        moved = values[:500] ^ np.uint64(flip)
        a, o, p, _ = tree.shards(moved, 0, parts)
        assert all(x in seen for x in zip(a.tolist(), o.tolist(), p.tolist()))
