import numpy as np

from asofmill.llm import simhash


def test_sets_of_the_similarity_share_a_key():
    random = np.random.default_rng(3)
    for n in [1, 2, 3, 4, 5, 9, 10, 31, 32, 33, 39, 40, 41, 63, 64, 65, 79, 80, 81, 127, 128, 160, 161, 500, 1000, 3000]:
        for _ in range(20):
            base = random.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            lost = int(random.integers(0, n // 9 + 1)) if n > 8 else 0
            added = int(((n - lost) / 0.8 - n) + 1e-9)  # union of the greatest size that leaves 0.8
            x, y = base[:n], np.concatenate((base[lost:n], base[n : n + max(0, added)]))
            assert simhash.jaccard(np.sort(x).tobytes(), np.sort(y).tobytes()) >= 0.8
            (a, unsure_a), (b, unsure_b) = simhash.set_keys(x, 0.8), simhash.set_keys(y, 0.8)
            assert unsure_a or unsure_b or np.intersect1d(a, b).size
            assert np.bitwise_count(np.frombuffer(simhash._parities(x), np.uint8) ^ np.frombuffer(simhash._parities(y), np.uint8)).sum() <= lost + max(0, added)


def test_sets_with_a_few_common_members_hardly_share_keys():
    """Long texts with a common passage: before, single members were keys, and 117 of the first 780 pairs shared one and were compared with both whole sets."""
    random = np.random.default_rng(4)
    for n, most in ((1400, 5), (3000, 5), (500, 10)):
        common = random.integers(0, 1 << 63, 6, dtype=np.uint64)
        keys = [simhash.set_keys(np.concatenate((common, random.integers(0, 1 << 63, n - 6, dtype=np.uint64))), 0.8)[0] for _ in range(40)]
        assert sum(np.intersect1d(a, b).size > 0 for i, a in enumerate(keys) for b in keys[:i]) <= most


def test_pairs_that_the_forest_leaves_out_are_linked(spark):
    """A forest that finds next to nothing: before, its candidates alone were links."""
    random = np.random.default_rng(5)
    texts = []
    for n in (6, 12, 40, 90, 300):
        for _ in range(6):
            words = [f"w{x}" for x in random.integers(0, 10**9, n)]
            texts += [" ".join(words), " ".join([*words[: n - 1], "other"] if n < 40 else [*words, *[f"v{x}" for x in random.integers(0, 10**9, n // 10)]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = dict(enumerate(simhash.shingle_sets(__import__("pyarrow").array(texts), 5)))
    wanted = {i: min(j for j in sets if simhash.jaccard(sets[i], sets[j]) >= 0.8) for i in sets}
    assert sum(i != j for i, j in wanted.items()) >= 18
    found = simhash.near_duplicates(docs, shingle=5, max_bits=0, size=4, repeats=False, forest=simhash.Forest(trees=1, bits=40), similarity=0.8)
    assert {r.doc_id: r.component_id for r in found.collect()} == wanted
