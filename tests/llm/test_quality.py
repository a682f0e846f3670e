"""Bradley-Terry scores: features of whole texts, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa

from asofmill.llm import quality

DOCS, LABELS = "doc_id long, text string, score string", "doc_id long, quality int, toxic int"


def corpus(n=400):
    chance = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(chance.choices("abcdefgh", k=chance.randrange(2, 8))) for _ in range(chance.randrange(8, 80))]
        good = chance.random() < 0.8
        text = " ".join(words).capitalize() + "." if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "clash"))
        labels.append((i, int(good), 0))
    return docs, labels


def test_features_of_batches_and_single_texts_agree():
    texts = ["", None, "A b b b\nc", "É" * 500, "x!! y!! X!!", " \t", "same same same"]
    together = quality.features(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], quality.features(pa.array([t], pa.string()))[0])
    assert not together[:2].any() and together.shape == (len(texts), quality.N_FEATURES)


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    odd = [(1000, None, None), (1001, "", None), (None, docs[0][1], None), (3, docs[3][1], "twice"), (1002, "good words here and " * 20_000, None)]
    more = [(None, 1, 0), (5000, 0, 0), (7, None, 0), (8, 3, 0), (9, labels[9][1], 1)]
    got = quality.classify(spark.createDataFrame(docs + odd, DOCS).repartition(3), spark.createDataFrame(labels + more, LABELS)).collect()
    assert len(got) == len(docs) + len(odd)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert next(r for r in got if r.doc_id is None).held_out is False


def test_labels_of_one_kind_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, None, None)], DOCS)
    for labels, predicted in (([], 1), ([(1, 1, 0), (2, 1, 0)], 1), ([(2, 0, 0)], 0)):
        got = quality.classify(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert [r.predicted for r in got] == [predicted] * 2
    assert quality.classify(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_ids_with_many_rows_are_learned_from_once(spark):
    docs, labels = corpus(60)
    many = [(i, t, None) for i, t, _ in docs for _ in range(5)] + [(0, None, None), (1, "another text", None)]
    rng = {i for i, *_ in docs if zlib.crc32(str(i).encode()) % 5}
    seen = []
    fitted = quality.fit
    quality.fit = lambda good, poor, *n: seen.append((len(good), len(poor))) or fitted(good, poor, *n, steps=5)
    try:
        quality.train(spark.createDataFrame(many, DOCS), spark.createDataFrame(labels, LABELS))
    finally:
        quality.fit = fitted
    good = sum(q for i, q, _ in labels if i in rng)
    assert seen == [(good, len(rng) - good)]


def brute_pairs_loss(weight, good, poor):
    return np.mean([np.log1p(np.exp(-(weight @ (a - b)))) for a in good for b in poor])


def test_fit_lowers_the_pairwise_loss_and_ranks_like_brute_force():
    random_ = np.random.default_rng(1)
    good, poor = random_.normal(0.5, 1, (40, quality.N_FEATURES)), random_.normal(-0.5, 1, (30, quality.N_FEATURES))
    model = quality.fit(good, poor, 40, 30)
    a, b = (np.clip((x - model.mean) / model.scale, -8, 8) for x in (good, poor))
    assert brute_pairs_loss(model.weight, a, b) < 0.1 < brute_pairs_loss(np.zeros(quality.N_FEATURES), a, b)
    worth = np.concatenate((a, b)) @ model.weight
    assert np.allclose(model.worth(np.concatenate((good, poor))), worth)
    assert np.mean((model.score(good) >= quality.CUT)) > 0.95 > 0.05 > np.mean((model.score(poor) >= quality.CUT))


def brute_features(text):
    """Some of the features, worked out byte by byte and word by word."""
    raw = text.encode()
    kinds = np.zeros(quality.N_KINDS)
    for x in raw:
        kinds[quality.KINDS[x]] += 1
    words = raw.split()
    return np.concatenate((np.sqrt(kinds / len(raw)), [np.log1p(len(raw)), np.log1p(len(words)), np.mean([len(w) for w in words]), len(set(words)) / len(words), max(words.count(w) for w in words) / len(words)]))


def test_features_against_brute_force():
    for text in ("A plain Sentence, with words. And words!", "x x x\ny", "É ß 12 AB! AB!"):
        got = quality.features(pa.array([text]))[0]
        own = got[quality.N_KINDS + quality.PAIRS :]
        want = brute_features(text)
        assert np.allclose(got[: quality.N_KINDS], want[: quality.N_KINDS])
        assert np.allclose([own[0], own[1], own[2], own[4], own[6] ** 2], want[quality.N_KINDS :])
