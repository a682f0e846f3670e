"""The recurrent network: gradients, held-out accuracy, whole texts, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from asofmill.llm import langid
from asofmill.llm.queries import op10_language_id

SCHEMA = "doc_id long, text string, lang string, score string"


def corpus(n=240):
    chance = random.Random(9)
    sets = {"xx": ["bra", "kel", "tos", "min"], "yy": ["ølø", "sjå", "ært", "øk"], "zz": ["ций", "дом", "нет", "ста"]}
    rows = []
    for i in range(n):
        lang = chance.choice(list(sets))
        rows.append((i, " ".join("".join(chance.choices(sets[lang], k=chance.randrange(1, 4))) for _ in range(chance.randrange(2, 60))), lang, "clash"))
    return rows


def test_gradients_match_finite_differences():
    random_ = np.random.default_rng(0)
    net = langid.ByteGru(3, hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    bytes_, labels, mask = random_.integers(0, 5, (6, 4)), random_.integers(0, 3, 4), np.ones((6, 4))
    mask[4:, 1] = 0
    _, grads = net.gradients(bytes_, labels, mask)
    for name in ("fz", "bUr", "fUc", "bo", "bias"):
        flat = net.p[name].reshape(-1)
        for at in range(0, min(9, flat.size), 4):
            kept = flat[at]
            flat[at] = kept + 1e-3
            up, _ = net.gradients(bytes_, labels, mask)
            flat[at] = kept - 1e-3
            down, _ = net.gradients(bytes_, labels, mask)
            flat[at] = kept
            assert abs((up - down) / 2e-3 - grads[name].reshape(-1)[at]) < 1e-3, name


def test_windows_cover_whole_texts():
    texts = ["", "a" * 63, "b" * 64, "c" * 65, "d" * 1000, None, "é"]
    data, begins = langid.joined_bytes(pa.array(texts))
    bytes_, inside, of = langid.cut_windows(data, begins)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert bytes_[:, of == i].T[inside[:, of == i].T].tobytes() == raw


def test_every_row_comes_back_and_held_out_rows_are_right(spark, tmp_path):
    rows = corpus()
    odd = [(1000, None, "xx", None), (1001, "", None, None), (1002, "123 !!", "yy", None), (None, "bra kel", "xx", None), (5, rows[5][1], rows[5][2], "twice"), (1003, "ций " * 30_000, None, None)]
    spark.createDataFrame(rows + odd, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op10_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == {"und"}
    assert next(r for r in got if r.doc_id == 1003).lang_pred == "zz"
    assert all(0 <= r.score <= 1 for r in got)


def test_any_number_of_languages(spark):
    docs = spark.createDataFrame([(i, f"text of {i}", f"l{i % 300:03}", "x") for i in range(600)], SCHEMA)
    names, model = langid.train(docs, F.lit(True), steps=2)
    assert names == [f"l{i:03}" for i in range(300)] and model is not None
    assert langid.identify(docs.select("text"), names, model).count() == 600


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None, "x"), (2, None, None, None)], SCHEMA)
    assert [r.lang_pred for r in langid.language_id(docs).collect()] == ["und", "und"]
    assert langid.language_id(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_forward(net, raw):
    """Probabilities of every byte, one byte at a time."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    logits = np.tile(p["bias"], (len(raw), 1))
    for d, order in (("f", range(len(raw))), ("b", range(len(raw) - 1, -1, -1))):
        h = np.zeros(len(p["fUz"]))
        for t in order:
            z = sigmoid(p[f"{d}z"][raw[t]] + h @ p[f"{d}Uz"])
            r = sigmoid(p[f"{d}r"][raw[t]] + h @ p[f"{d}Ur"])
            c = np.tanh(p[f"{d}c"][raw[t]] + (r * h) @ p[f"{d}Uc"])
            h = h + z * (c - h)
            logits[t] += h @ p[f"{d}o"]
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_pooled_probabilities_match_brute_force():
    net = langid.ByteGru(4, seed=3)
    texts = ["abc", "é" * 50, "x" * 64, "some words of more than sixty-four bytes, so that a second window is read", ""]
    got = langid.text_probabilities(net, pa.array(texts))
    for text, row in zip(texts, got):
        raw = text.encode()
        # a window's unused places are zero bytes, which the backward layer reads first
        positions = [brute_forward(net, raw[i : i + 64] + bytes(64 - len(raw[i : i + 64])))[: len(raw) - i][:64] for i in range(0, len(raw), 64)]
        want = np.concatenate(positions).mean(axis=0) if raw else np.zeros(4)
        assert np.allclose(row, want, atol=1e-5)


def test_ids_with_many_rows_are_learned_from_once(spark):
    docs = spark.createDataFrame([(i % 10, f"text of {i % 10}", "xx", "s") for i in range(200)], SCHEMA)
    assert len(langid.sample_windows(docs, F.lit(True))) == 10


def test_columns_named_like_the_results_are_replaced(spark):
    docs = spark.createDataFrame([(i, "bra kel tos " * 5, "xx", "old") for i in range(8)], SCHEMA).withColumn("lang_pred", F.lit("old"))
    got = langid.language_id(docs)
    assert sorted(got.columns) == sorted(["doc_id", "text", "lang", "score", "lang_pred"])
    assert {r.lang_pred for r in got.select("lang_pred", "score").collect()} == {"xx"}
    none = langid.identify(docs, [], None)
    assert sorted(none.columns) == sorted(got.columns) and {r.score for r in none.select("score").collect()} == {0.0}
