"""Repeated windows against brute force."""

import hashlib
import random

import pytest

from asofmill.llm import substring
from asofmill.llm.queries import op8_substring

SCHEMA = "doc_id long, text string, row_a string, kept string"


def brute(rows, window):
    from collections import Counter

    words = [(text or "").encode().split() for _, text in rows]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=repr)


def corpus():
    chance = random.Random(3)
    word = lambda: chance.choice(["a", "b", "é", "dd", "eee", "Ff", "ñg", "h,"]) + str(chance.randrange(400))
    passage = [word() for _ in range(90)]
    rows = []
    for i in range(60):
        own = [word() for _ in range(chance.randrange(0, 160))]
        if i % 3 == 0:
            a = chance.randrange(0, 40)
            at = chance.randrange(0, len(own) + 1)
            own[at:at] = passage[a : a + chance.randrange(20, 60)]
        if i % 10 == 1:
            own = own + own[-50:]
        rows.append((i, chance.choice([" ", "\n", " \t\x0b"]).join(own)))
    rows += [(70, None), (71, ""), (72, " \n "), (73, "x"), (74, rows[4][1]), (4, rows[4][1]), (None, rows[6][1]), (None, "only me " * 3), (80, "z " * 3000), (81, "  not blank")]
    return rows


@pytest.mark.parametrize("window", [35, 5, 1])
def test_matches_brute_force(spark, window):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "clash", None) for r in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in substring.remove_repeats(docs, window).collect()), key=repr)
    assert got == brute(rows, window)


def test_without_broadcast(spark, monkeypatch):
    import asofmill.llm.common as common

    monkeypatch.setattr(substring, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(substring, "guarded", lambda small, rows, most=0: common.guarded(small, rows, 0))
    rows = corpus()
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert sorted((tuple(r) for r in substring.remove_repeats(docs, 35).collect()), key=repr) == brute(rows, 35)


def test_covers_are_difference_covers():
    for period, cover in substring.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_empty_table(spark):
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_on_a_written_table(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op8_substring(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(((d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute(rows, 35)), key=repr)


@pytest.mark.parametrize("slice_,seen", [(64, 1 << 20), (256, 100)])
def test_many_slices_in_one_task(spark, monkeypatch, slice_, seen):
    monkeypatch.setattr(substring, "SLICE", slice_)
    monkeypatch.setattr(substring, "SEEN", seen)
    rows = corpus()
    for parts in (1, 3):
        docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).coalesce(1).repartition(parts)
        assert sorted((tuple(r) for r in substring.remove_repeats(docs, 35).collect()), key=repr) == brute(rows, 35)


def test_a_common_passage_sends_two_rows_of_each_key_from_a_task():
    import numpy as np

    settled, sent = substring.Settled(), []
    for _ in range(50):
        key, flag = settled.flags(np.array([5, 5, 7, 9], np.uint64))
        sent.append((key[flag < 2], flag))
    own = np.concatenate([k for k, _ in sent])
    assert {k: int((own == k).sum()) for k in (5, 7, 9)} == {5: 1, 7: 2, 9: 2}
    assert all((f == 2).all() for _, f in sent[2:])
