"""Hard negatives by blocks against every score in Python integers."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asofmill.llm import mining
from asofmill.llm.integer_vectors import most_component

SCHEMA = "vec_id long, embedding array<double>, label long, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "clash") for i, v, y in rows], SCHEMA).repartition(3)


def brute(rows, every, width, positives=5, negatives=5):
    """The answer's rows, sorted; rows: (id, vector, label)."""
    kept = [(i, [int(np.floor(256 * x)) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (anchor, q, label) in enumerate(kept):
        if anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, other, strict=True)), i, j) for j, (i, other, _) in enumerate(kept)]
        for minus, positive, j in sorted(s for s in scores if s[2] != a and kept[s[2]][2] == label)[:positives]:
            inside = [s for s in scores if kept[s[2]][2] != label and 80 * -minus <= 100 * -s[0] <= 100 * -minus]
            out += [(anchor, positive, n + 1, i, -minus, -m) for n, (m, i, _) in enumerate(sorted(inside)[:negatives])]
    return sorted(out)


def mined(spark, rows, every, **more):
    return sorted(tuple(r) for r in mining.hard_negatives(frame(spark, rows), f"vec_id % {every} = 0", **more).collect())


def test_against_every_score_in_many_blocks(spark):
    random = np.random.default_rng(0)
    rows = [(i, (random.standard_normal(20) + (i % 4)).tolist(), i % 4) for i in range(400)]
    want = brute(rows, 10, 20)
    assert len(want) > 200
    assert mined(spark, rows, 10, rows_in_block=64, anchors_in_block=8, dims=7) == want
    assert mined(spark, rows, 10) == want


def test_ties_copies_and_a_hot_label(spark):
    rows = [(i, [float(i % 2), 1.0, float(i % 3)], 0 if i % 3 else 1 + i % 2) for i in range(150)]
    rows += [(10, [1.0, 1.0, 1.0], 0), (10, [1.0, 1.0, 1.0], 0), (11, [1.0, 1.0, 1.0], 1)]
    assert mined(spark, rows, 10, rows_in_block=16, anchors_in_block=4, dims=2) == brute(rows, 10, 3)


def test_rows_that_take_no_part_and_negative_scores(spark):
    rows = [(i, [-1.0 if i else 1.0, 0.5], i % 2) for i in range(12)]
    rows += [(None, [1.0, 1.0], 0), (20, None, 0), (30, [1.0, None], 0), (40, [float("nan"), 1.0], 1), (50, [1.0, 1.0], None), (60, [1.0], 1), (70, [float("inf"), 1.0], 1)]
    assert mined(spark, rows, 10) == brute(rows, 10, 2)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 0)], [(0, [1.0], 0)], [(0, [1.0], 0), (1, [1.0], 0)], [(0, [1.0], 0), (1, [1.0], 1)], [(0, [0.0], 0), (1, [0.0], 0), (2, [0.0], 1)]])
def test_few_rows(spark, rows):
    assert mined(spark, rows, 10) == brute(rows, 10, 1)


def test_largest_components(spark):
    x = most_component(4) / 256
    rows = [(i, [x, -x, x * (0.8 + i / 50), x], i % 2) for i in range(10)] + [(99, [1e200, 0.0, 0.0, 0.0], 0)]
    assert mined(spark, rows, 10) == brute(rows[:-1], 10, 4)


@settings(max_examples=200, deadline=None)
@given(st.integers(-(1 << 58), 1 << 58), st.integers(0, 100))
def test_share_of_a_score(score, part):
    low, high = mining.share(np.array([score]), part, 100, True)[0], mining.share(np.array([score]), part, 100, False)[0]
    assert (100 * int(low) >= part * score > 100 * (int(low) - 1)) and (100 * int(high) <= part * score < 100 * (int(high) + 1))


def test_products_beyond_doubles_are_exact():
    a, b = np.array([[(1 << 28) - 1, 3]]), np.array([[(1 << 28) - 3, 1], [1, 1]])
    assert mining.product(a, b).tolist() == [[((1 << 28) - 1) * ((1 << 28) - 3) + 3, (1 << 28) + 2]]


def test_scores_are_not_written(spark, monkeypatch):
    """20,000 rows x 2,000 anchors: what is staged stays far under a byte a score (tiles of the whole product took eight)."""
    sizes = {}

    def staged(df, name, *more):
        out = kept(df, name, *more)
        sizes[name] = sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    kept = mining.stage
    monkeypatch.setattr(mining, "stage", staged)
    rows = spark.range(20_000).select(F.col("id").alias("vec_id"), F.array(*[F.randn(i) for i in range(8)]).alias("embedding"), (F.col("id") % 4).alias("label"))
    assert mining.hard_negatives(rows, "vec_id % 10 = 0").count() > 1000
    assert 0 < sum(sizes.values()) < 20_000 * 2_000 / 4


@pytest.mark.parametrize("spread", [0, 1, 3, 40])
def test_tiles_with_many_equal_or_many_fitting_scores(spark, spread):
    """Labels of more and of fewer rows than a tile, alike vectors, and positives far below most other scores."""
    random = np.random.default_rng(spread)
    rows = [(i, [1.0, *random.integers(-spread, spread + 1, 2).astype(float).tolist()], 0 if i % 97 == 0 else i % 3 + (i > 900) * (i % 40)) for i in random.permutation(1000).tolist()]
    want = brute(rows, 50, 3)
    assert want
    assert mined(spark, rows, 50, rows_in_block=128, anchors_in_block=4) == want
    assert mined(spark, rows, 50) == want


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 300), st.sampled_from([1, 3, 1000]), st.sampled_from([np.float32, np.float64, np.int64]), st.integers(0, 1 << 30))
def test_best_in_windows_of_tiles_against_sorting(columns, spread, kind, seed):
    random = np.random.default_rng(seed)
    score = random.integers(-spread, spread + 1, (3, columns))
    low, high = np.sort(random.integers(-spread - 1, spread + 2, (2, 3, 2)), axis=0)
    allowed = random.random((3, columns)) < 0.8 if seed % 2 else None
    best = mining.Best(6, 2)
    for at in range(0, columns, 100):
        own = None if allowed is None else allowed[:, at : at + 100]
        i, j, w = mining.in_windows(score[:, at : at + 100].astype(kind), low.astype(kind), high.astype(kind), 2, own)
        best.add(i * 2 + w, score[i, at + j], at + j, at + j)
    for i in range(3):
        for w in range(2):
            want = sorted((-s, j) for j, s in enumerate(score[i].tolist()) if low[i, w] <= s <= high[i, w] and (allowed is None or allowed[i, j]))[:2]
            found = best.score[i * 2 + w] > mining._LEAST
            assert [(-s, j) for s, j in zip(best.score[i * 2 + w][found].tolist(), best.id[i * 2 + w][found].tolist(), strict=True)] == want


def test_numbers_hold_the_sums():
    assert [mining.kind_for(a, a) for a in ((1 << 24) - 1, 1 << 24, (1 << 53) - 1, 1 << 53)] == [np.float32, np.float64, np.float64, np.int64]
    a = np.array([[4095, 1], [-4095, 90]])
    assert mining.product(a, a).tolist() == (a @ a.T).tolist() and mining.product(a, a, dims=1).tolist() == (a @ a.T).tolist()


@pytest.mark.parametrize("spread", [1, 40])
def test_segments_that_come_first_change_nothing(spark, monkeypatch, spread):
    monkeypatch.setattr(mining, "SCOUTED", 2)
    random = np.random.default_rng(spread)
    rows = [(i, random.integers(-spread, spread + 1, 3).astype(float).tolist(), i % 3) for i in random.permutation(600).tolist()]
    want = brute(rows, 20, 3)
    assert want
    assert mined(spark, rows, 20, rows_in_block=16, anchors_in_block=2) == want
