"""Posting lists against brute force: recall, exact scores, ties, odd vectors."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asofmill.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"
QUERY = "vec_id % 50 = 0"


def brute(rows, k=5, every=50):
    """rows: (id, vector), ids different; every so many-th id asks."""
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for i, key in enumerate(ids.tolist()):
        if key % every == 0:
            score = ann.cosines(np.broadcast_to(v[i], v.shape), v)
            order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
            out[key] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def frame_of(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None, "clash") for i, v in rows], SCHEMA).repartition(3)


def test_recall_and_exact_scores(spark):
    random = np.random.default_rng(0)
    centres = random.standard_normal((30, 24))
    rows = [(i, centres[i % 30] + 0.7 * random.standard_normal(24)) for i in range(3000)]
    want, got = brute(rows), answers(ann.nearest(frame_of(spark, rows), QUERY, list_size=64, probe_ratio=1.2))
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hit = np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 5 for q in want])
    assert hit >= 0.9
    exact = {q: dict(x) for q, x in ((q, [(j, s) for j, s in got[q]]) for q in got)}
    for q, found in want.items():
        for j, s in found:
            assert j not in exact[q] or math.isclose(exact[q][j], s, rel_tol=0, abs_tol=1e-15)


def test_all_lists_give_the_exact_answer_with_ties_and_a_crowd(spark):
    random = np.random.default_rng(1)
    same = random.standard_normal(8)
    rows = [(i, same * (1 + i % 2) if i % 3 == 0 else random.standard_normal(8)) for i in range(400)]
    got = answers(ann.nearest(frame_of(spark, rows), QUERY, list_size=32, probe_ratio=1e9, walk=10_000, part=16))
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in brute(rows).items()}


def test_many_queries_in_blocks(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.standard_normal(8)) for i in range(150)]
    got = answers(ann.nearest(frame_of(spark, rows), "vec_id >= 0", list_size=32, probe_ratio=1e9, walk=10_000, part=16))
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in brute(rows, every=1).items()}


@pytest.mark.parametrize("n", [1, 2, 4])
def test_few_candidates(spark, n):
    rows = [(i * 50, np.eye(4)[i] + 0.1) for i in range(n)]
    got = answers(ann.nearest(frame_of(spark, rows), QUERY))
    assert {q: len(x) for q, x in got.items()} == ({i * 50: n - 1 for i in range(n)} if n > 1 else {})


def test_queries_that_lists_leave_short_are_completed(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAST_PROBES", 1)
    random = np.random.default_rng(2)
    rows = [(i, random.standard_normal(6)) for i in range(200)]
    got = answers(ann.nearest(frame_of(spark, rows), QUERY, list_size=4, copy_ratio=1.0, probe_ratio=1.0))
    assert all(len(x) == 5 for x in got.values()) and set(got) == {0, 50, 100, 150}


def test_vectors_that_take_no_part(spark):
    good = [(i, np.arange(1, 5) * ((-1) ** i) + i) for i in range(0, 120, 10)]
    odd = [(200, None), (250, [0, 0, 0, 0]), (300, [1, 2, 3]), (350, [1, float("nan"), 1, 1]), (351, [1, float("inf"), 1, 1]), (None, [1, 1, 1, 1])]
    frame = frame_of(spark, good + odd).union(spark.createDataFrame([(400, [1.0, None, 1.0, 1.0], None)], SCHEMA))
    got = answers(ann.nearest(frame, QUERY))
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in brute(good).items()}


def test_empty_table(spark):
    assert ann.nearest(frame_of(spark, []), QUERY).count() == 0
    assert ann.nearest(frame_of(spark, [(1, None)]), QUERY).count() == 0


def test_repeated_ids_are_candidates_of_their_own(spark):
    rows = [(1, [1.0, 0.1]), (1, [0.0, 1.0]), (50, [1.0, 0.0]), (50, [0.0, 2.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in ann.nearest(frame_of(spark, rows), QUERY, k=3).collect())
    near, half = round(1 / np.sqrt(1.01), 6), round(np.sqrt(0.5), 6)
    assert got == sorted([(50, 1, 1, near), (50, 2, 7, half), (50, 3, 7, half), (50, 1, 1, 1.0), (50, 2, 7, half), (50, 3, 7, half)])


def test_extreme_magnitudes(spark):
    random = np.random.default_rng(4)
    plain = [(i, random.standard_normal(6)) for i in range(60)]
    wild = [(i, [float(x) * (1e200, 1e-200, 1e300, 1e-300)[i % 4] for x in v]) for i, v in plain]
    schema = "vec_id long, embedding array<double>"
    get = lambda rows: answers(ann.nearest(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], schema), QUERY, probe_ratio=1e9))
    want, got = get(plain), get(wild)
    assert {q: [j for j, _ in x] for q, x in got.items()} == {q: [j for j, _ in x] for q, x in want.items()}
    assert all(math.isclose(a[1], b[1], abs_tol=1e-12) for q in got for a, b in zip(got[q], want[q]))


def shares(spark, v, **more):
    """Recall of the operator, and the share of all vectors that a query scores."""
    posted, seen = [], ann.stage

    def watching(frame, name):
        made = seen(frame, name)
        if name in ("postings", "probes"):
            posted.append(made)
        return made

    ann.stage = watching
    try:
        frame = spark.createDataFrame(pa.table({"vec_id": pa.array(range(len(v)), pa.int64()), "embedding": pa.array(list(v.astype(np.float32)), pa.list_(pa.float32()))})).repartition(4)
        got = answers(ann.nearest(frame, QUERY, **more))
    finally:
        ann.stage = seen
    held, probes = posted
    sizes = held.groupBy("list").agg(F.count_distinct("row").alias("n"))
    scored = probes.join(sizes, "list").groupBy("row").agg(F.sum("n").alias("n")).agg(F.avg("n")).first()[0] / len(v)
    u = ann.unit(v.astype(np.float32).astype(np.float64))
    asked = np.arange(0, len(v), 50)
    hit = 0
    for i in asked:
        close = u @ u[i]
        close[i] = -3
        hit += len(set(np.argpartition(-close, 5)[:5].tolist()) & {j for j, _ in got[i]})
    return hit / (5 * len(asked)), scored


@pytest.mark.parametrize("n,spread,most", [(6_000, 0.25, 0.3), (6_000, None, 1.05), (36_000, None, 0.95)])
def test_recall_does_not_fall_with_the_size(spark, n, spread, most):
    """Through the operator, on clustered vectors and on ones without any clusters, at sizes six times apart."""
    random = np.random.default_rng(6)
    v = random.standard_normal((n, 64))
    if spread is not None:
        v = random.standard_normal((60, 64))[np.arange(n) % 60] + spread * v
    recall, scored = shares(spark, v)
    assert recall >= 0.93 and scored < most, (recall, scored)


def test_exact_mode_finds_all(spark):
    v = np.random.default_rng(9).standard_normal((1500, 16))
    assert shares(spark, v, exact=True, list_size=32)[0] == 1.0


def test_query_as_registered(spark):
    import duckdb

    from asofmill.llm.queries import op1_ann

    t = duckdb.sql("select vec_id, embedding from '/root/testdata/sf0.001/embeddings.parquet'").fetchall()
    want, got = brute(t), answers(op1_ann(spark, "/root/testdata/sf0.001"))
    assert set(got) == set(want)
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 5 for q in want]) >= 0.9
    assert all(math.isclose(s, dict(want[q])[j], abs_tol=1e-15) for q in want for j, s in got[q] if j in dict(want[q]))
