"""The mix against a plain restatement."""

import hashlib
import random
import re

import pytest

from asofmill.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, hash string"


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: source -> words; shares are dealt again and again until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        dealt = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s: most * sizes[s] for s in rest if dealt[s] > most * sizes[s]}
        if not over:
            return dealt | full
        full |= over


def rows_of(seed=1, n=400):
    chance = random.Random(seed)
    rows = [(i, " ".join("w" * chance.randrange(1, 5) for _ in range(chance.randrange(0, 60))), chance.choice(["a"] * 30 + ["b"] * 4 + ["B", "é", None, "c"]), "x", "y") for i in range(n)]
    return rows + [(1000, None, "a", None, None), (1001, "", "nothing", None, None), (None, "no id here", "b", None, None), (3, rows[3][1], rows[3][2], None, None), (1002, "long \x0b\t " * 20_000, "a", None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_matches_brute_force(spark, seed):
    rows = rows_of(seed)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows)
    size = [len(re.findall(r"[^\x20\x09-\x0d]+", r[1] or "")) for r in rows]
    per = {}
    for r, n in zip(rows, size):
        per[r[2]] = per.get(r[2], 0) + n
    goal = brute_targets(per)
    want = []
    for s in per:
        own = [(hashlib.md5((str(r[0]) if r[0] is not None else "t" + r[1]).encode()).hexdigest()[:15], n, r[0]) for r, n in zip(rows, size) if r[2] == s]
        whole = int(goal[s] // per[s]) if per[s] else 0
        left = goal[s] - whole * per[s]
        for h, n, d in own:
            more = per[s] > 0 and left > 0 and sum(m for g, m, _ in own if g <= h) <= left
            want.append((d, n, per[s], round(goal[s], 6), (whole + more) * n))
    assert sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"] for r in got)


def test_take_keeps_columns_and_rows(spark):
    frame = spark.createDataFrame(rows_of(), SCHEMA)
    taken = mixing.take(frame)
    assert taken.columns == [*frame.columns, "copies"]
    want = {r.doc_id: r.copies for r in mixing.mix(frame).collect() if r.copies}
    assert {r.doc_id: r.copies for r in taken.collect()} == want


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0 and mixing.take(spark.createDataFrame([], SCHEMA)).count() == 0
