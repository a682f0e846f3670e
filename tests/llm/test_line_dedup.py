"""Line dedup against brute force: pairs, crowds of near-copies, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from asofmill.llm import line_dedup as ld

SCHEMA = "doc_id long, text string, line string, n_removed long"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, edits, least):
    """rows: (doc_id, text), ids all set and different."""
    places = [(d, no, line.strip(ld.BLANKS)) for d, t in rows if t is not None for no, line in enumerate(t.split("\n"))]
    lines = sorted({x for *_, x in places if len(x) >= least})
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                parent[find(a)] = find(b)
    met, gone = set(), {}
    for d, no, x in sorted(places):
        if len(x) >= least:
            if find(x) in met:
                gone.setdefault(d, set()).add(no)
            met.add(find(x))
    out = []
    for d, t in rows:
        parts = t.split("\n") if t is not None else []
        out.append((d, "\n".join(p for i, p in enumerate(parts) if i not in gone.get(d, ())) if t is not None else None, len(parts), len(gone.get(d, ()))))
    return sorted(out)


def corpus(n=40, seed=1):
    chance = random.Random(seed)
    pool = ["".join(chance.choices("abcé ", k=chance.randrange(14, 40))) for _ in range(25)]

    def changed(line):
        for _ in range(chance.randrange(0, 3)):
            at = chance.randrange(len(line) + 1)
            line = line[:at] + chance.choice(["", "x", "é"]) + line[at + chance.randrange(2) :]
        return line

    rows = [(i, "\n".join(chance.choice([changed(chance.choice(pool)), chance.choice(["", "short", "  " + chance.choice(pool) + "\r"])]) for _ in range(chance.randrange(1, 9)))) for i in range(n)]
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, "one long line of text, " * 4000 + "."), (104, "one long line of text, " * 4000 + "!")]


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA).repartition(3)
    out = ld.dedup_lines(frame, **kw)
    assert out.columns == ["doc_id", "text", "line", "n_lines", "n_removed"]
    return sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect())


@pytest.mark.parametrize("edits,crowd", [(1, 64), (1, 2), (2, 64)])
def test_matches_brute_force(spark, edits, crowd):
    rows = [r for r in corpus() if edits == 1 or r[0] < 103]
    brute_rows = [r if r[0] < 103 else (r[0], r[1][:200] + r[1][-1:]) for r in rows]
    want = {r[0]: r for r in brute(brute_rows, edits, 12)}
    got = run(spark, rows, max_edits=edits, least=12, crowd=crowd)
    assert [(d, n, g) for d, _, n, g in got] == [(d, want[d][2], want[d][3]) for d, *_ in got]
    assert all(t == want[d][1] for d, t, *_ in got if d < 103)


def test_crowd_of_near_copies(spark):
    base = "the quick brown fox jumps over the lazy dog again"
    rows = [(i, base[:i] + "#" + base[i + 1 :]) for i in range(40)] + [(50 + i, base[:i] + base[i + 1 :]) for i in range(30)] + [(200, base.replace("fox", "cat")), (201, base.upper())]
    assert run(spark, rows, least=16, crowd=4) == brute(rows, 1, 16)


def test_bit_parallel_distance(spark):
    chance = random.Random(8)
    pairs = [("".join(chance.choices("ab", k=chance.randrange(0, 9))), "".join(chance.choices("ab", k=chance.randrange(0, 9)))) for _ in range(400)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    columns = [ld.within_edits(F.col("a"), F.col("b"), k).alias(f"k{k}") for k in (1, 2, 3)]
    for r in frame.select("a", "b", *columns, ld.middles(F.col("a"), F.col("b")).alias("m")).collect():
        assert (r.k1, r.k2, r.k3) == tuple(distance(r.a, r.b) <= k for k in (1, 2, 3)), (r.a, r.b)
        assert distance(r.m.a, r.m.b) == distance(r.a, r.b)


@pytest.mark.parametrize("crowd", [2, 64])
def test_three_edits_match_brute_force(spark, crowd):
    chance = random.Random(3)
    head, tail = "the same beginning of all ", " and an end"
    rows = [r for r in corpus(30) if r[0] < 103]
    rows += [(200 + i, head + "".join(chance.choices("abcd", k=6)) + tail) for i in range(25)] + [(300 + i, head + "".join(chance.choices("efghij", k=9)) + tail[chance.randrange(3) :]) for i in range(25)]
    assert run(spark, rows, max_edits=3, least=12, crowd=crowd) == brute(rows, 3, 12)


def test_edits_grow_with_the_line(spark):
    short, long = "twenty characters ok", "a line of more than forty-eight characters, all counted"
    rows = [(1, short), (2, short.replace("ok", "no")), (3, long), (4, long.replace("all", "not"))]
    assert [r[3] for r in run(spark, rows, max_edits=3, per_edit=16)] == [0, 0, 0, 1]


def test_exact_copies_of_short_lines_go_too(spark):
    line = "a line that is long enough"
    rows = [(1, "Les.\n\nx"), (2, " Les.\r\n\nLes,\n" + line), (3, "x\nLes.\n \n" + line[:-1] + "!"), (4, "Les.")]
    got = run(spark, rows, least=16, exact=1)
    assert got == [(1, "Les.\n\nx", 3, 0), (2, "\nLes,\n" + line, 4, 1), (3, " ", 4, 3), (4, "", 1, 1)]


def test_repeated_rows_and_null_ids(spark):
    line = "a line that is long enough"
    rows = [(1, line), (1, line), (None, line), (2, line + "\nand another line here"), (None, "alone, but long enough too")]
    got = ld.dedup_lines(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(1, line), (1, line), (None, ""), (2, "and another line here"), (None, "alone, but long enough too")], key=repr)


def test_empty_table_and_native_plan(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ld.dedup_lines(none).count() == 0
    plan = ld.repeated_lines(none)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_crowd_of_long_lines(spark):
    chance = random.Random(2)
    base = "".join(chance.choices("abcdefgh ", k=3000))
    rows = [(i, base[: 41 * i + 3] + "#" + base[41 * i + 3 + i % 2 :]) for i in range(30)] + [(60, base), (61, base[:-1]), (62, base[1:]), (63, base[:1500] + "##" + base[1500:])]
    got = run(spark, rows, least=16, crowd=4)
    assert [r[0] for r in got if not r[3]] == [0, 63]


def test_signatures_allow_every_edit(spark):
    chance = random.Random(5)
    pairs = []
    for _ in range(300):
        a = b = "".join(chance.choices("abcdé ", k=chance.randrange(0, 30)))
        for _ in range(3):
            at = chance.randrange(len(b) + 1)
            b = b[:at] + chance.choice(["", "x", "é"]) + b[at + chance.randrange(2) :]
        pairs.append((a, b))
    words = lambda c: [F.get(F.col(c), F.lit(w)) for w in range(ld.WORDS)]
    signed = spark.createDataFrame(pairs, "a string, b string").select("a", "b", ld.signature(F.col("a")).alias("x"), ld.signature(F.col("b")).alias("y"))
    for r in signed.select("a", "b", ld.differing(words("x"), words("y")).alias("bits")).collect():
        assert r.bits <= 4 * distance(r.a, r.b)


def boilerplate(n, middle, seed=4):
    chance = random.Random(seed)
    return [(i, "this line has a beginning that all of them share, " + "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=middle)) + " and then an end which is the same too") for i in range(n)]


@pytest.mark.parametrize("middle", [12])
def test_boilerplate_makes_no_pairs(spark, monkeypatch, middle):
    """Lines with a beginning and an end in common: what leaves the joins is a few rows a line (every pair of 2,000 would be 1,000 a line)."""
    made, own = [], ld._wide_links

    def counting(shared, texts, verified, max_edits, crowd):
        return own(shared, texts, lambda pairs: made.append(pairs.count()) or verified(pairs), max_edits, crowd)

    monkeypatch.setattr(ld, "_wide_links", counting)
    seen = {}
    for n in (500, 1000, 2000):
        made.clear()
        rows = boilerplate(n, middle)
        assert ld.repeated_lines(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).repartition(3), 3, 16, per_edit=16).count() == 0
        seen[n] = sum(made)
    assert all(made < 5 * n for n, made in seen.items()), seen


def test_a_family_of_changed_words_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ld, "SHARED", 8)  # so that a third partition is made
    chance = random.Random(6)
    words = [("".join(chance.choices("abcdefgh", k=chance.randrange(3, 8)))) for _ in range(16)]
    rows = []
    for i in range(70):
        own = words[:]
        for _ in range(chance.randrange(1, 3)):
            at = chance.randrange(16)
            own[at] = own[at][:-1] + chance.choice("xyz") if chance.random() < 0.4 else "".join(chance.choices("qrstuv", k=len(own[at]) + chance.randrange(2)))
        rows.append((i, " ".join(own)))
    assert run(spark, rows, max_edits=3, least=12, crowd=4) == brute(rows, 3, 12)


def test_a_family_of_inserted_letters_makes_no_pairs(spark, monkeypatch):
    """One line with four letters put in at some place: any two are eight edits apart, and their signatures twelve bits at most."""
    monkeypatch.setattr(ld, "HELD", 64)  # so that beginnings and ends are compared
    chance = random.Random(9)
    base = " ".join("".join(chance.choices("aehinorst", k=chance.randrange(2, 9))) for _ in range(18))
    rows = []
    for i in range(60):
        at = chance.randrange(len(base))
        rows.append((i, base[:at] + "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=4)) + base[at:]))
    rows += [(300 + i, rows[i][1].replace("e", "x", 1)) for i in range(0, 60, 10)]
    made, own = [], ld._wide_links

    def counting(shared, texts, verified, max_edits, crowd):
        return own(shared, texts, lambda pairs: made.append(pairs.count()) or verified(pairs), max_edits, crowd)

    monkeypatch.setattr(ld, "_wide_links", counting)
    assert run(spark, rows, max_edits=3, least=16, per_edit=16) == brute(rows, 3, 16)
    assert sum(made) < 8 * len(rows), made
