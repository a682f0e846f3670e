"""Packing against texts encoded one by one with the public tokenizer, patterns against bounds, cuts along gaps."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from asofmill.llm import packing
from asofmill.llm.queries import TOKENIZER, op11_pack

SCHEMA = "doc_id long, text string, length string, sequence_id string"
LONG = "the quick brown fox " * 4000
TEXTS = [(0, ""), (1, None), (None, "no id"), (2, "Hello world"), (2, "Hello world"), (3, LONG), (4, "a<|endoftext|>b"), (5, "é ß 漢字 " * 700), (6, " " * 30_000), (7, "x" * 20_000)]


@pytest.fixture(scope="module")
def encode():
    own = Tokenizer.from_file(TOKENIZER)
    return lambda text: [*own.encode(text or "", add_special_tokens=False).ids, 1]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA).repartition(3)


def held_together(pieces, docs, encode, length):
    """Every id of every document in one piece, sequences without gaps, and no padding but for powers of two."""
    left = defaultdict(list)
    for doc_id, text in docs:
        left[doc_id].append(encode(text))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(left)
    for doc_id, all_ids in left.items():
        wanted, got = defaultdict(int), defaultdict(int)
        for p in by_doc[doc_id]:
            got[p.doc_tokens, p.start, p.length, p.ids_crc32] += 1
        for (tokens, start, size, ids_crc32), n in got.items():
            assert n <= sum(len(ids) == tokens and crc(ids[start : start + size]) == ids_crc32 for ids in all_ids)
        for ids in all_ids:
            wanted[len(ids)] += len(ids)
        covered = defaultdict(int)
        for (tokens, _, size, _), n in got.items():
            covered[tokens] += n * size
        assert covered == wanted
        if len(all_ids) == 1:
            at = 0
            for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                assert p.start == at
                at += p.length
            assert at == len(all_ids[0])
    others = []
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= length
        others += [at] if at != length else []
    assert len(set(others)) == len(others) and all(x & (x - 1) == 0 for x in others)


@pytest.mark.parametrize("length,unit", [(2048, 8), (256, 8), (64, 1)])
def test_every_id_once_and_sequences_full(spark, encode, length, unit):
    random = np.random.default_rng(length)
    more = [(100 + i, " ".join(random.choice(["alpha", "beta", "gamma", "of", "the"], int(n)))) for i, n in enumerate(random.integers(1, 900, 60))]
    docs = TEXTS + more
    got = packing.pack(frame(spark, docs), TOKENIZER, length=length, unit=unit).collect()
    held_together(got, docs, encode, length)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, LONG)], [(i, "same") for i in range(700)]])
def test_small_tables(spark, encode, rows):
    got = packing.pack(frame(spark, rows), TOKENIZER, length=512).collect()
    assert bool(got) == bool(rows)
    held_together(got, rows, encode, 512)


def test_ranks_and_running_sums_do_not_need_one_group(spark, encode, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 16)
    monkeypatch.setattr(packing, "CELL", 128)
    rows = [(i, "word " * (i % 37)) for i in range(400)]
    held_together(packing.pack(frame(spark, rows), TOKENIZER, length=128).collect(), rows, encode, 128)


def test_query_on_a_written_table(spark, tmp_path, encode):
    frame(spark, TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    held_together(op11_pack(spark, str(tmp_path)).collect(), TEXTS, encode, 2048)


def test_ids_are_those_of_the_library():
    with open(TOKENIZER, "rb") as f:
        fast, own = packing.encoder_of(f.read()), Tokenizer.from_file(TOKENIZER)
    assert fast.__name__ == "encode"

    @settings(max_examples=300, deadline=None)
    @given(st.text(max_size=80) | st.text(alphabet=" \n\t 　'sdmtrevlLx1²<|endoftext|>", max_size=80))
    def same(text):
        assert fast(text).tolist() == own.encode(text, add_special_tokens=False).ids

    same()
    blanks = " " * 1_000_000 + "a"
    assert fast(blanks).tolist() == own.encode(blanks, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 400), min_size=1, max_size=12))
def test_patterns_place_everything_near_the_bound(wanted):
    sizes, counts = np.array(sorted(wanted)), np.array([wanted[k] for k in sorted(wanted)])
    patterns, times, bound = packing.patterns_of(counts, sizes, 32)
    assert (times @ patterns == counts).all() and (patterns @ sizes <= 32).all() and (times > 0).all()
    assert bound >= counts @ sizes / 32 - 1e-9
    assert times.sum() <= np.ceil(bound * (1 + packing.GAP)) + len(sizes)  # what rounding down leaves is less than a sequence for each pattern


def test_linear_program_finds_the_known_optimum():
    # 97 pieces of 45, 610 of 36, 395 of 31 and 211 of 14 from stock of 100: 452.25 (a textbook's cutting-stock example)
    sizes, counts = np.array([14, 31, 36, 45]), np.array([211, 395, 610, 97])
    _, used, bound = packing.relaxed(counts.astype(float), sizes, 100, gap=0.0)
    assert abs(used.sum() - 452.25) < 1e-6 and abs(bound - 452.25) < 1e-6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.floats(-1, 3)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(20, 40))
def test_knapsack_against_enumeration(items, room):
    sizes, values = np.array([s for s, _ in items]), np.array([v for _, v in items])
    worth, pattern = packing.best_pattern(values, sizes, room)
    best = [0.0] * (room + 1)
    for c in range(1, room + 1):
        best[c] = max([best[c - 1], *(best[c - s] + v for s, v in items if s <= c)])
    assert abs(worth - best[room]) < 1e-9 and pattern @ sizes <= room and abs(pattern @ values - worth) < 1e-9


def test_weakest_sequences_fill_the_gaps():
    assert packing.weakest([(100, 0, 5)], 100) == (-1, -1)
    assert packing.weakest([(50, 0, 1), (95, 0, 10)], 100) == (50, 0)
    assert packing.weakest([(50, 0, 1), (95, 0, 11), (95, 1, 3)], 100) == (95, 0)
