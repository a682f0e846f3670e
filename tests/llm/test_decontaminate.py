"""Template matches against a plain restatement, and re-parameterised questions."""

import random

import pytest

from asofmill.llm import decontaminate as dc

DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string, slots string"
QUESTION = "Tom walks 12 miles every day to visit Anna Lee at the old mill, and Anna Lee gives Tom 12 apples for the long way back home."
OTHER = "Peter walks 90 miles every day to visit Rosa at the old mill, and Rosa gives Peter 90 apples for the long way back home."
BROKEN = "Peter walks 90 miles every day to visit Rosa at the old mill, and Rosa gives Peter 70 apples for the long way back home."


def plain(text, names):
    """Template words and slot values, by a loop; ``names``: capitals that open sentences are names too."""
    out, opens, after_number, was_name = [], True, False, False
    for token in dc._TOKEN.findall(text or ""):
        low = token.lower()
        if token in ".!?:;\n":
            opens = True
            continue
        capital = token[0].isupper() and token != "I" and token[1:] == low[1:]
        number = token[0].isdigit() or low in dc.NUMBER_WORDS
        unit = not number and low in dc.UNITS
        name = not number and not unit and capital and (names or not opens)
        if name and was_name:
            opens = False
            continue
        out.append(("<name>", low) if name else ("<number>", low) if number else ("<unit>", low) if unit and after_number else (low, None))
        opens, after_number, was_name = False, number, name
    return out


def windows(words, i, width):
    """The window's template and values, or None if it is mostly slots."""
    own = words[i : i + width]
    if 2 * sum(v is None for _, v in own) < width:
        return None
    return [w for w, _ in own], [v for _, v in own]


def brute(docs, items, window=dc.WINDOW, least=dc.LEAST):
    found = set()
    for item_id, item in items:
        for a_names in (False, True):
            a = plain(item, a_names)
            width = min(len(a), window)
            if width < least or item_id is None:
                continue
            for doc_id, text in docs:
                for b_names in (False, True):
                    b, shifts = plain(text, b_names), {}
                    for i in range(len(a) - width + 1):
                        if (one := windows(a, i, width)) is None:
                            continue
                        for j in range(len(b) - width + 1):
                            if b[j][0] == a[i][0] and (two := windows(b, j, width)) is not None and one[0] == two[0]:
                                shifts.setdefault(j - i, set()).update((x, y) for x, y in zip(one[1], two[1]) if x is not None)
                    if any(len(p) == len({x for x, _ in p}) for p in shifts.values()):
                        found.add((doc_id, item_id))
    return found


def cases():
    chance = random.Random(2)
    word = lambda: chance.choice(["alpha", "beta", "Gamma", "delta", "10", "km", "Tom", "seven", "éta", "theta", "of", "the"])
    items = [(i, " ".join(word() for _ in range(chance.randrange(3, 40))) + chance.choice([".", "?", ""])) for i in range(30)]
    docs = []
    for i in range(40):
        own = " ".join(word() for _ in range(chance.randrange(0, 60)))
        docs.append((i, own + "\n" + items[i][1].upper() if i % 4 == 1 and i < 30 else own + ". " + items[i % 30][1] + " end" if i % 4 == 0 else own))
    items += [(100, QUESTION), (101, None), (102, ""), (103, "too short"), (100, QUESTION), (None, QUESTION)]
    docs += [(200, "Intro. " + QUESTION), (201, OTHER), (202, BROKEN), (203, None), (204, ""), (205, "the of " * 20_000), (206, "12 13 14 " * 300), (None, OTHER), (201, OTHER)]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x") for d in docs], DOCS).repartition(3), spark.createDataFrame([(*i, "x") for i in items], ITEMS)


@pytest.mark.parametrize("bits", [24, 16])
def test_pairs_match_brute_force(spark, bits):
    docs, items = cases()
    got = dc.matches(*frames(spark, docs, items), filter_bits=bits).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    assert all(0 < r.coverage <= 1 for r in got)


def test_other_numbers_and_names_are_found_and_inconsistent_ones_not(spark):
    docs, items = cases()
    got = {r.doc_id: r for r in dc.matches(*frames(spark, docs, [(100, QUESTION)])).collect()}
    assert got[200].verbatim and got[200].coverage == 1
    assert got[201].changed >= 3 and not got[201].verbatim
    assert 202 not in got and 206 not in got


def test_a_conflict_leaves_the_unchanged_windows(spark):
    tail = " She then walked slowly along the river until it got dark and cold outside."
    docs = [(1, QUESTION.replace("12 apples", "13 apples") + tail), (2, BROKEN), (3, OTHER + " Nothing else. " + tail)]
    got = {r.doc_id: r for r in dc.matches(*frames(spark, docs, [(100, QUESTION + tail)])).collect()}
    assert got[1].n_windows < got[1].item_windows and got[1].changed == 1 and not got[1].verbatim
    assert 2 not in got and got[3].changed >= 3


def test_short_items_and_windows_of_slots_are_found_by_their_words(spark):
    items = [(1, "What is 37 times 48?"), (2, "Add 3 4 5 6 7 8 9 10 11 12 13 now.")]
    docs = [(1, "Easy. what is 37 times 48? Yes."), (2, "What is 38 times 48?"), (3, "So add 3 4 5 6 7 8 9 10 11 12 13 now"), (4, "Add 3 4 5 6 7 8 9 11 11 12 13 now.")]
    got = dc.matches(*frames(spark, docs, items), exact=True).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (3, 2)} and all(r.verbatim and r.coverage == 1 for r in got)
    assert sorted(r.doc_id for r in dc.remove_contaminated(*frames(spark, docs, items), exact=True).collect()) == [2, 4]


def test_removal_keeps_the_rest(spark):
    docs, items = cases()
    frame, bench = frames(spark, docs, items)
    kept = dc.remove_contaminated(frame, bench)
    bad = {d for d, _ in brute(docs, items)}
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((d for d, _ in docs if d not in bad), key=repr)


def test_filter_holds_every_window(spark):
    import numpy as np

    values = [0, 1, -1, 1 << 62, -(1 << 63), 32768 << 40, 32769 << 40] + [random.Random(1).getrandbits(63) for _ in range(500)]
    made = dc._filter_of(spark.createDataFrame([(v,) for v in values], "window long"), 24)
    hashes = np.array(values, np.int64).view(np.uint64)
    assert dc._may_hold(made, hashes, 24).all()
    assert dc._may_hold(made, np.random.default_rng(0).integers(0, 1 << 63, 10_000, dtype=np.uint64), 24).mean() < 0.01


def test_empty_tables(spark):
    docs, items = cases()
    for d, i in (([], items), (docs, []), ([], [])):
        assert dc.matches(*frames(spark, d, i)).count() == 0
    assert dc.remove_contaminated(*frames(spark, docs, [])).count() == len(docs)


def test_no_list_of_names_decides(spark):
    item = "Yusuf walked 90 miles along the river to the market and gave it all to me."
    docs = [(1, "Fatima walked 12 miles along the river to the market and gave it all to me."), (2, "Then Fatima Zahra walked 12 miles along the river to the market and gave it all to me."),
            (3, "Nobody walked along the river to the market, and so gave it all to me."), (4, "We know. Peter walked 7 miles along the river to the market and gave it all to me")]
    got = {r.doc_id: r for r in dc.matches(*frames(spark, docs, [(1, item)])).collect()}
    assert set(got) == {1, 2, 4} and all(0 < r.coverage <= 1 and r.changed for r in got.values()) and got[1].coverage == 1
    words = [(1, "Walking along the river to the market and gave it all to me."), (2, "Dogs along the river to the market and gave it all to me.")]
    assert {(r.doc_id, r.verbatim) for r in dc.matches(*frames(spark, [words[0]], [words[0]])).collect()} == {(1, True)}


def test_items_of_a_word_or_two_prove_nothing(spark):
    items = [(1, "Yes"), (2, "No way"), (3, "It is time."), (4, "It is high time.")]
    docs = [(1, "yes it is a fine day, yes"), (2, "There is no way to tell."), (3, "So it is time"), (4, "Well, it is high time."), (5, "no"), (None, "Yes. " * 1000), (None, "Yes. " * 1000)]
    got = {(r.doc_id, r.item_id): r for r in dc.matches(*frames(spark, docs, items), exact=True).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 4), (None, 1)} and {k for k, r in got.items() if r.conclusive} == {(4, 4)}
    kept = dc.remove_contaminated(*frames(spark, docs, items), exact=True)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 2, 3, 5, None, None], key=repr)


def test_query_as_registered(spark, tmp_path):
    from asofmill.llm.queries import op4_decontaminate

    docs, items = cases()
    frame, bench = frames(spark, docs, items)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in op4_decontaminate(spark, str(tmp_path)).filter("conclusive").collect()}
    assert got >= brute(docs, items)
