"""Token automata and the scan against plain restatements."""

import re
import time

import pytest

from asofmill.llm import license_scan as ls

SCHEMA = "doc_id long, text string, labels string"
ACCEPTED = [
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-notice", "licensed UNDER the apache-license 2.0"),
    ("gpl-notice", "Licensed under the terms of the GNU General Public License, version 3"),
    ("gpl-or-later", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("cc-by-nc-notice", "Licensed under CC BY-NC 4.0."),
    ("mit-notice", "Released under the MIT License."),
]
REFUSED = [("apache-2.0-notice", "Licensed under the Apache License, Revision 2.0."), ("mit-notice", "Released under a MIT License."), ("cc-by-nc-notice", "Licensed under CC BY-SA 4.0")]


def words_of(text):
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))]


@pytest.mark.parametrize("label,text", ACCEPTED)
def test_accepts(label, text):
    words = words_of("before " + text + " after")
    assert any(ls.compile_template(ls.TEMPLATES[label]).longest(words, i) for i in range(len(words)))


@pytest.mark.parametrize("label,text", REFUSED)
def test_refuses_other_mandatory_wording(label, text):
    words = words_of(text)
    assert not any(ls.compile_template(ls.TEMPLATES[label]).longest(words, i) for i in range(len(words)))


def test_automata_agree_with_regular_expressions():
    markup = "a {{b <<2>>}} {{c {{d}}}} e"
    automaton, pattern = ls.compile_template(markup), re.compile("^" + ls.template_regex(markup) + "$")
    from itertools import product

    for n in range(1, 7):
        for words in product("abcde", repeat=n):
            assert (automaton.longest([w.encode() for w in words], 0) == n) == bool(pattern.match(" " + " ".join(words) + " "))


def test_bad_markup():
    for markup in ("{{a", "<<2>> a", "{{a}}"):
        with pytest.raises(ValueError):
            ls.compile_template(markup)


def test_scan_matches_brute_force(spark):
    texts = [t for _, t in ACCEPTED + REFUSED] + [None, "", "!!", "mit license mit license MIT-License", "gnu general public licenses", "é " * 30_000 + "CC BY", "cc. by cc\nby", "Apache LICENSE", "ÀPACHE License"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "mit license", None), (0, texts[0], None)]
    got = sorted((tuple(r) for r in ls.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=repr)
    want = []
    for doc_id, text, _ in rows:
        words = [w.decode() for w in words_of(text or "")]
        places, base = [], set()
        for phrase, label in ls.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places, base = places + found, base | ({label} if found else set())
        line = " " + " ".join(words) + " "
        own = {k for k, m in ls.TEMPLATES.items() if re.search(ls.template_regex(m), line)}
        want.append((doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if own else 0.5 if base else 0.0))
    assert got == sorted(want, key=repr)


def test_empty_table(spark):
    assert ls.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_full_of_places_take_time_in_proportion(spark):
    times = 120_000
    rows = [(1, "mit license x " * times, None), (2, "licensed under the " * times, None), (3, "gnu general public license or licensed " * times, None)]
    assert sum(len(t) for _, t, _ in rows) > 8_000_000
    began = time.time()
    got = {r.doc_id: r for r in ls.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert time.time() - began < 60  # hours, if every place were counted from the beginning
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (times, 0, 3 * (times - 1))
    assert (got[2].n_words, got[2].n_base, got[2].labels) == (3 * times, 0, "")
    assert (got[3].n_base, got[3].last_word, got[3].labels) == (times, 6 * (times - 1), "gpl")


def test_empty_table(spark):
    assert ls.scan(spark.createDataFrame([], SCHEMA)).collect() == []
