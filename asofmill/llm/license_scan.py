"""License scans by template markup, compiled to token automata.

A template is wording with optional regions and replaceable ones. It becomes an automaton over
words: every mandatory word has to come exactly and in order, an optional region may be left
out, a replaceable one takes from one to ``max`` words of any kind. Automata are made
deterministic as they run; texts that lack a template's rarest mandatory word are not tried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import split_text_batches

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Templates by label. Words are lower case; {{ }} is optional, <<N>> takes 1 to N words.
TEMPLATES = {
    "apache-2.0-notice": "licensed under the apache license {{version}} 2 0",
    "apache-2.0-terms": "you may not use this file except in compliance with the license {{you may obtain a copy of the license at <<12>> unless}}",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-notice": "licensed under {{a}} {{the}} {{creative commons}} cc by <<1>> 0 {{international}}",
    "cc-by-nc-notice": "licensed under {{a}} {{the}} cc by nc {{sa}} {{nd}} {{<<1>> 0}}",
    "gpl-notice": "licensed under the {{terms of the}} gnu general public license {{as published by the free software foundation}} {{either}} {{version <<1>>}}",
    "gpl-or-later": "gnu general public license {{as published by the free software foundation}} {{either}} version <<1>> {{of the license}} or at your option any later version",
    "mit-notice": "released under the {{terms of the}} mit license",
    "mit-terms": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
    "subject to the following conditions the above copyright notice and this permission notice {{including the next paragraph}} shall be included in all copies or substantial portions of the software",
}

#: Words are letters and digits of ASCII and everything beyond it; upper-case ASCII becomes lower case.
_WORD_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Automaton:
    """States are numbers; state 0 begins. ``deterministic`` keeps the sets of states met so far."""

    words: list[tuple[int, bytes, int]] = field(default_factory=list)
    any_word: list[tuple[int, int]] = field(default_factory=list)
    skips: list[tuple[int, int]] = field(default_factory=list)
    accept: int = 0
    mandatory: list[bytes] = field(default_factory=list)
    deterministic: dict[frozenset, dict[bytes, frozenset]] = field(default_factory=dict)

    def closed(self, states: set[int]) -> frozenset:
        todo = list(states)
        while todo:
            at = todo.pop()
            for a, b in self.skips:
                if a == at and b not in states:
                    states.add(b)
                    todo.append(b)
        return frozenset(states)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        known = self.deterministic.setdefault(states, {})
        if word not in known:
            if len(known) > 4096:
                known.clear()
            after = {b for a, w, b in self.words if a in states and w == word} | {b for a, b in self.any_word if a in states}
            known[word] = self.closed(after)
        return known[word]

    def longest(self, words: list[bytes], at: int) -> int:
        """Words that the longest accepted wording from ``at`` takes; 0 if none is accepted."""
        states, best = self.closed({0}), 0
        for i in range(at, len(words)):
            states = self.step(states, words[i])
            if not states:
                break
            if self.accept in states:
                best = i + 1 - at
        return best


def compile_template(markup: str) -> Automaton:
    """The automaton of a template. Optional regions may hold replaceable and optional ones; a template begins with a word."""
    out, open_, last = Automaton(), [], 0
    for piece in re.findall(r"\{\{|\}\}|<<\d+>>|[^\s{}<>]+", markup):
        if piece == "{{":
            open_.append(last)
        elif piece == "}}":
            out.skips.append((open_.pop(), last))
        elif piece.startswith("<<"):
            ends = []
            for _ in range(int(piece[2:-2])):
                out.any_word.append((last, last + 1))
                last += 1
                ends.append(last)
            out.skips += [(e, last) for e in ends[:-1]]
        else:
            out.words.append((last, piece.encode(), last + 1))
            last += 1
            if not open_:
                out.mandatory.append(piece.encode())
    if open_:
        raise ValueError(f"an optional region does not end: {markup}")
    if not out.mandatory or not any(a == 0 for a, _, _ in out.words):
        raise ValueError(f"a template begins with a word: {markup}")
    out.accept = last
    return out


def template_regex(markup: str) -> str:
    """The same wording as a regular expression over words that a space ends: for SQL."""
    out = []
    for piece in re.findall(r"\{\{|\}\}|<<\d+>>|[^\s{}<>]+", markup):
        out.append({"{{": "(?:", "}}": ")?"}.get(piece) or (f"(?:[^ ]+ ){{1,{piece[2:-2]}}}" if piece.startswith("<<") else piece + " "))
    return " " + "".join(out)


def places_of(line: bytes, phrase: bytes) -> list[int]:
    """Words before each place of the phrase; ``line`` has one space before and after each word. One pass, however many places there are."""
    out, needle, at, words, upto = [], b" " + phrase + b" ", 0, 0, 0
    while (at := line.find(needle, at)) >= 0:
        words += line.count(b" ", upto, at)
        out.append(words)
        upto, at = at, at + 1
    return out


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id and what each whole text says of licenses; one row for every input row.

    n_words; n_base, first_word and last_word: places of the base phrases; base_labels; labels
    (the templates' too), sorted and comma-joined, empty without any; score: 1 if a template is
    accepted, 0.5 with base phrases only, else 0. Null and empty texts have no words and no
    labels; repeated rows get a row each; an empty table gives none. Texts are scanned whole, in time
    proportional to their length: no template takes more words than its own markup allows. Only doc_id and text are read.
    """
    ship(docs.sparkSession)
    base = {k.encode(): v for k, v in (PHRASES if phrases is None else phrases).items()}
    marked = dict(TEMPLATES if templates is None else templates)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [(label, compile_template(markup)) for label, markup in sorted(marked.items())]
        tried = [(label, a, b" " + max(a.mandatory, key=len) + b" ", {w for s, w, _ in a.words if s in a.closed({0})}) for label, a in automata]
        for batch in split_text_batches(batches, "text"):
            out = []
            for text in batch.column(1).cast(pa.large_binary()).to_pylist():
                words = (text or b"").translate(_WORD_TABLE).split()
                line = b" " + b" ".join(words) + b" "
                places, labels = [], set()
                for phrase, label in base.items():
                    if found := places_of(line, phrase):
                        places += found
                        labels.add(label)
                own = set()
                for label, automaton, anchor, firsts in tried:
                    if anchor in line and any(w in firsts and automaton.longest(words, i) for i, w in enumerate(words)):
                        own.add(label)
                score = 1.0 if own else 0.5 if labels else 0.0
                out.append((len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | own)), score))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *[c.split()[0] for c in SCHEMA.split(", ")]])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, f"doc_id long, {SCHEMA}")


def oracle() -> str:
    """DuckDB SQL for ``scan`` of documents."""
    hits = []
    for phrase, label in PHRASES.items():
        parts = " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
        hits.append(f"SELECT n, '{label}' AS label, unnest(list_filter(range(1, len(words) + 1), lambda i: {parts})) - 1 AS pos FROM split")
    own = "\n  UNION ALL ".join(f"SELECT n, '{label}' AS label FROM split WHERE regexp_matches(line, '{template_regex(markup)}')" for label, markup in sorted(TEMPLATES.items()))
    return rf"""
WITH split AS (
  SELECT doc_id, n, words, ' ' || array_to_string(words, ' ') || ' ' AS line
  FROM (SELECT doc_id, row_number() OVER () AS n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents)),
base AS ({" UNION ALL ".join(hits)}),
own AS ({own}),
based AS (SELECT n, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY n),
named AS (SELECT n, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT n, label FROM base UNION ALL SELECT n, label FROM own) GROUP BY n)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n IN (SELECT n FROM own) THEN 1e0 WHEN n_base > 0 THEN 5e-1 ELSE 0e0 END AS score
FROM split LEFT JOIN based USING (n) LEFT JOIN named USING (n)
"""

