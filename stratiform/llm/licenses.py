"""License scans by matching marked-up license templates.

A template is the wording of a license or notice with two kinds of markup:
``[[ ... ]]`` encloses an optional region and ``{{n}}`` stands for a replaceable
region of at most ``n`` words (a name, a year).  A template is compiled to an
automaton over words, run from every place where its first mandatory words stand;
it accepts when all mandatory wording has been read exactly and in order.  Beside
the templates, plain phrases are counted wherever their words stand consecutively.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
The score is 1 for an accepted template, else the largest part of a template's
mandatory words read in order from a start (below 1), at least 0.5 where a base
phrase stands and 0 where nothing starts.

Defined results: NULL text counts as empty (no words, empty labels, NULL places,
score 0); every row gives one row, repeated rows too; NULL ids stay NULL; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public notice and license wording with markup; label -> template.
TEMPLATES = {
    "mit-notice": "[[released]] [[licensed]] [[distributed]] under [[the terms of]] the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction including "
                "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                "the following conditions",
    "apache-2.0-notice": "licensed under the apache license version 2 0 [[the license]]",
    "apache-2.0-header": "licensed under the apache license version 2 0 the license you may not use {{4}} except in "
                         "compliance with the license",
    "gpl-notice": "[[this work]] [[is]] licensed under the gnu general public license [[as published by the free "
                  "software foundation]] [[either]] version {{1}} [[of the license]] [[or at your option any later "
                  "version]]",
    "gpl-header": "free software you can redistribute it and or modify it under the terms of the gnu general public "
                  "license as published by the free software foundation either version {{1}} of the license",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted "
                "provided that the following conditions are met",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee "
                "is hereby granted",
    "cc-notice": "licensed under [[a]] [[the]] [[creative commons]] cc by [[nc]] [[sa]] [[nd]] {{1}} 0",
    "all-rights-reserved": "[[copyright {{8}}]] all rights reserved",
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_WILD = object()


class Automaton:
    """A template as states 0..n: each reads one word; optional regions add empty moves."""

    def __init__(self, template: str):
        parts = re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", template)
        self.read: list[list[tuple[object, int]]] = [[]]  # state -> [(word, next state)]
        self.skip: list[list[int]] = [[]]  # state -> states reached without reading
        self.mandatory_before = [0]  # mandatory words read on reaching a state
        opened, mandatory = [], 0
        for p in parts:
            if p == "[[":
                opened.append(self._here())
            elif p == "]]":
                self.skip[opened.pop()].append(self._here())
            elif p.startswith("{{"):
                begin = self._here()
                for _ in range(int(p[2:-2])):
                    self._next(_WILD, mandatory)
                for s in range(begin, self._here()):
                    self.skip[s].append(self._here())
            else:
                word = p.encode()
                mandatory += not opened
                self._next(word, mandatory)
        self.mandatory = mandatory
        self.final = self._here()
        self.starts = self._closure({0})
        #: words one of which must stand at a place for a match to begin there
        self.first_words = {w for s in self.starts for w, _ in self.read[s] if w is not _WILD}

    def _here(self) -> int:
        return len(self.read) - 1

    def _next(self, word, mandatory: int) -> None:
        self.read[-1].append((word, len(self.read)))
        self.read.append([])
        self.skip.append([])
        self.mandatory_before.append(mandatory)

    def _closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    def run(self, words: list[bytes], at: int) -> tuple[int, float]:
        """End of the longest accepted match from ``at`` (-1: none) and the share of mandatory words read."""
        states, end, most = self.starts, -1, 0
        i = at
        while True:
            most = max(most, *(self.mandatory_before[s] for s in states))
            if self.final in states:
                end = i
            if i >= len(words):
                break
            moved = {t for s in states for w, t in self.read[s] if w is _WILD or w == words[i]}
            if not moved:
                break
            states = self._closure(moved)
            i += 1
        return end, most / self.mandatory if self.mandatory else 0.0


class Scanner:
    """All templates and phrases, applied to one text."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.automata = [(label, Automaton(t)) for label, t in sorted(templates.items())]
        self.phrases = [(tuple(p.encode().split()), label) for p, label in sorted(phrases.items())]
        starts = {w for _, a in self.automata for w in a.first_words} | {p[0] for p, _ in self.phrases}
        self.wanted = starts
        self.anchor = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(sorted(map(re.escape, starts), reverse=True))
                                 + rb")(?![0-9a-z\x80-\xff])")

    def scan(self, text: str) -> tuple:
        raw = text.encode("utf-8", "surrogatepass").lower()
        words = _WORD.findall(raw)
        if self.anchor.search(raw) is None:
            return len(words), 0, None, None, None, "", "", 0.0, []
        first_of: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.wanted:
                first_of.setdefault(w, []).append(i)
        n_base, first, last, latest, base, labels, score, spans = 0, None, None, None, set(), set(), 0.0, []
        for phrase, label in self.phrases:
            for i in first_of.get(phrase[0], ()):
                if tuple(words[i:i + len(phrase)]) == phrase:
                    n_base += 1
                    first = i if first is None else min(first, i)
                    last = i + len(phrase) - 1 if last is None else max(last, i + len(phrase) - 1)
                    latest = i if latest is None else max(latest, i)
                    base.add(label)
        for label, automaton in self.automata:
            places = sorted({i for w in automaton.first_words for i in first_of.get(w, ())})
            covered = -1
            for i in places:
                end, share = automaton.run(words, i)
                if end >= 0:
                    labels.add(label)
                    score = 1.0
                    if end > covered:
                        spans.append((label, i, end - 1))
                        covered = end
                else:
                    score = max(score, min(share, 0.99))
        if base:
            score = max(score, 0.5)
        return len(words), n_base, first, last, latest, ",".join(sorted(base)), ",".join(sorted(base | labels)), score, spans


_scanners: dict[tuple, Scanner] = {}


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: word count, phrase places, labels, score and the accepted spans (label, first word, last word).

    ``first_word`` and ``last_start`` are the smallest and the largest start of a phrase, ``last_word`` is the last
    word that a phrase covers.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = BASE_PHRASES if phrases is None else phrases
    key = (tuple(sorted(templates.items())), tuple(sorted(phrases.items())))
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
    names = ["n_words", "n_base", "first_word", "last_word", "last_start", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scanners:
            _scanners[key] = Scanner(templates, phrases)
        scanner = _scanners[key]
        for batch in batches:
            rows = [scanner.scan(t.as_py() or "") for t in batch.column(1)]
            cols = []
            for i, kind in enumerate(types):
                values = [r[i] for r in rows]
                if i == 8:
                    values = [[dict(zip(("label", "first", "last"), s)) for s in v] for v in values]
                cols.append(pa.array(values, kind))
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", *names])

    kept = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                "last_start bigint, base_labels string, labels string, score double, "
                                "spans array<struct<label:string,first:bigint,last:bigint>>")
