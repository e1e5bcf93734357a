"""Licence notices in texts: matching statistics of a suffix automaton, chained into template spans.

The templates are few and fixed in size, so one generalised suffix automaton of their words is built in each
worker, once.  A text is read through it word by word: at every word it tells the longest passage that ends
there and stands in some template.  The longest of these passages are anchors; anchors of one template that
follow each other in text and template are chained into spans, and a template is found where a chain covers enough of it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A to Z are lower-cased; ASCII characters but letters and digits are gaps.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: Phrases that name a licence wherever their words stand, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Notices of common licences, as published with them, and their labels.
NOTICES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    ("mit", "Released under the MIT License."),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Words of a passage that may begin or end a span; shorter templates need all of theirs.
LEAST_ANCHOR = 4
#: Words that may be skipped between two anchors of a chain, in the text and in the template.
MOST_SKIPPED = 12
#: The share of a template's words that a chain covers where the template is found.
LEAST_COVER = 0.8

SPAN = "label string, template int, first_word long, last_word long, covered long, cover double"
SCAN = (
    "doc_id {id}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    f"score double, spans array<struct<{SPAN.replace(' ', ':').replace(',:', ', ')}>>"
)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8: runs of letters and digits, A to Z lower-cased; all beyond ASCII are letters."""
    return text.translate(_WORDS).split()


@dataclass(frozen=True)
class Span:
    """Where a chain of anchors covers a template: words ``first`` to ``last`` of the text."""

    template: int
    first: int
    last: int
    covered: int
    cover: float


class LicenceAutomaton:
    """A generalised suffix automaton over the words of templates and of the phrases that name a licence.

    A state is the set of passages with the same places; ``length`` is its longest, ``link`` the state of the
    longest suffix with more places.  ``places`` are the ends of the state's passages, (template, word), and
    ``named`` the phrases that end each of its passages.
    """

    def __init__(self, phrases: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]) -> None:
        self.phrase_words = [words_of(p.encode()) for p, _ in phrases]
        self.phrase_labels = [label for _, label in phrases]
        self.templates = [words_of(text.encode()) for _, text in notices]
        self.template_labels = [label for label, _ in notices]
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        self.named: list[list[int]] = [[]]
        for number, words in enumerate(self.templates):
            state = 0
            for at, word in enumerate(words):
                state = self._add(state, word)
                self.places[state].add((number, at))
        for words in self.phrase_words:
            state = 0
            for word in words:
                state = self._add(state, word)
        order = sorted(range(1, len(self.length)), key=lambda s: self.length[s])
        for state in reversed(order):
            self.places[self.link[state]] |= self.places[state]
        self.places[0] = set()
        here: dict[int, list[int]] = {}
        for number, words in enumerate(self.phrase_words):
            here.setdefault(self._state(words), []).append(number)
        for state in order:
            self.named[state] = here.get(state, []) + self.named[self.link[state]]
        self.anchors = [tuple(sorted(places)) for places in self.places]
        self.least = min((min(LEAST_ANCHOR, len(words)) for words in self.templates), default=LEAST_ANCHOR)

    def _new(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else 0)
        self.length.append(length)
        self.places.append(set())
        self.named.append([])
        return len(self.length) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state of (the longest passage of ``state``) and ``word``, split off if it had longer ones too."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(self.length[state] + 1, target)
        self.link[target] = copy
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _add(self, last: int, word: bytes) -> int:
        """Append a word to the template that ends in ``last``; an earlier template may hold the passage."""
        if word in self.next[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1)
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        self.link[new] = 0 if state == -1 else self._split(state, word)
        return new

    def _state(self, words: Sequence[bytes]) -> int:
        state = 0
        for word in words:
            state = self.next[state][word]
        return state

    def statistics(self, words: Sequence[bytes]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length) of the longest passage that ends at each word; words of none are left out."""
        state = length = 0
        steps, link, longest = self.next, self.link, self.length
        root = steps[0]
        for at, word in enumerate(words):
            if word not in root:
                state = length = 0
                continue
            while word not in steps[state]:
                state = link[state]
                length = longest[state]
            state = steps[state][word]
            length += 1
            yield at, state, length

    def scan(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], list[Span]]:
        """The places of the phrases, (phrase, first word), and the spans of the templates that are found."""
        found: list[tuple[int, int]] = []
        anchors: list[tuple[int, int, int]] = []
        before: tuple[int, int, int] | None = None
        for place in self.statistics(words):
            at, state, length = place
            for phrase in self.named[state]:
                # a phrase of the state itself may be longer than this match of it
                if len(self.phrase_words[phrase]) <= length:
                    found.append((phrase, at - len(self.phrase_words[phrase]) + 1))
            # a passage is longest where the next word does not extend it
            if before is not None and (at != before[0] + 1 or length != before[2] + 1):
                anchors.append(before)
            before = place
        if before is not None:
            anchors.append(before)
        return found, self._chained(anchors)

    def _chained(self, anchors: list[tuple[int, int, int]]) -> list[Span]:
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for at, state, length in anchors:
            for template, end in self.anchors[state] if length >= self.least else ():
                if length >= min(LEAST_ANCHOR, len(self.templates[template])):
                    by_template.setdefault(template, []).append((at - length + 1, end - length + 1, length))
        spans = []
        for template, matches in sorted(by_template.items()):
            spans += self._spans(template, sorted(matches))
        return self._undisputed(spans)

    def _undisputed(self, spans: list[Span]) -> list[Span]:
        """Without the spans that lie within one of another label that covers more words: a variant of that notice."""
        spans = sorted(spans, key=lambda s: (s.first, -s.last, s.template))
        lost, open_spans = set(), []
        for span in spans:
            open_spans = [s for s in open_spans if s.last >= span.first]
            for other in open_spans:
                for a, b in ((span, other), (other, span)):
                    inside = b.first <= a.first and a.last <= b.last
                    if inside and b.covered > a.covered and self.template_labels[a.template] != self.template_labels[b.template]:
                        lost.add(a)
            open_spans.append(span)
        return [span for span in spans if span not in lost]

    def _spans(self, template: int, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Best chains of (place in text, place in template, length), one after the other along the text.

        A match extends a chain that ends before it in text and template, by MOST_SKIPPED words at most in both; words that
        both hold count once.  Chains that cover LEAST_COVER are spans; those that overlap a better one are left out.
        """
        size = len(self.templates[template])
        best: list[tuple[int, int]] = []  # covered words, first word of the chain
        starts = [m[0] for m in matches]
        for number, (at, inside, length) in enumerate(matches):
            chosen = (length, at)
            # a match before this one ends within MOST_SKIPPED words of it, so it starts within that and a template
            for other in range(bisect_left(starts, at - MOST_SKIPPED - size), number):
                begin, within, n = matches[other]
                shared = max(0, begin + n - at, within + n - inside)
                if begin < at and within < inside and shared < length:
                    if at - begin - n <= MOST_SKIPPED and inside - within - n <= MOST_SKIPPED:
                        covered, first = best[other]
                        chosen = max(chosen, (covered + length - shared, first), key=lambda c: (c[0], c[1]))
            best.append(chosen)
        chains = [
            (covered, first, at + length - 1)
            for (at, _, length), (covered, first) in zip(matches, best, strict=True)
            if covered >= LEAST_COVER * size
        ]
        spans: list[Span] = []
        for covered, first, last in sorted(chains, key=lambda c: (c[1], -c[0], c[2])):
            if spans and first <= spans[-1].last:
                if covered <= spans[-1].covered:
                    continue
                spans.pop()
            spans.append(Span(template, first, last, covered, min(1.0, covered / size)))
        return spans


@cache
def _automaton(phrases: tuple, notices: tuple) -> LicenceAutomaton:
    return LicenceAutomaton(phrases, notices)


def scan_licences(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = tuple(PHRASES),
    notices: Sequence[tuple[str, str]] = tuple(NOTICES),
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the licences that its whole text names or holds.

    ``n_words`` words; ``n_base`` places of ``phrases`` (phrase, label), the first word of the first and of
    the last of these (null: none), and their labels, ``base_labels``, sorted and joined by commas.  ``spans`` are the places of
    ``notices`` (label, text) that are covered to LEAST_COVER, each with its first and last word, the words covered and their
    share; ``labels`` are those of phrases and spans, ``score`` is the share of the best span, 0 without one.  A null or
    empty text has no words.  Rows are judged one by one, so repeated rows stay and an empty table gives none; other
    columns are not returned.
    """
    phrases, notices = tuple(phrases), tuple(notices)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(phrases, notices)
        for batch in batches:
            rows = [_row(automaton, text.as_py()) for text in batch.column(1)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)] if rows else None
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *_NAMES])

    return texts.mapInArrow(run, SCAN.format(id=docs.schema["doc_id"].dataType.simpleString()))


_NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
_SPAN_TYPE = pa.struct(
    [
        ("label", pa.string()),
        ("template", pa.int32()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("covered", pa.int64()),
        ("cover", pa.float64()),
    ]
)
_TYPES = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(_SPAN_TYPE)]


def _row(automaton: LicenceAutomaton, text: bytes) -> tuple:
    words = words_of(text)
    found, spans = automaton.scan(words)
    starts = [first for _, first in found]
    base = {automaton.phrase_labels[phrase] for phrase, _ in found}
    more = {automaton.template_labels[s.template] for s in spans}
    told = [
        {
            "label": automaton.template_labels[s.template],
            "template": s.template,
            "first_word": s.first,
            "last_word": s.last,
            "covered": s.covered,
            "cover": s.cover,
        }
        for s in spans
    ]
    return (
        len(words),
        len(found),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | more)),
        max((s.cover for s in spans), default=0.0),
        told,
    )
