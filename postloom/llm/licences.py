"""Licence scan: matching statistics from a suffix automaton of licence templates, then chains."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame

from postloom.llm.common import pick

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
GAP = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]")
# Characters that are split into words at once.
BLOCK_CHARS = 1 << 20

# Phrases whose places are reported, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Wording of common licence notices.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
            "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
            "and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
               "you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
            "the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def lowered(text: str) -> str:
    """``text`` with A-Z in lower case, all other characters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str, block: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """The words of a text, in lists of about ``block`` characters; no word is cut."""
    start = 0
    while start < len(text):
        cut = GAP.search(text, start + block) if start + block < len(text) else None
        end = cut.start() if cut else len(text)
        yield WORD.findall(lowered(text[start:end]))
        start = end


@dataclass
class SuffixAutomaton:
    """Generalised suffix automaton of token sequences.

    ``places[state]`` lists ``(sequence, last position)`` of all occurrences of the
    state's longest string; a shorter string of the state ends at the same places.
    """

    step: list[dict[str, int]]
    link: list[int]
    longest: list[int]
    places: list[list[tuple[int, int]]]

    @classmethod
    def of(cls, sequences: Sequence[Sequence[str]]) -> "SuffixAutomaton":
        step, link, longest, ends = [{}], [-1], [0], [[]]

        def split(state: int, word: str, target: int) -> int:
            copy = len(step)
            step.append(dict(step[target]))
            link.append(link[target])
            longest.append(longest[state] + 1)
            ends.append([])
            link[target] = copy
            while state >= 0 and step[state].get(word) == target:
                step[state][word] = copy
                state = link[state]
            return copy

        for number, sequence in enumerate(sequences):
            last = 0
            for position, word in enumerate(sequence):
                known = step[last].get(word)
                if known is not None:
                    last = known if longest[known] == longest[last] + 1 else split(last, word, known)
                else:
                    state, fresh = last, len(step)
                    step.append({})
                    link.append(0)
                    longest.append(longest[last] + 1)
                    ends.append([])
                    while state >= 0 and word not in step[state]:
                        step[state][word] = fresh
                        state = link[state]
                    if state >= 0:
                        target = step[state][word]
                        link[fresh] = target if longest[target] == longest[state] + 1 else split(state, word, target)
                    last = fresh
                ends[last].append((number, position))
        for state in sorted(range(1, len(step)), key=lambda s: -longest[s]):
            if link[state] > 0:
                ends[link[state]].extend(ends[state])
        return cls(step, link, longest, ends)

    def walk(self, words: Sequence[str]) -> int:
        state = 0
        for word in words:
            state = self.step[state][word]
        return state


class LicenceScanner:
    """Matching statistics of a word stream against templates and phrases.

    A match is reported where it cannot be extended to the right in its template, be it
    that the template ends or goes on otherwise, from ``least_match`` words on. Matches on one template that follow each other in the text and in the
    template, with at most ``gap`` words between them on either side, form a chain; a chain
    that covers ``least_cover`` of its template (and of phrases, all) is a span, unless it
    is incomplete and lies in the span of a template that covers more words there.
    """

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, least_match: int = 3, gap: int = 8, least_cover: float = 0.6):
        self.labels = [label for label, _ in templates]
        sequences = [WORD.findall(lowered(text)) for _, text in templates]
        self.sizes, self.templates = [len(s) for s in sequences], sequences
        phrase_words = [WORD.findall(lowered(text)) for text, _ in phrases]
        self.phrases = [(label, len(w)) for w, (_, label) in zip(phrase_words, phrases)]
        self.automaton = SuffixAutomaton.of([*sequences, *phrase_words])
        self.least_match, self.gap, self.least_cover = least_match, gap, least_cover
        # Places in templates that a state's suffix link has beyond those of the state.
        places, link = self.automaton.places, self.automaton.link
        self.extra = [[] if at <= 0 else sorted(set(places[at]) - set(places[state])) if at else [] for state, at in enumerate(link)]
        # Phrases that may end where a state is current: those of the state and of its suffix links.
        own: dict[int, list[int]] = {}
        for number, w in enumerate(phrase_words):
            own.setdefault(self.automaton.walk(w), []).append(number)
        self.ending: list[list[int]] = []
        for state in range(len(self.automaton.step)):
            found, at = [], state
            while at > 0:
                found += own.get(at, [])
                at = self.automaton.link[at]
            self.ending.append(found)

    def scan(self, text: str) -> tuple[int, list[tuple[str, int]], list[tuple[str, int, int, int, float]]]:
        """``(number of words, [(label, first word) of phrases], [(label, start, end, words covered, cover) of spans])``."""
        step, link, longest, ending = self.automaton.step, self.automaton.link, self.automaton.longest, self.ending
        known = step[0]
        hits: list[tuple[str, int]] = []
        anchors: list[list[tuple[int, int, int]]] = [[] for _ in self.labels]
        state = length = position = 0
        for words in words_of(text):
            for word in words:
                if length >= self.least_match:
                    self._report(anchors, state, length, position, word)
                if word not in known:
                    state = length = 0
                else:
                    while word not in step[state]:
                        state = link[state]
                        length = longest[state]
                    state = step[state][word]
                    length += 1
                    if ending[state]:
                        for number in ending[state]:
                            label, size = self.phrases[number]
                            if size <= length:
                                hits.append((label, position + 1 - size))
                position += 1
        if length >= self.least_match:
            self._report(anchors, state, length, position, None)
        spans = [span for number, found in enumerate(anchors) if found for span in self._chains(number, found)]
        spans.sort(key=lambda s: (s[1], s[2], s[0]))
        return position, hits, _undominated(spans)

    def _report(self, anchors, state: int, length: int, end: int, word: str | None) -> None:
        """Matches that end before text position ``end`` and that ``word`` does not extend in their template.

        The current state has the places of the longest match, its suffix links those of
        shorter ones.
        """
        places = self.automaton.places[state]
        while length >= self.least_match:
            for template, last in places:
                if template < len(anchors):
                    words = self.templates[template]
                    if last + 1 == len(words) or words[last + 1] != word:
                        anchors[template].append((end, last + 1, length))
            places, state = self.extra[state], self.automaton.link[state]
            length = self.automaton.longest[state] if state > 0 else 0

    def _chains(self, template: int, anchors: list[tuple[int, int, int]]):
        """Best chains of ``(text end, template end, length)``; the look-back ends with the gap."""
        best: list[tuple[int, int]] = []  # words covered, first word of the chain
        for i, (end, t_end, length) in enumerate(anchors):
            covered, start = length, end - length
            for j in range(i - 1, -1, -1):
                end_b, t_end_b, _ = anchors[j]
                if end - length - end_b > self.gap:
                    break
                if end_b < end and t_end_b < t_end and t_end - length - t_end_b <= self.gap:
                    gain = best[j][0] + min(length, end - end_b, t_end - t_end_b)
                    if gain > covered:
                        covered, start = gain, best[j][1]
            best.append((covered, start))
        taken: list[tuple[int, int]] = []
        for covered, start, end in sorted(((c, s, a[0]) for (c, s), a in zip(best, anchors)), key=lambda x: (-x[0], x[1])):
            if covered < self.least_cover * self.sizes[template]:
                break
            at = _slot(taken, start)
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
                taken.insert(at, (start, end))
                yield self.labels[template], start, end, covered, covered / self.sizes[template]


def _undominated(spans: list[tuple[str, int, int, int, float]]) -> list[tuple[str, int, int, int, float]]:
    """Spans, by start, without incomplete ones inside a span of more covered words."""
    kept, wide = [], []
    longest = max((end - start for _, start, end, _, _ in spans), default=0)
    for span in sorted(spans, key=lambda s: (s[1], -s[2], -s[3])):
        _, start, end, covered, cover = span
        wide = [o for o in wide if o[1] + longest >= start]
        if cover >= 1 or not any(o[2] >= end and o[3] > covered for o in wide):
            kept.append(span)
        wide.append(span)
    return sorted(kept, key=lambda s: (s[1], s[2], s[0]))


def _slot(taken: list[tuple[int, int]], start: int) -> int:
    from bisect import bisect_left

    return bisect_left(taken, (start, start))


@lru_cache(maxsize=4)
def scanner_of(templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...]) -> LicenceScanner:
    """One scanner per process for each set of templates."""
    return LicenceScanner(templates, phrases)


def default_scanner() -> LicenceScanner:
    return scanner_of(TEMPLATES, PHRASES)


PHRASE_TYPE = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
SPAN_TYPE = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.int64()), ("cover", pa.float64())]))


def _scan(batches: Iterator[pa.RecordBatch], templates=TEMPLATES, phrases_of=PHRASES) -> Iterator[pa.RecordBatch]:
    scanner = scanner_of(templates, phrases_of)
    for batch in batches:
        counts, phrases, spans = [], [], []
        for value in batch.column("text"):
            n, hits, found = scanner.scan(value.as_py() or "")
            counts.append(n)
            phrases.append([{"label": label, "start": start} for label, start in hits])
            spans.append([dict(zip(("label", "start", "end", "covered", "cover"), span)) for span in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(counts, pa.int64()), pa.array(phrases, PHRASE_TYPE), pa.array(spans, SPAN_TYPE)],
            ["key", "n_words", "phrases", "spans"])


def scan_licences(df: DataFrame, key: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """``(key, n_words, phrases, spans)``, one row per input row.

    ``templates`` and ``phrases`` are pairs of a label (first of a template, last of a
    phrase) and wording; the defaults are common notices. They go to every task whole.

    ``phrases`` are all places of the fixed phrases (label, first word), ``spans`` the
    covered template spans (label, first word, end, words covered, share of the template).
    Positions count words from 0. Rows are scanned where they are, text in blocks; nothing
    is shuffled. A null text is empty. Repeated rows and null keys keep their rows; other
    columns are left out.
    """
    rows = pick(df, key=key, text=text)
    schema = f"""key {rows.schema['key'].dataType.simpleString()}, n_words bigint, phrases array<struct<label:string,start:bigint>>,
        spans array<struct<label:string,start:bigint,end:bigint,covered:bigint,cover:double>>"""
    scan = partial(_scan, templates=tuple(map(tuple, templates)), phrases_of=tuple(map(tuple, phrases)))
    return rows.mapInArrow(scan, schema).withColumnRenamed("key", key)
