"""License scans by matching statistics of a generalised suffix automaton."""

from __future__ import annotations

import pkgutil
import re

from pyspark.sql import DataFrame

from riskloom.llm.common import map_batches

# Base phrases and their labels, and well-known license wording. A label's
# templates are its one-line notices and longer excerpts; full texts are files.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES: dict[str, list[str]] = {
    "agpl": [
        "licensed under the gnu affero general public license version 3",
        "licensed under the gnu affero general public license",
    ],
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    ],
    "bsd": [
        "licensed under the bsd license",
        "released under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    ],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0"],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 2",
        "licensed under the gnu general public license",
    ],
    "gpl-notice": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation"
    ],
    "isc": [
        "licensed under the isc license",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license version 2 1",
        "licensed under the gnu lesser general public license version 3",
        "licensed under the gnu lesser general public license",
    ],
    "mit": ["released under the mit license", "licensed under the mit license"],
    "mit-text": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including without "
        "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
        "software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no "
        "event shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
        "action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ],
    "mpl-2.0": [
        "licensed under the mozilla public license version 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
FULL_TEXTS = {
    "apache-2.0": "Apache-2.0", "bsd": "BSD", "cc0": "CC0-1.0", "gpl": "GPL-3", "gpl-2": "GPL-2",
    "lgpl": "LGPL-2.1", "lgpl-3": "LGPL-3", "mpl-2.0": "MPL-2.0",
}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
MIN_MATCH = 3  # words of a match that counts
MAX_GAP = 2  # words between chained matches
MIN_COVER = 0.8  # of a template


class SuffixAutomaton:
    """A generalised suffix automaton of token sequences.

    Each state keeps its longest length, its suffix link and which templates it occurs in
    (with the ends of its occurrences), so a match of a streamed file names its templates.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]
        for k, tokens in enumerate(sequences):
            last = 0
            for i, token in enumerate(tokens):
                last = self._extend(last, token)
                self.ends[last].setdefault(k, []).append(i)
        # A state occurs wherever a state that links to it occurs.
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            for k, places in self.ends[state].items():
                self.ends[self.link[state]].setdefault(k, []).extend(places)

    def _new(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, parent: int, child: int, token: int) -> int:
        """The part of ``child`` that is one longer than ``parent`` as a state of its own."""
        clone = self._new(self.length[parent] + 1)
        self.next[clone] = dict(self.next[child])
        self.link[clone] = self.link[child]
        self.link[child] = clone
        while parent != -1 and self.next[parent].get(token) == child:
            self.next[parent][token] = clone
            parent = self.link[parent]
        return clone

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, token)
        state, parent = self._new(self.length[last] + 1), last
        while parent != -1 and token not in self.next[parent]:
            self.next[parent][token] = state
            parent = self.link[parent]
        if parent == -1:
            self.link[state] = 0
        else:
            child = self.next[parent][token]
            fits = self.length[child] == self.length[parent] + 1
            self.link[state] = child if fits else self._split(parent, child, token)
        return state

    def maximal_matches(self, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """(start, end, state) of matches that can't be made longer, over (place, token).

        Words outside the vocabulary are left out of ``tokens``; a jump in the places
        ends the match. The state and length after each token are the file's matching
        statistics.
        """
        out = []
        state = size = 0
        before = -2
        for place, token in tokens:
            if place != before + 1:
                if size >= MIN_MATCH:
                    out.append((before + 1 - size, before + 1, state))
                state = size = 0
            elif token not in self.next[state] and size >= MIN_MATCH:
                out.append((before + 1 - size, before + 1, state))
            while state and token not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if token in self.next[state]:
                state, size = self.next[state][token], size + 1
            else:
                state = size = 0
            before = place
        if size >= MIN_MATCH:
            out.append((before + 1 - size, before + 1, state))
        return out

    def template_matches(self, tokens: list[tuple[int, int]], least: list[int]) -> list[tuple[int, int, int, list[int]]]:
        """(template, start, end, ends in the template) of each template's own maximal matches.

        A template's matching statistic is the length of the first state on the path of
        suffix links that occurs in it, so wording that is longer in one template hides
        no match of another. Matches shorter than ``least`` of their template don't count.
        """
        shortest, out = min(least, default=1), []
        held: dict[int, tuple[int, int, list[int]]] = {}
        state = size = 0
        before = -2
        for place, token in tokens:
            if place != before + 1:
                state = size = 0
                out += [(k, *m) for k, m in held.items()]
                held = {}
            while state and token not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if token in self.next[state]:
                state, size = self.next[state][token], size + 1
            else:
                state = size = 0
            before = place
            if size < shortest and not held:
                continue
            now: dict[int, tuple[int, int, list[int]]] = {}
            at, n = state, size
            while n >= shortest:
                for k, places in self.ends[at].items():
                    if n >= least[k] and k not in now:
                        now[k] = (place + 1 - n, place + 1, places)
                at = self.link[at]
                n = self.length[at] if at >= 0 else 0
            out += [(k, *m) for k, m in held.items() if k not in now or now[k][0] != m[0]]
            held = now
        return out + [(k, *m) for k, m in held.items()]


def template_words(text: str) -> list[str]:
    return WORD.findall(text.translate(UPPER))


def stated_templates() -> dict[str, list[str]]:
    """The notices of ``TEMPLATES`` with the full texts."""
    full = {k: pkgutil.get_data(__package__, f"license_texts/{v}.txt").decode() for k, v in FULL_TEXTS.items()}
    return {k: [*TEMPLATES.get(k, []), *([full[k]] if k in full else [])] for k in sorted({*TEMPLATES, *full})}


class Scanner:
    """The vocabulary, the automaton and the base phrases, built once per task."""

    def __init__(self, templates: dict[str, list[str]] | None = None, base: dict[str, str] = BASE):
        pairs = [(k, template_words(t)) for k, ts in sorted((stated_templates() if templates is None else templates).items()) for t in ts]
        self.labels = [k for k, w in pairs if w]
        words = [w for _, w in pairs if w]
        phrases = [p.split() for p in base]
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for s in [*words, *phrases] for w in s}))}
        self.sizes = [len(s) for s in words]
        self.least = [min(MIN_MATCH, n) for n in self.sizes]
        self.automaton = SuffixAutomaton([[self.vocabulary[w] for w in s] for s in words])
        self.base = [(tuple(self.vocabulary[w] for w in p), base[" ".join(p)]) for p in phrases]
        self.opening = {}
        for p, label in self.base:
            self.opening.setdefault(p[0], []).append((p, label))

    def spans(self, tokens: list[tuple[int, int]]) -> list[tuple[str, int, int, float, int]]:
        """(label, first word, end, share covered, words matched) of each template's chained matches.

        A match joins a chain of its template if it starts at most ``MAX_GAP`` words after
        it and stands at about the same shift in the template as the chain before. Words
        that occur in a template several times keep all their shifts until one is left.
        """
        chains: dict[int, list[list]] = {}
        for k, start, end, places in sorted(self.automaton.template_matches(tokens, self.least), key=lambda m: m[2]):
            shifts, own = {i + 1 - end for i in places}, chains.setdefault(k, [])
            for chain in reversed(own):
                if chain[1] + MAX_GAP < start:
                    chain = None
                    break
                near = {s for s in shifts if any(s + d in chain[3] for d in range(-MAX_GAP, MAX_GAP + 1))}
                if near:
                    chain[2] += max(0, end - max(start, chain[1]))
                    chain[1], chain[3] = max(end, chain[1]), near
                    break
            else:
                chain = None
            if chain is None:
                own.append([start, end, end - start, shifts])
        return sorted(
            (self.labels[k], a, b, min(1.0, n / self.sizes[k]), n) for k, found in chains.items() for a, b, n, _ in found
        )

    @staticmethod
    def best(spans: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float, int]]:
        """The spans that cover enough, but those inside a span that matches more words, or as many better."""
        found: list[tuple[str, int, int, float, int]] = []
        for s in sorted((s for s in spans if s[3] >= MIN_COVER), key=lambda s: (-s[4], -s[3], s)):
            if not any(t[1] <= s[1] and s[2] <= t[2] for t in found):
                found.append(s)
        return sorted(found)

    def scan(self, text: str) -> dict:
        words = WORD.findall(text.translate(UPPER))
        get = self.vocabulary.get
        tokens = [(i, t) for i, t in enumerate(map(get, words)) if t is not None]
        starts, labels = [], set()
        at = dict(tokens) if any(t in self.opening for _, t in tokens) else {}
        for place, token in tokens:
            for phrase, label in self.opening.get(token, ()):
                if all(at.get(place + j) == t for j, t in enumerate(phrase)):
                    starts.append(place)
                    labels.add(label)
        spans = self.spans(tokens)
        found = self.best(spans)
        return {
            "n_words": len(words),
            "n_base": len(starts),
            "first_word": min(starts) if starts else None,
            "last_word": max(starts) if starts else None,
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | {s[0] for s in found})),
            "score": 1.0 if starts else max((s[3] for s in spans), default=0.0),
            "spans": ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in found),
        }


ADDED = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
)


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | DataFrame | None = None) -> DataFrame:
    """License wording of every whole text: base phrases, template spans and a score.

    A file is streamed once through a generalised suffix automaton of the templates'
    tokens; its state and match length after each word are the matching statistics.
    Matches of at least ``MIN_MATCH`` words are chained within a template over gaps of at
    most ``MAX_GAP`` words; a chain that covers ``MIN_COVER`` of it is a span and gives the
    template's label, unless it lies inside a span that matches more. ``templates`` has a
    label's texts, as a dictionary or as a table (label, text), instead of the stated
    notices and full texts. Base phrases are read off the same token stream. ``score`` is 1 with
    a base phrase, else the largest share of a template that a chain covers. The automaton
    holds the templates only, so a task's memory is that and one batch of texts.

    A null or empty text has 0 words, null places, empty labels and score 0. Rows with
    repeated or null ids are scanned on their own; an empty table gives an empty one;
    further columns are ignored. Nothing is shuffled.
    """

    if isinstance(templates, DataFrame):
        rows = templates.select("label", "text").filter("label IS NOT NULL AND text IS NOT NULL").collect()
        templates = {k: [t for label, t in rows if label == k] for k in {label for label, _ in rows}}
    if templates is None:
        templates = stated_templates()

    def start():
        one = Scanner(templates)

        def scan(texts: list) -> dict:
            rows = [one.scan(t or "") for t in texts]
            return {c: [r[c] for r in rows] for c in rows[0]} if rows else {c.split()[0]: [] for c in ADDED.split(", ")}

        return scan

    return map_batches(docs.select("doc_id", "text"), start, ADDED)
