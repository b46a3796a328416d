"""License scan: winnowed fingerprints of license templates in an inverted index pick the
candidates, and a banded alignment of template and text words reports what is matched.

Words are runs of letters and digits, compared in lower case. The fingerprints of a word
sequence are the smallest hash of every ``WINDOW`` consecutive ``GRAM``-word hashes, so a text and
a template that share ``GRAM + WINDOW - 1`` words in a row share a fingerprint. Every shared
fingerprint names a template and a diagonal (place in the text less place in the template);
diagonals within a band of each other are aligned once, at most a band off the diagonal. The
band is a quarter of the template's words, ``BAND`` at most.
Candidates that can't have enough words within their band are passed over first. In a full text
words may be put in or left out: shared fingerprints whose diagonals lie up to ``CHAIN`` words apart,
one after the other in template and text, are a chain, and its alignment is that of its
stretches, each within a band of its own diagonal.
A match must have the template's ``MARKS`` (names and versions that tell licenses apart) in their
order and no others; of a full text, those of its title.
A match reports the share of the template's words that are aligned (``coverage``) and the span from
the first to the last of them; it counts from ``MIN_COVERAGE``. Of matches that overlap the
one with the most aligned words stays.

Defined results: null and empty texts match nothing. Spans count code points, end exclusive.
Ties go to the earlier start, then the template that comes first by name.
"""

from __future__ import annotations

from bisect import bisect_left
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corvid.llm.common import add_columns, fresh, text_portions
from corvid.llm.tokens import Tokens, tokenise, windows

GRAM, WINDOW, BAND = 3, 3, 8
MIN_COVERAGE = 0.8
#: Words put in or left out between two stretches of a full text, hits looked back at for the one
#: before, and the share of a template's fingerprints that a chain has at least.
CHAIN, LOOK, LEAST = 64, 48, 0.4

#: Notices of public licenses.
TEMPLATES = {
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "Affero General Public License as published by the Free Software Foundation",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                  "is hereby granted, provided that the above copyright notice and this permission notice appear in "
                  "all copies.",
    "mit": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
}

_GNU = ("This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
        "License as published by the Free Software Foundation")
_CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
TEMPLATES |= {
    "cc-by-4.0-short": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-line": _CC.format("-NonCommercial"),
    "cc-by-nc-nd-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-nc-nd-4.0-line": _CC.format("-NonCommercial-NoDerivatives"),
    "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-sa-4.0-line": _CC.format("-NonCommercial-ShareAlike"),
    "cc-by-nd-4.0": "Licensed under CC BY-ND 4.0.",
    "cc-by-nd-4.0-line": _CC.format("-NoDerivatives"),
    "cc-by-sa-4.0-short": "Licensed under CC BY-SA 4.0.",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                      "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-notice-library": _GNU.format("library", ""),
    "agpl-3.0-library": _GNU.format("library", "Affero "),
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "lgpl-notice": _GNU.format("library", "Lesser "),
    "lgpl-notice-program": _GNU.format("program", "Lesser "),
    "lgpl-2.0-notice": _GNU.format("library", "Library "),
}
# full texts, as files of their names
TEMPLATES |= {f"{path.stem}-text": path.read_text() for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}

#: Words that tell licenses apart, besides numbers; words from which on a template is
#: a full text, and those of its title.
MARKS = frozenset("affero lesser library noncommercial nc sharealike sa noderivatives noderivs nd eclipse mozilla "
                  "apache".split())
FULL, TITLE = 100, 12

_CLASSES = np.zeros(256, dtype=np.uint8)
_CLASSES[128:] = 1
_CLASSES[[*range(48, 58), *range(97, 123)]] = 1


def _lower(text: str) -> str:
    """A-Z in lower case; the number of code points and bytes stays."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def fingerprints(grams: np.ndarray) -> np.ndarray:
    """Places of the winnowed fingerprints: the last smallest hash of every window."""
    n = len(grams)
    if not n:
        return np.zeros(0, dtype=np.int64)
    width = min(WINDOW, n)
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    return np.unique(np.arange(len(view)) + width - 1 - np.argmin(view[:, ::-1], axis=1))


def band(template: np.ndarray) -> int:
    return max(1, min(BAND, len(template) // 4))


def _hashes(words) -> np.ndarray:
    return np.array([tokenise([w], _CLASSES).hash[0] for w in words], dtype=np.uint64)


_MARKS = np.concatenate([_hashes(sorted(MARKS)), _hashes(map(str, range(100)))])
_NAMES = _MARKS[:len(MARKS)]


def marks(words: np.ndarray, of: np.ndarray = _MARKS) -> list[int]:
    return words[np.isin(words, of)].tolist()


def same_marks(template: np.ndarray, matched: np.ndarray) -> bool:
    """Whether ``matched``, the span of a match, has the marks of its template."""
    if len(template) < FULL:
        return marks(template) == marks(matched)
    left = iter(marks(matched[: 2 * TITLE]))
    return (all(m in left for m in marks(template[:TITLE]))
            and set(marks(template[: 2 * TITLE], _NAMES)) == set(marks(matched[: 2 * TITLE], _NAMES)))


def within_band(template: np.ndarray, text: np.ndarray, diagonal: int, off: int | None = None) -> int:
    """Template words that the text has at most a band off the diagonal: no alignment has more."""
    off, found = band(template) if off is None else off, np.zeros(len(template), dtype=bool)
    for shift in range(diagonal - off, diagonal + off + 1):
        lo, hi = max(0, -shift), min(len(template), len(text) - shift)
        if lo < hi:
            found[lo:hi] |= template[lo:hi] == text[lo + shift: hi + shift]
    return int(found.sum())


class Index:
    """Inverted index: sorted fingerprints with the template and place of each."""

    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.names = sorted(templates)
        self.words, self.count = [], []
        entries = []
        for number, name in enumerate(self.names):
            words = tokenise([_lower(templates[name])], _CLASSES).hash
            self.words.append(words)
            grams = windows(words, min(GRAM, len(words)))
            chosen = fingerprints(grams)
            self.count.append(len(chosen))
            entries += [(int(grams[at]), number, int(at)) for at in chosen]
        entries.sort()
        self.keys = np.array([e[0] for e in entries], dtype=np.uint64)
        self.found = [(e[1], e[2]) for e in entries]

    def hits(self, grams: np.ndarray) -> list[tuple[int, int]]:
        """(template, diagonal) pairs of a text's grams; diagonals closer than the band are one."""
        if not len(grams) or not len(self.keys):
            return []
        known = self.keys[np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)] == grams
        if not known.any():
            return []
        out: list[tuple[int, int]] = []
        for number, diagonal in sorted({(number, at - place) for number, place, at in self._shared(grams, known)}):
            if not out or out[-1][0] != number or diagonal - out[-1][1] > band(self.words[number]):
                out.append((number, diagonal))
        return out

    def _shared(self, grams: np.ndarray, known: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, place in it, place in the text) of the shared fingerprints."""
        chosen, out = fingerprints(grams), []
        for at in chosen[known[chosen]].tolist():
            lo, hi = np.searchsorted(self.keys, grams[at], side="left"), np.searchsorted(self.keys, grams[at], side="right")
            out += [(number, place, at) for number, place in self.found[lo:hi]]
        return out

    def chains(self, grams: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
        """(template, stretches) of the full texts that a text holds in several stretches; a stretch is its
        first place in the template and its diagonal."""
        if not len(grams) or not len(self.keys):
            return []
        known = self.keys[np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)] == grams
        if not known.any():
            return []
        held: dict[int, list[tuple[int, int]]] = {}
        for number, place, at in self._shared(grams, known):
            if len(self.words[number]) >= FULL:
                held.setdefault(number, []).append((at, place))
        out = []
        for number, hits in held.items():
            least, off = LEAST * self.count[number], band(self.words[number]) // 2
            hits.sort()
            for chain in _chains(hits, off, least):
                stretches = [(0, chain[0][0] - chain[0][1])]
                for at, place in chain:
                    if abs(at - place - stretches[-1][1]) > off:
                        stretches.append((place, at - place))
                if len(stretches) > 1:
                    out.append((number, stretches))
        return out


def _chains(hits: list[tuple[int, int]], off: int, least: float) -> list[list[tuple[int, int]]]:
    """Chains of (place in the text, place in the template) that rise together, a change of the diagonal
    beyond ``off`` costing two hits: the longest first, without hits of longer ones, as long as they
    have ``least`` hits. ``hits`` are in order."""
    score, back = [1.0] * len(hits), [-1] * len(hits)
    for i, (at, place) in enumerate(hits):
        for j in range(i - 1, max(-1, i - LOOK - 1), -1):
            then, before = hits[j]
            if at - then > 4 * CHAIN:
                break
            shift = abs((at - place) - (then - before))
            if before < place and then < at and shift <= CHAIN:
                got = score[j] + (1.0 if shift <= off else -1.0)
                if got > score[i]:
                    score[i], back[i] = got, j
    used, out = [False] * len(hits), []
    for i in sorted(range(len(hits)), key=lambda i: -score[i]):
        if score[i] < least / 2:
            break
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(hits[i])
            i = back[i]
        if len(chain) >= least:
            out.append(chain[::-1])
    return out


def align(template: np.ndarray, text: np.ndarray, diagonal: int, off: int | None = None) -> tuple[int, int, int]:
    """(aligned words, first, last place in the text) of the best banded alignment: a longest
    common subsequence at most a band off the diagonal, of least extent among the longest."""
    off = band(template) if off is None else off
    width = 2 * off + 1
    # state per offset in the band: (aligned, -extent, first, last)
    none = (0, 0, -1, -1)
    row = [none] * (width + 1)
    best = none
    for i, word in enumerate(template):
        new = [none] * (width + 1)
        for k in range(width):
            j = i + diagonal + k - off
            # template word i against text word j; skipping a template word moves one offset up
            state = max(row[k + 1], new[k - 1] if k else none)
            if 0 <= j < len(text) and text[j] == word:
                n, _, first, _ = row[k]
                first = j if first < 0 else first
                state = max(state, (n + 1, first - j, first, j))
            new[k] = state
            best = max(best, state)
        row = new
    return best[0], best[2], best[3]


def _parts(template: np.ndarray, stretches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(first place, end, diagonal) of each stretch in the template."""
    ends = [place for place, _ in stretches[1:]] + [len(template)]
    return [(place, end, diagonal) for (place, diagonal), end in zip(stretches, ends)]


def within_chain(template: np.ndarray, text: np.ndarray, stretches: list[tuple[int, int]]) -> int:
    """``within_band`` of a chain: no alignment of its stretches has more."""
    off = band(template)
    return sum(within_band(template[place:end], text, place + diagonal, off)
               for place, end, diagonal in _parts(template, stretches))


def align_chain(template: np.ndarray, text: np.ndarray, stretches: list[tuple[int, int]]) -> tuple[int, int, int]:
    """``align`` of a chain: its stretches one after the other, each with the text behind the last."""
    off, total, first, last = band(template), 0, -1, -1
    for place, end, diagonal in _parts(template, stretches):
        n, a, b = align(template[place:end], text[last + 1:], place + diagonal - last - 1, off)
        if n:
            first = last + 1 + a if first < 0 else first
            total, last = total + n, last + 1 + b
    return total, first, last


def scan(words: np.ndarray, index: Index) -> list[tuple[str, int, int, float]]:
    """(template, first word, last word, coverage) of the matches in a text's word hashes."""
    found = []
    grams = windows(words, GRAM)
    for number, diagonal in index.hits(grams):
        template = index.words[number]
        if len(words) < MIN_COVERAGE * len(template) or within_band(template, words, diagonal) < MIN_COVERAGE * len(template):
            continue
        aligned, first, last = align(template, words, diagonal)
        if aligned >= MIN_COVERAGE * len(template) and same_marks(template, words[first: last + 1]):
            found.append((-aligned, first, index.names[number], last, aligned / len(template)))
    for number, stretches in index.chains(grams):
        template = index.words[number]
        if len(words) < MIN_COVERAGE * len(template) or within_chain(template, words, stretches) < MIN_COVERAGE * len(template):
            continue
        aligned, first, last = align_chain(template, words, stretches)
        if aligned >= MIN_COVERAGE * len(template) and same_marks(template, words[first: last + 1]):
            found.append((-aligned, first, index.names[number], last, aligned / len(template)))
    out: list[tuple[str, int, int, float]] = []  # disjoint, in text order
    for _, first, name, last, coverage in sorted(found):
        at = bisect_left(out, first, key=lambda m: m[1])
        if (at == 0 or out[at - 1][2] < first) and (at == len(out) or last < out[at][1]):
            out.insert(at, (name, first, last, coverage))
    return out


def _matches(texts: list[str], index: Index) -> list[list[tuple[str, int, int, float]]]:
    tokens: Tokens = tokenise([_lower(t) for t in texts], _CLASSES)
    out, at, offset = [], 0, 0
    for text, n in zip(texts, tokens.counts.tolist()):
        found, place, chars = [], 0, 0
        raw = text.encode("utf-8", "surrogatepass")

        def code_points(byte: int) -> int:
            """Code points before ``byte``, counted on from the last one asked for."""
            nonlocal place, chars
            chars += len(raw[place: byte].decode("utf-8", "surrogatepass"))
            place = byte
            return chars

        for name, first, last, coverage in scan(tokens.hash[at: at + n], index):
            start = code_points(int(tokens.starts[at + first]) - offset)
            found.append((name, start, code_points(int(tokens.ends[at + last]) - offset), coverage))
        out.append(found)
        at += n
        offset += len(raw) + 1
    return out


_INDEXES: dict[tuple, Index] = {}


def _index(templates: dict[str, str]) -> Index:
    """This worker's index of ``templates``."""
    key = tuple(sorted(templates.items()))
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(templates)
    return _INDEXES[key]


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_licenses``, ``licenses`` (names, by first appearance) and ``spans``
    (name:start:end:coverage in percent, joined by commas)."""
    at = docs.columns.index(text_col)

    def found(batch):
        index = _index(templates)
        rows = [r for texts in text_portions(batch.column(at)) for r in _matches(texts, index)]
        names = [list(dict.fromkeys(m[0] for m in r)) for r in rows]
        spans = [",".join(f"{n}:{a}:{b}:{int(100 * c)}" for n, a, b, c in r) for r in rows]
        return [pa.array([len(r) for r in rows], pa.int64()), pa.array(names, pa.list_(pa.string())),
                pa.array(spans, pa.string())]

    return add_columns(docs, found, [T.StructField(fresh(docs, "n_licenses"), T.LongType()),
                                     T.StructField(fresh(docs, "licenses"), T.ArrayType(T.StringType())),
                                     T.StructField(fresh(docs, "spans"), T.StringType())])
