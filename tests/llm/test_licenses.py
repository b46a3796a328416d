"""License scan against an alignment of every template at every place, on changed and absent licenses."""

import random

import pytest

from corvid.llm import licenses as x


def brute(text):
    """Names that the scan's rules give if every diagonal of every template is aligned."""
    words = x.tokenise([x._lower(text)], x._CLASSES).hash
    found = []
    for name in sorted(x.TEMPLATES):
        template = x.tokenise([x._lower(x.TEMPLATES[name])], x._CLASSES).hash
        if len(template) >= x.FULL:
            continue
        for diagonal in range(-len(template), len(words)):
            n, first, last = x.align(template, words, diagonal)
            if n >= x.MIN_COVERAGE * len(template) and x.same_marks(template, words[first: last + 1]):
                found.append((-n, first, name, last))
    out = []
    for _, first, name, last in sorted(found):
        if all(last < a or b < first for _, a, b in out):
            out.append((name, first, last))
    return [name for name, _, _ in sorted(out, key=lambda m: m[1])]


def names(text):
    return [m[0] for m in x._matches([text], x._index(x.TEMPLATES))[0]]


ABSENT = {"gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
          "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                         "Lesser General Public License as published by the Free Software Foundation",
          "cc-by-nc-sa-4.0": "Licensed under CC BY-NC-SA 4.0.",
          "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3."}


@pytest.mark.parametrize("name", ABSENT)
def test_neighbours(name):
    text = "Some words before. " + ABSENT[name] + " And some behind."
    assert names(text) == brute(text) == [name]


@pytest.mark.parametrize("text", ["This work is licensed under the GNU General Public License, version 7.",
                                  "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-NC 2.0.",
                                  "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.0."])
def test_absent_versions(text):
    assert names(text) == brute(text) == []


def test_changed_notices():
    draw = random.Random(5)
    for name, template in x.TEMPLATES.items():
        words = template.split()
        if not 12 <= len(words) < x.FULL:
            continue
        at = draw.randrange(4, len(words) - 4)
        for text in (template, " ".join(words[:at] + ["also"] + words[at:])):
            assert names(text) == brute(text) == [name]


def test_full_texts():
    full = [n for n in x.TEMPLATES if n.endswith("-text")]
    assert {"gpl-2.0-text", "gpl-3.0-text", "lgpl-2.1-text", "mit-text", "bsd-3-clause-text", "cc0-1.0-text"} <= set(full)
    for name in full:
        text = "Words before it.\n" + x.TEMPLATES[name]
        best = max(x._matches([text], x._index(x.TEMPLATES))[0], key=lambda m: m[2] - m[1])
        assert best[0] == name and best[3] == 1 and best[2] >= len(text.rstrip()) - 4


def _changed(words, kind, k, draw):
    """``words`` with k words put in, left out or replaced in the middle third."""
    at = draw.randrange(len(words) // 3, 2 * len(words) // 3)
    junk = [f"zq{draw.randrange(9999)}" for _ in range(k)]
    return words[:at] + (junk if kind != "delete" else []) + words[at + (k if kind != "insert" else 0):]


@pytest.mark.parametrize("kind,k", [("insert", 8), ("insert", 12), ("insert", 50), ("delete", 12), ("delete", 40), ("replace", 12),
                                    ("replace", 40)])
def test_recall_of_changed_full_texts(kind, k):
    """Full texts with one change in the middle; those that keep less than MIN_COVERAGE are not meant."""
    draw, found, tried, index = random.Random(k), 0, 0, x._index(x.TEMPLATES)
    for name in (n for n in x.TEMPLATES if n.endswith("-text")):
        words = x.TEMPLATES[name].split()
        if kind != "insert" and k > 0.18 * len(words):
            continue
        text = "Words before. " + " ".join(_changed(words, kind, k, draw)) + " Words behind."
        tried += 1
        found += any(m[0] == name for m in x._matches([text], index)[0])
    assert tried >= 12 and found >= 0.9 * tried, (found, tried)


def test_two_changed_copies_in_one_text():
    draw = random.Random(2)
    words = x.TEMPLATES["mit-text"].split()
    text = " ".join(_changed(words, "insert", 20, draw) + ["and", "again"] + _changed(words, "insert", 30, draw))
    assert names(text) == ["mit-text", "mit-text"]


def test_absent_clause_is_not_another_license():
    index = x._index(x.TEMPLATES)
    for name in ("bsd-2-clause-text", "bsd-3-clause-text", "isc-text"):
        assert [m[0] for m in x._matches(["Words before.\n" + x.TEMPLATES[name]], index)[0]] == [name]


def test_many_copies_in_one_text():
    assert names((x.TEMPLATES["mit-text"] + "\n") * 150) == ["mit-text"] * 150
