"""Spelling variants against brute force over all one-letter changes."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF

from corvid.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(rows):
    """rows: (id, text); words of six letters that occur five times, after the dealt deletions."""
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def near_of(word, known, letters):
    cut = {word[:i] + word[i + 1:] for i in range(len(word))}
    put = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    other = {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    return [w for w in (cut | put | other) - {word} if w in known]


def brute(known):
    letters, form, out = sorted({c for w in known for c in w}), {}, {}
    for word, n in known.items():
        near = near_of(word, known, letters)
        best = min(near, key=lambda w: (-known[w], w), default=None)
        form[word] = best if best and known[best] >= 5 * n else None
        out[word] = (form[word], n, len(near), known[best] if form[word] else None)
    for word in known:
        root = word
        while form[root]:
            root = form[root]
        f, n, n_near, form_n = out[word]
        out[word] = (f, root, n, n_near, form_n)
    return out


def as_dict(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark, documents):
    known = count_words([(r.doc_id, r.text) for r in documents.collect()])
    assert as_dict(queries.QUERIES["op11_spelling"](spark, SF)) == brute(known)


@pytest.mark.parametrize("slice_words", [3, 16_384])
def test_dense_words(spark, slice_words):
    """Few letters, so that most words have near ones, runs of equal letters and chains; slices cut
    into many indexes give the same."""
    rng = random.Random(5)
    known = {}
    for _ in range(1500):
        word = "".join(rng.choice("abé") for _ in range(rng.choice([6, 6, 7, 7, 8, 9, 12])))
        known[word] = 5 ** rng.randint(1, 6) + rng.randint(0, 2)
    known["aaaaaa"], known["aaaaaaa"], known["aaaaaaaa"] = 5, 25, 125
    words = spark.createDataFrame(list(known.items()), "word string, n long")
    assert as_dict(spelling.group_variants(words, slice_words=slice_words)) == brute(known)


def test_vocabulary(spark):
    long_text = " ".join(["ABCDEFÉ×÷ÿ", "abcdefĀghijklm", "plants Plants", "tiny"] * 4000) + "x" * 100_000
    rows = [(i, long_text) for i in range(3)] + [(None, long_text), (7, None), (8, ""), (1, long_text)]
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n long, word string")
    got = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert got == count_words(rows)


def test_odd_rows(odd, empty):
    assert spelling.group_variants(spelling.vocabulary(empty)).collect() == []
    known = count_words([(r.doc_id, r.text) for r in odd.collect()])
    assert as_dict(spelling.group_variants(spelling.vocabulary(odd))) == brute(known)
