"""Line-first quality rules: base figures against brute force, verdicts against labels."""

import re

import pytest

from corvid.llm import clean_lines as c
from corvid.llm import queries

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = {}
    for r in runs:
        count[r] = count.get(r, 0) + 1
    covered = {j for i, r in enumerate(runs) if count[r] > 1 for j in range(i, i + 5)}
    lines = text.split("\n")
    dup = sum(1 for i, ln in enumerate(lines) if WORD.search(ln) and ln in lines[:i])
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return [len(words), sum(map(len, words)), sum(ch in c.SYMBOLS for ch in text), dup, len(covered), failed]


def test_query_base_figures(spark, documents):
    text = {r.doc_id: r.text for r in documents.collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in queries.QUERIES["op4_clean_lines"](spark, "/root/testdata/sf0.001").collect():
        assert [r[n] for n in names] == brute(text[r.doc_id])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text", ["", " \n\t", "a b c d e a b c d e", "a a a a a a a", "x\ny\nx\n\n\nx", "é\x85ü # $ 漢字\x1c|",
                                  "a b c d e f " * 4, "a b c d e"])
def test_small_texts(text):
    assert c._figures([text])[0][:6] == brute(text)
    assert c._figures(["other words here", text, "x"])[1][:6] == brute(text)


def test_rules():
    def fault(line):
        return c.line_fault(line, line.split())
    assert fault("Home | About | Contact | Login") == "navigation"
    assert fault("Home About Contact") == "navigation"
    assert fault("BUY!! NOW!! AND!! SAVE!! MORE!! TODAY!!") == "punctuation"
    assert fault("a ### b $$$ c %%% d &&&") == "punctuation"
    assert fault("Please enable JavaScript to view this page.") == "boilerplate"
    assert fault("spam spam spam spam spam spam spam spam") == "boilerplate"
    assert fault("A plain sentence, with (some) marks; and an end.") is None
    assert fault("") is None
    cleaned, words, lost, faults = c.clean_text("A line that stays.\nHome | About | Contact | Login\n\nThe end.")
    assert cleaned == "A line that stays.\n\nThe end." and (words, lost, faults) == (13, 7, {"navigation": 1})


@pytest.mark.parametrize("line, rule", [
    ("a + - ? ; @ ( ) [ b", "punctuation"), ("+ - ? ; @ ( ) [ ] , . : '", "punctuation"),
    ("Home / Shop / Men / Shoes", "navigation"), ("Home :: Forum :: Topic", "navigation"),
    ("Home / Shop :: Men", "navigation"), ("Home > Shop / Men", "navigation")])
def test_lines_are_judged_by_themselves(line, rule):
    plain = "A plain line that stays, with nothing else in it."
    for other in (plain, plain + "\nWow!! Some | marks << here, in an unrelated line."):
        for text in (line, f"{line}\n{other}", f"{other}\n{line}"):
            cleaned, _, lost, faults = c.clean_text(text)
            assert faults == {rule: 1} and lost == len(line.split()) and line not in cleaned.split("\n")
    for kept in ("either this and/or that / these, as in std::vector", "a plain line :: of two parts of many words"):
        assert c.clean_text(kept)[0] == kept


def test_verdicts_follow_the_labels(documents, labels):
    got = c.judge(documents).join(labels, "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert (good.kept | good.base_failed).all() and bad.kept.mean() < 0.1


def test_odd_rows(odd, empty):
    out = c.judge(odd)
    assert out.columns == odd.columns + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                         "base_failed", "_kept", "n_lost_words", "cleaned"]
    for r in out.collect():
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] == brute(r.text)
    kept = c.clean(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} <= {1, 2, 6}
    assert c.judge(empty).count() == 0 and c.clean(empty).count() == 0
