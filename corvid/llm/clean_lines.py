"""Line-first quality rules.

Every line is judged by itself: punctuation (signs outweigh letters, shouting, marks glued to
most words), navigation (words between separators, menu entries) and boilerplate (cookie
notices, script warnings, placeholder text; one word said over and over). Lines that fail are
removed; a document that loses more than ``MAX_LOSS`` of its words is rejected, as is one that
fails the base rules: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT`` of them in
five-word windows that occur twice.

Defined results: null and empty texts have no words and fail the base rules; texts that have
only white space too. Every row is judged by itself, so repeated rows get the same result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corvid.llm.common import SPACE, add_columns, fresh, text_portions
from corvid.llm.tokens import tokenise, windows

MIN_WORDS = 10
MAX_REPEAT = 0.2
MAX_LOSS = 0.5
WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: Entries of menus and phrases of page furniture, in lower case.
MENU = frozenset("home login register contact about search menu sitemap next previous share print".split())
BOILERPLATE = ("lorem ipsum", "cookie policy", "privacy policy", "terms of use", "terms of service",
               "all rights reserved", "enable javascript", "javascript is disabled", "click here to",
               "sign up for our newsletter", "page not found")
_SEPARATOR = frozenset({"|", "»", "›", "·", "•", ">", "::", "/"})
_MARKED = re.compile(r"[!?]{2,}|[#*$%&<>~^=_]{2,}")


_BARS = "|»›·•>"


def line_fault(line: str, words: list[str], may: tuple[bool, bool, bool] = (True, True, True)) -> str | None:
    """Name of the rule that the line fails: punctuation, navigation, boilerplate or None.

    ``may``: whether the text has any separators, glued marks and boilerplate phrases at all.
    """
    n = len(words)
    if not n:
        return None
    bars = sum(map(line.count, _BARS)) + words.count("/") + words.count("::") if may[0] else 0
    if bars >= 2 and bars + sum(w in _SEPARATOR for w in words) >= 0.5 * n:
        return "navigation"
    if n <= 8 and all(w.strip(".,:;!|").lower() in MENU for w in words):
        return "navigation"
    if may[1] and n >= 2 and len(_MARKED.findall(line)) >= 0.3 * n:
        return "punctuation"
    if n >= 4 and sum(map(str.isalnum, line)) < 0.5 * sum(map(len, words)):
        return "punctuation"
    if n >= 6 and line.isupper() and line.count("!") >= 0.3 * n:
        return "punctuation"
    if may[2] and any(phrase in line.lower() for phrase in BOILERPLATE):
        return "boilerplate"
    if n >= 6 and len(set(words)) < 0.35 * n:
        return "boilerplate"
    return None


def clean_text(text: str) -> tuple[str, int, int, dict[str, int]]:
    """(text without failed lines, words before, words removed, failed lines per rule)."""
    lowered = text.lower()
    may = (any(bar in text for bar in (*_BARS, "/", "::")), _MARKED.search(text) is not None,
           any(phrase in lowered for phrase in BOILERPLATE))
    kept, total, lost, faults = [], 0, 0, {}
    for line in text.split("\n"):
        words = line.split()
        total += len(words)
        fault = line_fault(line, words, may)
        if fault is None:
            kept.append(line)
        else:
            lost += len(words)
            faults[fault] = faults.get(fault, 0) + 1
    return "\n".join(kept), total, lost, faults


def repeated_words(word_hashes: np.ndarray, n: int = WINDOW) -> int:
    """Words that lie in an ``n``-word window occurring twice or more."""
    runs = windows(word_hashes, n)
    if len(runs) < 2:
        return 0
    order = np.sort(runs)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    found = twice[np.minimum(np.searchsorted(twice, runs), len(twice) - 1)] == runs
    at = np.flatnonzero(found)
    change = np.zeros(len(word_hashes) + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, again = set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.strip(SPACE):
            seen.add(line)
    return again


def _figures(texts: list[str]) -> list[list]:
    tokens = tokenise(texts)
    rows, at = [], 0
    for text, n in zip(texts, tokens.counts.tolist()):
        repeat = repeated_words(tokens.hash[at: at + n])
        at += n
        failed = n < MIN_WORDS or 100 * repeat > round(100 * MAX_REPEAT) * n
        cleaned, words, lost, _ = clean_text(text)
        rows.append([n, len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)),
                     duplicate_lines(text), repeat, failed, not failed and lost <= MAX_LOSS * words, lost, cleaned])
    return rows


def judge(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``kept``, ``n_lost_words`` and, if wanted, ``cleaned`` (the lines that pass)."""
    at = docs.columns.index(text_col)
    kinds = {"n_words": T.LongType(), "word_chars": T.LongType(), "n_symbols": T.LongType(),
             "n_dup_lines": T.LongType(), "n_repeat_words": T.LongType(), "base_failed": T.BooleanType(),
             "kept": T.BooleanType(), "n_lost_words": T.LongType(), "cleaned": T.StringType()}
    names = list(kinds) if keep_text else list(kinds)[:-1]
    arrow = {T.LongType: pa.int64(), T.BooleanType: pa.bool_(), T.StringType: pa.string()}

    def judged(batch):
        rows = [r for texts in text_portions(batch.column(at)) for r in _figures(texts)]
        return [pa.array([r[i] for r in rows], arrow[type(kinds[name])]) for i, name in enumerate(names)]

    return add_columns(docs, judged, [T.StructField(fresh(docs, n), kinds[n]) for n in names])


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that stay, without the lines that fail."""
    kept, cleaned = fresh(docs, "kept"), fresh(docs, "cleaned")
    out = judge(docs, text_col).where(kept)
    return out.withColumn(text_col, out[cleaned]).select(*docs.columns)
