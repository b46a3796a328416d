"""Text expressions: tokenising, case folding, punctuation stripping, characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII whitespace as Java's and RE2's ``\s`` both understand it, and the
# punctuation rule "keep letters, digits, underscore and whitespace".
WHITESPACE = r"[ \t\n\x0B\f\r]+"
NOT_WORD_CHAR = r"[^\p{L}\p{N}_ \t\n\x0B\f\r]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text, pattern: str = WHITESPACE) -> Column:
    """Array of non-empty tokens split on ``pattern`` (a Java regex)."""
    return F.filter(F.split(_c(text), pattern), lambda w: w != "")


def strip_punct(text) -> Column:
    return F.regexp_replace(_c(text), NOT_WORD_CHAR, "")


def clean_tokens(text) -> Column:
    """Lower-cased tokens with punctuation removed (Unicode letters and digits kept)."""
    return tokens(strip_punct(F.lower(_c(text))))


def characters(text) -> Column:
    """Array of the characters of a string."""
    return F.split(_c(text), "")
