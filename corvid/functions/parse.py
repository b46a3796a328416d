"""Parsing helpers built on the ``try_`` family so malformed input yields NULL under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_pair(line, sep: str = ",") -> Column:
    """``"key,1.5"`` -> struct(key string, value double); bad numbers become NULL."""
    parts = F.split(_c(line), sep, 2)
    # get() returns NULL past the end of the array (getItem raises under ANSI mode)
    return F.struct(F.get(parts, 0).alias("key"), F.get(parts, 1).try_cast("double").alias("value"))


def to_ts(text, fmt: str | None = None) -> Column:
    """Timestamp from text with a Spark datetime pattern (e.g. ``M/d/yyyy H:mm``); NULL when
    the text does not match. One-digit month/day patterns parse without the LEGACY policy."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(text))


def to_int_id(text) -> Column:
    """Identifiers stored as text such as ``17593.0`` or ``C536379`` -> bigint or NULL."""
    return _c(text).try_cast("double").try_cast("bigint")


def birth_year(age, as_of: str) -> Column:
    """Year of birth from an age at a fixed reference date (repeatable, unlike current_date)."""
    return F.year(F.lit(as_of).cast("date")) - _c(age)


def to_ts_two_digit_year(text, fmt: str, pivot: int = 2050) -> Column:
    """Parse a pattern with a two-digit year (``yy``). Spark maps ``yy`` to 2000-2099; years
    at or after ``pivot`` are moved back a century (``95`` -> 1995 with the default pivot)."""
    ts = to_ts(text, fmt)
    return F.when(F.year(ts) >= pivot, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)
