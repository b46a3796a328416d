"""Projection, filter and row shaping (PRJ)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_all(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Rename every column with ``fn`` (e.g. remove blanks or a table prefix)."""
    return df.withColumnsRenamed({c: fn(c) for c in df.columns})


def without_blanks(name: str) -> str:
    return "".join(name.split())


def drop_null_rows(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    """Drop rows with NULLs (``df.drop()`` without columns would be a no-op)."""
    return df.na.drop(how=how, subset=subset)


def drop_repeated_headers(df: DataFrame, header: dict[str, str] | None = None) -> DataFrame:
    """Remove data rows that repeat the header line (CSV parts concatenated with headers).

    ``header`` maps column -> header text; by default every column's own name. A row is a
    header row when all its values equal the header text (null-safe compare).
    """
    header = header or {c: c for c in df.columns}
    is_header = None
    for c, text in header.items():
        cond = F.col(c).eqNullSafe(F.lit(text))
        is_header = cond if is_header is None else is_header & cond
    return df.where(~is_header)


def key_by(df: DataFrame, key_expr, value_col: str, key: str = "k", value: str = "v") -> DataFrame:
    """Pair view ``(k, v)`` with a derived key (``keyBy``)."""
    return df.select(key_expr.alias(key), F.col(value_col).alias(value))


def lookup(pairs: DataFrame, key_value, key: str = "k", value: str = "v") -> DataFrame:
    """All values of one key (``lookup``), as a filter pushed into the scan where possible."""
    return pairs.where(F.col(key) == F.lit(key_value)).select(value)


def even_keys(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) % 2 == 0)
