"""Numeric helpers.

Money values are doubles with two decimals in the tables. Sums of products of such values
(price x discount x tax) carry up to six decimals, which double arithmetic cannot hold at
large magnitudes; those sums run in DECIMAL, are rounded there, and only then turned into
doubles, so the result does not depend on the summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def money(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def exact_money_sum(expr: Column, scale: int = 2) -> Column:
    """Exact decimal sum, rounded half-up to ``scale`` decimals, returned as double."""
    return F.round(F.sum(expr), scale).cast("double")


def exact_mean(expr: Column) -> Column:
    """Mean of a DECIMAL expression: exact decimal sum, one conversion to double, one
    division. The result does not depend on summation order or engine."""
    return F.sum(expr).cast("double") / F.count(expr)
