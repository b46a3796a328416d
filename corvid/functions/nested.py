"""Nested data: JSON parse/build, struct projection, arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_json(df: DataFrame, column: str, schema, alias: str = "data") -> DataFrame:
    """``from_json`` into a struct column; malformed JSON yields NULL fields."""
    return df.withColumn(alias, F.from_json(F.col(column), schema))


def flatten_struct(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """``select(keep..., column.*)``."""
    return df.select(*(keep or []), f"{column}.*")


def explode_items(df: DataFrame, array_col: str, keep: list[str], outer: bool = False,
                  alias: str = "item") -> DataFrame:
    """One row per array element, element fields as columns. ``outer`` keeps rows whose
    array is empty or NULL (``explode_outer``). Exploding streams rows; nothing is gathered."""
    fn = F.explode_outer if outer else F.explode
    return df.select(*keep, fn(F.col(array_col)).alias(alias)).select(*keep, f"{alias}.*")


def json_of(*cols: str) -> Column:
    """``to_json(named_struct(...))``."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))
