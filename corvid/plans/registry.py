"""Query registry.

``@query(name, sql=...)`` registers a callable ``(spark, sf_dir) -> DataFrame`` and, when
the operator is SQL-expressible, the DuckDB SQL that must return the same rows over the
same Parquet tables. Column names of both sides must be identical.
"""

from __future__ import annotations

import importlib
import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}

# Modules whose import registers queries, in survey order.
_MODULES = (
    "corvid.plans.q_flagship",
    "corvid.plans.q_shape",
    "corvid.plans.q_agg",
    "corvid.plans.q_kv",
    "corvid.plans.q_join",
    "corvid.plans.q_window",
    "corvid.plans.q_order",
    "corvid.plans.q_io",
    "corvid.plans.q_partition",
    "corvid.plans.q_docs",
    "corvid.plans.q_sql",
    "corvid.plans.q_stream",
    "corvid.plans.q_jobs",
)


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = textwrap.dedent(sql).strip()
        fn.query_name = name
        return fn
    return deco


def _load_all() -> None:
    for mod in _MODULES:
        importlib.import_module(mod)


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
