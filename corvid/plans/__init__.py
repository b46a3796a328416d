"""Registered queries: each pairs a Spark DataFrame plan with an equivalent DuckDB SQL oracle."""

from corvid.plans.registry import all_oracles, all_queries  # noqa: F401
