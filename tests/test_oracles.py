"""Every registered query against its DuckDB oracle (the driver's correctness gate) on the
smallest scale factor; ``python -m corvid.plans.verify`` runs the same at sf0.01."""

import pytest

from corvid.plans.registry import all_oracles, all_queries
from corvid.plans.verify import compare

from testdata import SF_SMALL

QUERIES = all_queries()
ORACLES = all_oracles()


def test_every_query_is_registered_with_a_unique_name():
    assert len(QUERIES) > 200
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck_small.execute(ORACLES[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["c_custkey", "c_name", "n_name", "revenue", "n_orders"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
