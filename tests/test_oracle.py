"""Spark results vs the DuckDB oracle SQL (the driver's correctness gate), every key, at GUSTOLAKE_ORACLE_SF (default sf0.001)."""

import os

import pytest

from oracle_compare import compare

from gustolake.plans import oracle, registry


def test_every_query_has_oracle_sql():
    import __spark_entry__ as E

    assert set(registry.QUERIES) == set(oracle.oracle_sql())
    assert set(registry.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", list(registry.QUERIES))
def test_matches_oracle(spark, key):
    sf = os.environ.get("GUSTOLAKE_ORACLE_SF", "/root/testdata/sf0.001")
    status, _, detail = compare(spark, sf, [key], verbose=False)[key]
    assert status == "OK", detail


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "revenue_rank" in df.columns
