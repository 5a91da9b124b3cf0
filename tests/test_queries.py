"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from sluice.plans import catalog
from tests.compare import of_duckdb, of_spark


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert of_spark(catalog.QUERIES[name](spark, sf_dir)) == of_duckdb(catalog.ORACLE_SQL[name], sf_dir)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
