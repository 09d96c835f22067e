"""Every registered query against its reference SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
from checks.compare import compare

ORACLES = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, name):
    assert compare(spark, registry.queries()[name], ORACLES[name], sf_dir) is None


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(registry.queries())


def test_entry_gives_rows(spark):
    assert registry.entry(spark).limit(1).count() == 1
