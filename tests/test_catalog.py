"""Every query against its SQL oracle on the smallest tables; the rest must give rows."""

import pytest

import __spark_entry__ as entry
from screenloom.plans import registry
from tests.compare import same

#: Their tables can be too small here to give a row.
MAY_BE_EMPTY: set[str] = set()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, sf, name):
    assert not same(spark, registry.QUERIES[name], registry.ORACLES[name], sf)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_rows(spark, sf, name):
    rows = registry.QUERIES[name](spark, sf).count()
    assert rows or name in MAY_BE_EMPTY


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["perturbation", "rank", "gene"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
