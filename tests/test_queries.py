"""Every registered query against its SQL, over the same tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry_module
from tributary.queries.oracles import ORACLES
from tributary.queries.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir) is None


@pytest.mark.skipif(not os.path.exists(entry_module.SMALL), reason="no test data")
def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
