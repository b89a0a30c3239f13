"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as bindings
from check import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


OWN = sorted(set(bindings.queries()) - set(bindings.corpus.QUERIES if bindings.corpus else ()))


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) == ""


def test_every_sql_has_a_query():
    assert set(bindings.oracle_sql()) <= set(bindings.queries())


def test_entry(spark):
    found = bindings.entry(spark).collect()
    assert len(found) == 1 and 0 <= found[0]["accuracy"] <= 1
