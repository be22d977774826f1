"""Every query of the library against its SQL counterpart, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle_check
import oracle_queries
import query_catalogue

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(query_catalogue.catalogue()) == set(oracle_queries.oracle_sql())
    assert set(query_catalogue.catalogue()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(query_catalogue.catalogue()))
def test_query(spark, connection, name):
    frame = entry.queries()[name](spark, SF_DIR)
    assert oracle_check.difference(frame, connection, entry.oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() == 55
