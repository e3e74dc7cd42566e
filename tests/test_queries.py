"""Every registered query at the smallest scale: against its SQL where there is one, else for rows."""

import os

import pytest

import __spark_entry__ as entry_point
from workload import check
from workload.oracles import oracles
from workload.queries import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    return check.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracles()))
def test_equals_sql(spark, database, name):
    assert check.differences(spark, database, queries()[name], oracles()[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracles())))
def test_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(queries()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["page_id", "n_chunks", "n_tokens"]
