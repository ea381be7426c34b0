"""Every registered query against its SQL equivalent, on whole tables."""

from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry_module
from gradientlab.queries import REGISTRY as QUERIES
from gradientlab.queries import SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert not compare.difference(QUERIES[name](spark, FOLDER), con, SQL[name])


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "Region" and df.columns[-1] == "Elevation"
    assert df.count() > 0
