"""Every registered query beside its SQL on the smallest data, and those without SQL for shape."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, duck
from ratingloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")

@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in entry.oracle_sql()])
def test_query(spark, con, name):
    text, ok = compare(spark, con, name, SF)
    assert ok, text


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.dtypes == [("user_id", "string"), ("parent_asin", "string"), ("pred", "double"), ("rank", "int")]
    assert df.count() == 1500


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES)
