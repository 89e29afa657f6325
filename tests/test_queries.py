"""Every registered query against its SQL twin on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck
from panelcast.plans import catalog


@pytest.fixture(scope="module")
def connection(data):
    return duck(data)


@pytest.fixture(scope="module")
def statements():
    return entry.oracle_sql()


def test_every_checked_query_has_sql(statements):
    own = {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"}
    assert own == set(catalog.CHECKED) | set(catalog.MODELLED)
    assert set(statements) & own == set(catalog.CHECKED)


@pytest.mark.parametrize("name", list(catalog.CHECKED))
def test_query_equals_sql(spark, data, connection, statements, name):
    result = entry.queries()[name](spark, data).toPandas()
    assert compare(result, connection.execute(statements[name]).df()) == ""


def test_entry(spark):
    if not os.path.isdir(entry.FLAGSHIP_DIR):
        pytest.skip("no test data")
    result = entry.entry(spark)
    assert result.count() == 45
