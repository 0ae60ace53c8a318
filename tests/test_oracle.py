"""Every query against its SQL in DuckDB."""

import pytest

import __spark_entry__
from checks.compare import compare
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees(spark, name):
    agrees, note = compare(spark, SF, name)
    assert agrees, note


def test_contract():
    # the training-data operators may be absent, and not all of them can be said in SQL
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() == 166
