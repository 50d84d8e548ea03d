"""Every registered query with a statement gives the statement's rows."""

import pytest
from conftest import FOLDER
from verify import compare

import __spark_entry__ as E

QUERIES, ORACLES = E.queries(), E.oracle_sql()


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, duck):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_entry(spark):
    assert E.entry(spark).count() == 12
