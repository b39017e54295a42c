"""Every registered query equals its SQL in an independent engine."""

import re

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference, rows_as_given, sql_as_given
from tillwright import registry
from tillwright.oracle.queries import all_statements

QUERIES = registry.queries()
STATEMENTS = all_statements()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(STATEMENTS) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, folder, name):
    assert difference(QUERIES[name](spark, folder), duck, STATEMENTS[name]) is None


# Statements that end in an order; all of them name an id or a unique value last, so it is total.
ORDERED = sorted(name for name, sql in STATEMENTS.items() if re.search(r"ORDER BY [^()]*$", sql))


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_the_stated_order(spark, duck, folder, name):
    names, rows = rows_as_given(QUERIES[name](spark, folder))
    other_names, other_rows = sql_as_given(duck, STATEMENTS[name])
    assert (names, rows) == (other_names, other_rows)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
