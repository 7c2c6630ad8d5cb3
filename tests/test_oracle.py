"""Every registered query against its SQL in DuckDB at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference
from tests.conftest import SMALL

STATEMENTS = oracle_sql()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, duck, name):
    assert difference(queries()[name](spark, SMALL), duck, STATEMENTS[name]) is None


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 10
