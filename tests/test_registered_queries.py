"""Every registered query against its SQL on the smallest data."""

import pytest

from verification.compare import connect, differences
from verification.models_sql import GIVEN_TABLES
from verification.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_gives_the_expected_rows(spark, connection, name):
    _, problems = differences(spark, connection, name, SF_DIR)
    assert problems == []


def test_every_query_has_sql():
    assert [name for name, query in QUERIES.items() if query.oracle is None] == []


def test_given_tables_are_not_shadowed():
    from verification.models_sql import ALL_SQL

    assert not set(GIVEN_TABLES) & set(ALL_SQL)
