"""Every registered query: against its SQL where it has one, for rows otherwise."""

import os

import pytest

from tests.compare import compare, duck
from tidemark.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_equals_sql(spark, con, name):
    rows, _, problem = compare(spark, con, name, FOLDER)
    assert problem is None, problem


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_gives_rows(spark, con, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
