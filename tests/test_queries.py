"""Every registered query of the library against its SQL counterpart on the smallest data."""

import pytest

from catalog import ORACLES as SQL
from catalog import QUERIES, load_all
from check import compare, connect
from conftest import SF

load_all()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, db, key):
    ok, note = compare(spark, db, SF, key, QUERIES[key], SQL[key])
    assert ok, note
