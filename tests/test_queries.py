import pytest
from comparing import rows_of, sql_rows, views

from lexmill.plans import queries as core

QUERIES, SQL = core.queries(), core.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return views(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    cols, rows = rows_of(QUERIES[name](spark, sf))
    assert cols
    if name in SQL:
        assert (cols, rows) == sql_rows(con, SQL[name])
    else:
        assert rows


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
