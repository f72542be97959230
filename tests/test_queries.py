import pytest

from docstrata import queries
from tests.oracle import same

SQL = queries.oracle_sql()


def test_every_query_has_sql():
    assert set(queries.queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, name):
    same(spark, sf, queries.queries()[name], SQL[name])


def test_entry(spark, sf):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert "heading_path" in df.columns and not df.isEmpty()
