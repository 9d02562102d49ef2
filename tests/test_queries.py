"""Every core query against its SQL, value by value; the others must run."""

import pytest
from conftest import DATA, rows

from linkloom.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    got = QUERIES[name](spark, str(DATA)).toPandas()
    if name in SQL:
        want = duck.execute(SQL[name]).df()
        assert rows(got) == rows(want)
    else:
        assert len(got.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
