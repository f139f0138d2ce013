"""Every registered query against the checking SQL, on all rows."""

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as entry_points
from tallyline import catalog

KEYS = list(catalog.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(KEYS) <= set(entry_points.queries()) & set(entry_points.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, sf_dir, key):
    columns, expected = duck_rows(con, entry_points.oracle_sql()[key])
    names, found = spark_rows(entry_points.queries()[key](spark, sf_dir))
    assert names == columns
    assert expected, "the fixture must give rows"
    assert found == expected
