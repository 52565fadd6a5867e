"""Every registered query on the smallest tables: equal to its SQL where it has one, rows otherwise."""

import pytest

import __spark_entry__ as entry
from gaugework.operators.sizing import release
from tests.compare import DATA, database, difference

SF = str(DATA / "sf0.001")
ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal_to_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None
    release()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
    release()


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["dataset_id"] for r in rows} == {"FD001", "FD002", "FD003", "FD004", "all"}
