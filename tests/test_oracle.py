"""Every registered query with an SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import oracle, rows_of
from shelfwise.plans.oracle import ORACLE
from shelfwise.plans.queries import QUERIES



@pytest.fixture(scope="module")
def duck(folder):
    return oracle(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, folder, duck, name):
    got = QUERIES[name](spark, folder).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 50
