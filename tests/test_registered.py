"""Every registered query against its SQL in DuckDB over the whole test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fleetpulse.plans.catalog import registered
from tests.compare import database, difference


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


OWN = sorted(registered())


@pytest.mark.parametrize("name", OWN)
def test_matches_sql(spark, sf_dir, db, name):
    assert difference(queries()[name](spark, sf_dir), db, oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(OWN) <= set(queries()) and set(OWN) <= set(oracle_sql())


def test_entry_is_one_dashboard_row(spark):
    row = entry(spark).collect()
    assert len(row) == 1 and row[0].total_events > 0 and row[0].distinct_devices > 0
