"""Every registered query against its SQL counterpart."""

import pytest
from compare import assert_same, connect

import __spark_entry__ as entry_point
from marketlake.plans import catalog, oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.statements())


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, con, key):
    assert_same(entry_point.queries()[key](spark, sf_dir), con, entry_point.oracle_sql()[key])


@pytest.mark.parametrize(
    "key", ["json_bars_explode", "wide_to_current_day", "session_utc", "exchange_time_utc", "merge_upsert", "dim_daily"]
)
def test_results_do_not_depend_on_the_session_zone(spark, sf_dir, con, key):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert_same(entry_point.queries()[key](spark, sf_dir), con, entry_point.oracle_sql()[key])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
