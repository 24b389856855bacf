"""Every registered query against its SQL on the smallest tables, and the known counts."""

import pytest

import __spark_entry__ as entry_points
from checks import queries as q
from checks.compare import differences, open_tables
from tests.conftest import SMALLEST, without_settings


@pytest.fixture(scope="module")
def tables():
    return open_tables(SMALLEST)


def test_every_query_has_its_sql():
    assert set(q.QUERIES) <= set(entry_points.queries())
    assert set(q.QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    frame = entry_points.queries()[name](spark, SMALLEST)
    assert differences(frame, tables, entry_points.oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def plain(spark):
    """One session for all queries, with tables of its own."""
    built, q._built = q._built, {}
    yield without_settings(spark)
    q._built = built


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query_equals_its_sql_in_a_plain_session(plain, tables, name):
    frame = entry_points.queries()[name](plain, SMALLEST)
    assert differences(frame, tables, entry_points.oracle_sql()[name]) is None


def test_entry_point(spark):
    assert entry_points.entry(spark).count() == 692


def test_known_counts(spark):
    counts = {r.outcome: r.events for r in q.validation_counts(spark, SMALLEST).collect()}
    assert counts == {
        "valid": 883,
        "missing_sensor_id": 158,
        "missing_site": 5,
        "temperature_out_of_range": 30,
        "humidity_out_of_range": 22,
        "missing_event_time": 2,
    }
    assert q.silver(spark, SMALLEST).count() == 804
    assert q.silver_literal_merge(spark, SMALLEST).count() == 829
    assert q.sensor_minute(spark, SMALLEST).count() == 791
    assert q.sensor_latest_status(spark, SMALLEST).count() == 13


def test_literal_lake_equals_the_literal_merge(spark):
    lake = q.build_lake(spark, SMALLEST, q.BatchOptions(dedup_in_batch=False))
    assert lake.read("sensor_events_validated").count() == 829
