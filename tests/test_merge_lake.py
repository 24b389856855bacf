"""The catalog form of the tables.  No catalog with MERGE is at hand, so this covers what can be
checked without one: definitions, scans, and the merge request Spark receives."""

import uuid

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.sources import merge_lake
from fieldpulse.sources.merge_lake import PARTITIONING, MergeLake, name_ranges
from fieldpulse.sources.scope import Hour, HourScope
from fieldpulse.streaming.job import StreamConfig
from tests.conftest import rows_of


@pytest.fixture
def plain(spark):
    """The tables as unpartitioned Parquet tables of the session catalog."""
    lake = MergeLake(spark, f"m_{uuid.uuid4().hex[:8]}", "parquet")
    for statement in lake.definitions():
        spark.sql(statement.split(" PARTITIONED BY")[0])
    return lake


def test_definitions():
    namespace, *tables = MergeLake(None).definitions()
    assert namespace == "CREATE NAMESPACE IF NOT EXISTS iceberg.reporting"
    assert len(tables) == len(m.TABLES) == len(PARTITIONING)
    assert tables[4] == (
        "CREATE TABLE IF NOT EXISTS iceberg.reporting.sensor_latest_status (sensor_id STRING, "
        "site STRING, event_time TIMESTAMP, temperature DOUBLE, humidity DOUBLE, status STRING, "
        "processed_at TIMESTAMP) USING iceberg PARTITIONED BY (site)"
    )


def test_scan_is_cut_to_the_hours_in_scope(spark, make_events, plain):
    rows = [("s", "a", 1.0, 1.0, f"2024-01-01T0{h}:30:00") for h in (0, 1, 2, 5)]
    events = make_events(*rows)
    silver = events.selectExpr("'x' event_id", "*", "event_time processed_at")
    silver.write.insertInto(plain.view(m.SILVER))
    scope = HourScope.of(make_events(rows[0], rows[1], rows[3]), "event_time")
    hours = plain.scan(m.SILVER, scope).select(F.hour("event_time"))
    assert rows_of(hours) == [(0,), (1,), (5,)]
    assert plain.scan(m.SILVER, HourScope()).count() == 0
    assert plain.scan(m.SENSOR_LATEST, scope).count() == 0


def test_a_stray_time_costs_one_range(spark, make_events, plain):
    """3,000 hours and one event of 1970: the days in between are not asked for."""
    hours = [Hour.whole(19000 + n // 24, n % 24) for n in range(3000)]
    scope = HourScope((Hour(0, 1, 3600, 3601), *hours))
    rows = [("s", "a", 1.0, 1.0, t) for t in ("1970-01-01T01:00:00", "1999-01-01T00:00:00", "2022-01-09T00:00:00")]
    silver = make_events(*rows).selectExpr("'x' event_id", "*", "event_time processed_at")
    silver.write.insertInto(plain.view(m.SILVER))
    found = plain.scan(m.SILVER, scope)
    assert rows_of(found.select(F.year("event_time"))) == [(1970,), (2022,)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count(">= ") == 2


def test_upsert_is_a_merge_on_the_keys(spark, plain):
    rows = spark.table(plain.view(m.SITE_MINUTE))
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
        plain.upsert(m.SITE_MINUTE, rows, HourScope(hours=(Hour.whole(19723, 1),)))


def test_the_latest_status_is_a_merge_by_time(spark, make_events, plain):
    from fieldpulse.operators import events as ev
    from fieldpulse.operators import status
    from fieldpulse.sources.lake import stamped
    from tests.conftest import at

    events = ev.with_event_id(make_events(("s", "a", 1.0, 1.0, "2024-01-01T00:00:01")))
    rows = stamped(status.latest_events(events), at("2024-06-01T00:00:00"))
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
        plain.advance(rows)
    plain.advance(rows.where("false"))


def test_names_are_covered_by_ranges(spark, monkeypatch):
    names = [f"plant-{a}-sensor-{i:03d}" for a in "ax" for i in range(500)]
    rows = spark.createDataFrame([(n,) for n in names], "sensor_id string")
    found = name_ranges(rows, "sensor_id")
    assert 2 <= len(found) <= 220 and found == sorted(found)
    assert all(any(a <= n <= b for a, b in found) for n in names)
    assert not any(a <= "plant-m-sensor-001" <= b for a, b in found)
    assert name_ranges(rows.where("false"), "sensor_id") == []
    monkeypatch.setattr(merge_lake, "RANGES", 1)
    assert name_ranges(rows, "sensor_id") == [(min(names), max(names))]


def test_the_status_merge_reads_written_rows_and_skips_by_ranges(spark, make_events, plain, monkeypatch):
    from fieldpulse.operators import events as ev
    from fieldpulse.operators import status
    from fieldpulse.sources.lake import stamped
    from tests.conftest import at

    events = [(s, "a", 1.0, 1.0, "2024-01-01T00:00:01") for s in ("a1", "a2", "z9")]
    rows = stamped(status.latest_events(ev.with_event_id(make_events(*events))), at("2024-06-01T00:00:00"))
    seen = []

    class Merge:
        def __getattr__(self, name):
            return lambda *args: self

    def noted(frame, table, condition):
        seen.append((frame.inputFiles(), str(condition), rows_of(frame, "sensor_id")))
        return Merge()

    monkeypatch.setattr(type(rows), "mergeInto", noted)
    plain.advance(rows)
    ((files, condition, sensors),) = seen
    assert files and sensors == [("a1",), ("a2",), ("z9",)]
    assert condition.count("<=") == 3 and "z9" in condition


def test_the_job_opens_the_named_schema(spark):
    config = StreamConfig.from_env({"LAKE_SCHEMA": "lake.reporting", "CHECKPOINT_PATH": "/c"})
    assert config.open_lake(spark) == MergeLake(spark, "lake.reporting")
