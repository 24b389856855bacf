"""Tables: definition, layout, pruning, upsert and recovery."""

import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from fieldpulse import model as m
from fieldpulse.operators import events as ev
from fieldpulse.plans.reports import report
from fieldpulse.sources import scope as scopes
from fieldpulse.sources.files import delete_tree, path_exists
from fieldpulse.sources.lake import ParquetLake, stamped
from fieldpulse.sources.scope import HourScope, covered
from tests.conftest import at, rows_of

NOW = at("2024-06-01T00:00:00")
LATER = at("2024-06-01T00:00:01")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def identified(make_events, *rows):
    return ev.with_event_id(make_events(*rows))


def test_five_tables_with_the_contract_columns(spark, lake):
    listed = spark.sql(f"SHOW TABLES IN {lake.schema}").collect()
    assert sorted(r.tableName for r in listed) == sorted(m.TABLES)
    for name, spec in m.TABLES.items():
        fields = spark.table(lake.view(name)).schema.fields
        assert [(f.name, f.dataType.simpleString().upper()) for f in fields] == list(spec.columns)
    assert lake.schema in [r[0] for r in spark.sql("SHOW SCHEMAS").collect()]


def test_creating_again_changes_nothing(make_events, lake):
    row = ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01")
    lake.append(m.SILVER, stamped(identified(make_events, row), NOW))
    lake.create()
    assert lake.read(m.SILVER).count() == 1


def test_a_new_catalog_finds_the_files(spark, make_events, lake):
    row = ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01")
    lake.append(m.SILVER, stamped(identified(make_events, row), NOW))
    other = ParquetLake(spark, lake.root, f"{lake.schema}_again").create()
    assert other.read(m.SILVER).count() == 1


def test_a_schema_belongs_to_one_folder(spark, lake, tmp_path):
    with pytest.raises(ValueError, match="already exists"):
        ParquetLake(spark, str(tmp_path / "elsewhere"), lake.schema).create()


def test_ad_hoc_sql(spark, make_events, lake):
    rows = [("s", x, float(i), 1.0, "2024-01-01T00:00:01") for i, x in enumerate("aab")]
    lake.append(m.SILVER, stamped(identified(make_events, *rows), NOW))
    found = spark.sql(
        f"SELECT site, avg(temperature) t FROM {lake.view(m.SILVER)} GROUP BY site"
    )
    assert rows_of(found) == [("a", 0.5), ("b", 2.0)]


def test_odd_names_survive_a_round_trip(make_events, lake):
    names = ["a/b=c", " ", "__HIVE_DEFAULT_PARTITION__", "ü%20", "x" * 300, "a||b"]
    rows = [(n, n, 1.0, 1.0, "2024-01-01T00:00:01") for n in names]
    lake.append(m.SILVER, stamped(identified(make_events, *rows), NOW))
    assert rows_of(lake.read(m.SILVER), "site") == sorted([(n,) for n in names], key=repr)


EXTREME = ["0001-01-01T00:00:00Z", "1969-12-31T23:30:00Z", "+12024-02-03T04:05:06Z"]


def test_extreme_event_times(spark, make_raw, lake, monkeypatch):
    texts = [f'{{"sensor_id":"s","site":"a","event_time":"{t}"}}' for t in EXTREME]
    parsed = ev.with_event_id(ev.parse_events(make_raw(*texts)))
    assert parsed.where("event_time IS NOT NULL").count() == 3
    lake.append(m.SILVER, stamped(parsed, NOW))
    for listed in (10, 1):
        monkeypatch.setattr(scopes, "LISTED_HOURS", listed)
        scope = HourScope.of(parsed, "event_time")
        assert lake.read(m.SILVER, scope).count() == 3
    again = ParquetLake(spark, lake.root, f"{lake.schema}_again").create()
    assert again.read(m.SILVER, HourScope.of(parsed, "event_time")).count() == 3
    newest = list(again.newest_hours(m.SILVER))
    assert len(newest) == 3 and newest == sorted(newest, reverse=True)


def test_scope_prunes_partitions(make_events, lake):
    rows = [("s", "a", 1.0, 1.0, f"2024-01-0{d}T0{h}:00:01") for d in (1, 2) for h in range(4)]
    lake.append(m.SILVER, stamped(identified(make_events, *rows), NOW))
    batch = make_events(rows[0], rows[1], rows[5])
    scope = HourScope.of(batch, "event_time")
    frame = lake.read(m.SILVER, scope)
    assert frame.count() == 3
    assert "InMemoryFileIndex(3 paths)" in plan_of(frame)
    assert lake.read(m.SILVER, HourScope.of(batch.where("false"), "event_time")).count() == 0


def test_a_stray_time_opens_one_more_partition(spark, make_events, lake, monkeypatch):
    """3,000 hours and one of 1970, listed or in ranges: only touched partitions are opened."""
    times = spark.range(3000).selectExpr("timestamp_seconds(1640995200 + id * 3600) t").union(
        spark.sql("SELECT timestamp_seconds(5)")
    )
    other = spark.sql("SELECT timestamp_seconds(864000) t")
    event = "'s' sensor_id", "'a' site", "1D temperature", "1D humidity", "t event_time"
    events = times.union(other).selectExpr(*event)
    lake.append(m.SILVER, stamped(ev.with_event_id(events.where("hour(event_time) < 2")), NOW))
    scope = HourScope.of(times.selectExpr(*event), "event_time")
    assert len(scope.hours) == 3001
    stored = events.where("hour(event_time) < 2 AND event_time != timestamp_seconds(864000)").count()
    for listed in (10_000, 100):
        monkeypatch.setattr(scopes, "LISTED_HOURS", listed)
        found = lake.read(m.SILVER, scope)
        assert f"InMemoryFileIndex({stored} paths)" in plan_of(found)
        assert found.count() == stored


def test_ranges_keep_the_widest_gaps():
    ranges = [(0, 1), (2, 3), (10, 11), (11, 12), (50, 60)]
    assert covered(ranges, 9) == [(0, 1), (2, 3), (10, 12), (50, 60)]
    assert covered(ranges, 3) == [(0, 3), (10, 12), (50, 60)]
    assert covered(ranges, 2) == [(0, 12), (50, 60)]
    assert covered([], 3) == []


def sensor_rows(make_events, now, *rows):
    from fieldpulse.operators import status

    return stamped(status.latest_events(identified(make_events, *rows)), now)


def test_the_newest_event_counts_and_the_newest_batch_stamps(make_events, lake):
    time = "2024-01-01T00:00:0"
    lake.advance(sensor_rows(make_events, NOW, ("s", "a", 1.0, 1.0, time + "1"), ("t", "a", 1.0, 1.0, time + "1")))
    lake.advance(sensor_rows(make_events, LATER, ("s", "b", 50.0, 1.0, time + "2"), ("u", "a", 1.0, 1.0, time + "1")))
    lake.advance(sensor_rows(make_events, LATER, ("t", "c", 50.0, 1.0, time + "0")))

    def found():
        columns = "sensor_id", "site", "status", "unix_seconds(processed_at) = 1717200001"
        return rows_of(lake.read(m.SENSOR_LATEST).selectExpr(*columns))

    expected = [("s", "b", "critical", True), ("t", "a", "normal", True), ("u", "a", "normal", True)]
    assert found() == expected
    lake.compact(NOW)
    assert found() == expected
    assert lake.spark.read.table(f"{lake.file_schema}.{m.SENSOR_LATEST}").count() == 3


def two_versions(make_events, lake):
    """Silver and site minutes of two hours, the first of them written twice."""
    rows = [("s", "a", 1.0, 1.0, f"2024-01-01T0{h}:00:01") for h in (0, 1)]
    scope = HourScope.of(make_events(*rows), "event_time")
    for now, some in ((NOW, rows), (LATER, rows[:1])):
        lake.append(m.SILVER, stamped(identified(make_events, *[(*r[:2], float(len(some)), *r[3:]) for r in some]), now))
        lake.upsert(m.SITE_MINUTE, site_rows(make_events, now, *some), scope)


def all_rows(lake):
    return {t: rows_of(lake.read(t)) for t in (m.SILVER, m.SITE_MINUTE)}


def files_of(lake, table):
    rows = lake.spark.read.table(f"{lake.file_schema}.{table}").select("part_hour", "_metadata.file_path")
    counts = rows.distinct().groupBy("part_hour").count()
    return dict(rows_of(counts))


def test_compaction_keeps_what_readers_see(make_events, lake):
    two_versions(make_events, lake)
    before = all_rows(lake)
    assert files_of(lake, m.SITE_MINUTE)[0] == 2
    lake.compact(at("2024-01-01T00:59:59"))  # no hour is over
    assert files_of(lake, m.SITE_MINUTE)[0] == 2
    lake.compact(at("2024-01-01T01:00:00"))
    for table in before:
        assert files_of(lake, table) == {0: 1, 1: 1}
    assert all_rows(lake) == before
    assert not path_exists(lake.spark, f"{lake.root}/_staging/{m.SITE_MINUTE}")
    late = ("t", "a", 9.0, 1.0, "2024-01-01T00:00:30")
    lake.append(m.SILVER, stamped(identified(make_events, late), LATER))
    assert lake.read(m.SILVER).count() == len(before[m.SILVER]) + 1


@pytest.mark.parametrize("step", ["_stage", "_publish"])
def test_an_interrupted_compaction_loses_nothing(make_events, lake, monkeypatch, step):
    two_versions(make_events, lake)
    before = all_rows(lake)

    def crash(self, *args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ParquetLake, step, crash)
        with pytest.raises(RuntimeError):
            lake.compact(LATER, m.SITE_MINUTE)
    assert all_rows(lake) == before
    if step == "_publish":
        # the worst case: the old partitions are gone and the new ones are not there yet
        delete_tree(lake.spark, lake._location(m.TABLES[m.SITE_MINUTE]) + "/part_day=2024-01-01/part_hour=0")
    # whatever writes next finishes the work first
    late = ("t", "a", 9.0, 1.0, "2024-01-01T00:30:00")
    lake.upsert(m.SITE_MINUTE, site_rows(make_events, LATER, late), HourScope())
    found = all_rows(lake)
    assert found[m.SILVER] == before[m.SILVER]
    assert len(found[m.SITE_MINUTE]) == len(before[m.SITE_MINUTE]) + 1
    assert set(before[m.SITE_MINUTE]) <= set(found[m.SITE_MINUTE])


def test_half_written_staging_is_ignored(spark, make_events, lake):
    spec = m.TABLES[m.SITE_MINUTE]
    spark.range(5).write.parquet(lake._staging(spec))
    delete_tree(spark, f"{lake._staging(spec)}/_SUCCESS")
    lake.create()
    assert lake.read(m.SITE_MINUTE).count() == 0
    row = ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01")
    lake.upsert(m.SITE_MINUTE, site_rows(make_events, NOW, row), HourScope())
    assert lake.read(m.SITE_MINUTE).count() == 1


def test_report_reads_only_the_newest_partitions(make_events, lake):
    rows = [(f"s{d}{i:02d}", "a", 1.0, 1.0, f"2024-01-{d:02d}T00:00:{i:02d}") for d in range(1, 9) for i in range(15)]
    lake.append(m.SILVER, stamped(identified(make_events, *rows), NOW))
    found = report(lake, "latest_events")
    assert "InMemoryFileIndex(2 paths)" in plan_of(found)
    times = [r.sensor_id for r in found.collect()]
    assert times == [f"s8{i:02d}" for i in range(14, -1, -1)] + [f"s7{i:02d}" for i in range(14, 9, -1)]
    assert report(lake, "latest_events", 1000).count() == 120
    assert report(lake, "sensor_minute").count() == 0




def site_rows(make_events, now, *rows):
    from fieldpulse.operators import minutes

    return stamped(minutes.site_minute(minutes.minute_partials(make_events(*rows))), now)


def test_upsert_leaves_other_partitions_alone(make_events, lake):
    monday, tuesday = ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01"), ("s", "a", 2.0, 1.0, "2024-01-02T05:00:01")
    for row in (monday, tuesday):
        lake.upsert(m.SITE_MINUTE, site_rows(make_events, NOW, row), HourScope.of(make_events(row), "event_time"))
    assert rows_of(lake.read(m.SITE_MINUTE), "avg_temperature") == [(1.0,), (2.0,)]


def test_overwrite_replaces_everything(make_events, lake):
    rows = [("s", "a", float(d), 1.0, f"2024-01-0{d}T00:00:01") for d in (1, 2)]
    lake.overwrite(m.SITE_MINUTE, site_rows(make_events, NOW, *rows))
    lake.overwrite(m.SITE_MINUTE, site_rows(make_events, LATER, rows[1]))
    assert rows_of(lake.read(m.SITE_MINUTE), "avg_temperature") == [(2.0,)]
    lake.compact(at("2024-02-01T00:00:00"))
    assert rows_of(lake.read(m.SITE_MINUTE), "avg_temperature") == [(2.0,)]
    lake.overwrite(m.SITE_MINUTE, site_rows(make_events, LATER, rows[0]))
    assert rows_of(lake.read(m.SITE_MINUTE), "avg_temperature") == [(1.0,)]


def test_a_plain_session_can_write(plain_session, tmp_path):
    """Built without this library: the writer provides the timestamp type, files have statistics."""
    lake = ParquetLake(plain_session, str(tmp_path / "lake"), f"p_{uuid.uuid4().hex[:8]}").create()
    plain_session.conf.set("spark.sql.session.timeZone", "UTC")
    row = [("s", "a", 1.0, 1.0, at("2024-01-01T00:00:01"))]
    events = ev.with_event_id(plain_session.createDataFrame(row, m.EVENT_SCHEMA))
    lake.append(m.SILVER, stamped(events, NOW))
    assert lake.read(m.SILVER).count() == 1
    (file,) = Path(lake.root, m.SILVER).rglob("*.parquet")
    group = pq.ParquetFile(file).metadata.row_group(0)
    clock = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == "event_time")
    assert clock.physical_type == "INT64" and clock.is_stats_set


def test_another_zone_is_refused(plain_session, tmp_path):
    plain_session.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    lake = ParquetLake(plain_session, str(tmp_path / "lake"), f"p_{uuid.uuid4().hex[:8]}").create()
    row = [("s", "a", 1.0, 1.0, at("2024-01-01T00:00:01"))]
    events = ev.with_event_id(plain_session.createDataFrame(row, m.EVENT_SCHEMA))
    with pytest.raises(ValueError, match="UTC, not Asia/Tokyo"):
        lake.append(m.SILVER, stamped(events, NOW))


def test_a_known_table_is_not_searched_again(spark, make_events, lake, monkeypatch):
    statements, sql = [], type(spark).sql

    def noted(self, text, *args, **more):
        statements.append(text)
        return sql(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", noted)
    lake.create()
    assert statements and not any("RECOVER" in s or "MSCK" in s for s in statements)
