"""Which rows of the append-only tables count, and what reading and compacting them costs."""

import pytest
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.operators import events as ev
from fieldpulse.operators import minutes, status
from fieldpulse.plans.batch import process_batch
from fieldpulse.plans.rebuild import rebuild_gold
from fieldpulse.sources.dead_letters import FileDeadLetters
from fieldpulse.sources.lake import APPENDED, BUCKETS, ParquetLake, stamped
from fieldpulse.sources.scope import Hour, HourScope
from fieldpulse.streaming.job import StreamConfig, start_stream
from tests.conftest import at, rows_of

NOW, LATER, FAR = at("2024-06-01T00:00:00"), at("2024-06-01T00:00:01"), at("2100-01-01T00:00:00")
HOUR = Hour.whole(19723, 0)  # 2024-01-01


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def sites(make_events, now, *rows):
    return stamped(minutes.site_minute(minutes.minute_partials(make_events(*rows))), now)


def statuses(make_events, now, *rows):
    return stamped(status.latest_events(ev.with_event_id(make_events(*rows))), now)


def put(lake, make_events, now, *rows):
    lake.upsert(m.SITE_MINUTE, sites(make_events, now, *rows), HourScope.of(make_events(*rows), "event_time"))


def reopened(lake):
    """The lake as another driver would open it."""
    return ParquetLake(lake.spark, lake.root, lake.schema).create()


def event(minute, sensor="s", value=1.0, hour=0, day=1):
    return (sensor, "a", value, 1.0, f"2024-01-{day:02d}T{hour:02d}:{minute:02d}:01")


# -- versions -----------------------------------------------------------------------------------


@pytest.mark.parametrize("compacted", [False, True])
def test_a_driver_with_a_slow_clock_goes_on_where_the_last_one_ended(make_raw, lake, monkeypatch, compacted):
    """All four gold tables show the second driver's batch, whatever its clock says."""
    time = "2024-01-01T00:00:0"
    process_batch(lake, make_raw(("s", "a", 1.0, 1.0, time + "1")), 0, processed_at=NOW)
    if compacted:
        lake.compact(FAR)
    monkeypatch.setattr("time.time", lambda: 0.0)
    monkeypatch.setattr("time.time_ns", lambda: 0)
    other = reopened(lake)
    process_batch(other, make_raw(("s", "a", 50.0, 1.0, time + "2")), 1, processed_at=NOW)

    def shown():
        return (
            rows_of(other.read(m.SENSOR_MINUTE), "event_count", "avg_temperature"),
            rows_of(other.read(m.SITE_MINUTE), "event_count", "critical_temp_events"),
            rows_of(other.read(m.SITE_ALERT_MINUTE), "alert_level"),
            rows_of(other.read(m.SENSOR_LATEST), "temperature", "status"),
        )

    expected = ([(2, 25.5)], [(2, 1)], [("critical",)], [(50.0, "critical")])
    assert shown() == expected
    other.compact(FAR)
    assert shown() == expected


def test_versions_rise_within_and_across_drivers(make_events, lake):
    for _ in range(2):
        put(lake, make_events, NOW, event(0))
    first = lake._next_version()
    put(lake, make_events, NOW, event(0))
    assert reopened(lake)._next_version() > first
    stored = lake.spark.read.table(f"{lake.file_schema}.{m.SITE_MINUTE}")
    assert stored.select("written_at").distinct().count() == 3


# -- what a read costs --------------------------------------------------------------------------


def test_compacted_hours_are_read_as_they_are(make_events, lake):
    for now in (NOW, LATER):
        put(lake, make_events, now, event(0), event(1), event(0, hour=1))
    scope = HourScope((HOUR,))
    assert "Window" in plan_of(lake.read(m.SITE_MINUTE, scope))
    lake.compact(at("2024-01-01T01:00:00"))
    of_hour, both = lake.read(m.SITE_MINUTE, scope), HourScope((HOUR, Hour.whole(19723, 1)))
    assert of_hour.count() == 2 and lake.read(m.SITE_MINUTE, both).count() == 3
    for word in ("Window", "Exchange", "Sort"):
        assert word not in plan_of(of_hour)
    assert "Window" in plan_of(lake.read(m.SITE_MINUTE))  # the other hour is open
    lake.compact(FAR)
    whole = lake.spark.table(lake.view(m.SITE_MINUTE))
    assert "Window" not in plan_of(whole) and "Exchange" not in plan_of(whole) and whole.count() == 3


def test_only_open_hours_go_through_the_window(make_events, lake):
    put(lake, make_events, NOW, event(0), event(0, hour=1))
    lake.compact(at("2024-01-01T01:00:00"))
    plan = lake.spark.table(lake.view(m.SITE_MINUTE))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and "part_level" in plan
    paths = plan_of(lake.spark.table(lake.view(m.SITE_MINUTE)))
    assert paths.count("(1 paths)") == 2  # one compacted partition beside the window, one open below it


def test_a_late_row_reopens_its_hour_only(make_events, lake):
    put(lake, make_events, NOW, event(0, value=1.0), event(5, value=1.0), event(0, hour=1))
    lake.compact(FAR)
    put(lake, make_events, LATER, event(0, value=9.0))
    wanted = [(1.0,), (1.0,), (9.0,)]
    for reader in (lake, reopened(lake)):
        assert rows_of(reader.read(m.SITE_MINUTE), "avg_temperature") == wanted
        assert rows_of(reader.read(m.SITE_MINUTE, HourScope((HOUR,))), "avg_temperature") == [(1.0,), (9.0,)]
    assert "Window" not in plan_of(lake.read(m.SITE_MINUTE, HourScope((Hour.whole(19723, 1),))))
    lake.compact(FAR)
    assert rows_of(lake.read(m.SITE_MINUTE), "avg_temperature") == wanted
    assert lake.spark.read.table(f"{lake.file_schema}.{m.SITE_MINUTE}").count() == 3


def test_a_second_compaction_leaves_compacted_hours_alone(make_events, lake):
    put(lake, make_events, NOW, event(0), event(0, hour=1))
    lake.compact(FAR)

    def files():
        found = lake.spark.read.table(f"{lake.file_schema}.{m.SITE_MINUTE}")
        return dict(rows_of(found.select("part_hour", "_metadata.file_path")))

    before = files()
    lake.compact(FAR)
    assert files() == before
    put(lake, make_events, LATER, event(3, hour=1))
    lake.compact(FAR)
    assert files()[0] == before[0] and files()[1] != before[1]


def test_an_hour_of_which_nothing_is_left(make_events, lake):
    put(lake, make_events, NOW, event(0), event(0, hour=1))
    lake.compact(FAR)
    lake.overwrite(m.SITE_MINUTE, sites(make_events, LATER, event(0, hour=1, value=7.0)))
    for _ in range(2):
        assert rows_of(lake.read(m.SITE_MINUTE), "avg_temperature") == [(7.0,)]
        assert rows_of(reopened(lake).read(m.SITE_MINUTE), "avg_temperature") == [(7.0,)]
        lake.compact(FAR)
    assert lake.spark.read.table(f"{lake.file_schema}.{m.SITE_MINUTE}").count() == 1


def test_a_replacement_reads_either_side_once(spark, make_events, lake):
    put(lake, make_events, NOW, event(0), event(1))
    lake.compact(FAR)
    folder = f"{lake.root}/new"
    sites(make_events, LATER, event(1), event(2)).write.parquet(folder)
    plan = lake.replacing(m.SITE_MINUTE, spark.read.parquet(folder))
    assert plan_of(plan).count("FileScan") == 2
    assert rows_of(plan.select(F.minute("window_start"), "gone")) == [(0, True), (1, False), (2, False)]


# -- the latest status --------------------------------------------------------------------------


def buckets(lake):
    stored = lake.spark.read.table(f"{lake.file_schema}.{m.SENSOR_LATEST}")
    return dict(rows_of(stored.select("part_bucket", "_metadata.file_path").distinct()))


def test_status_compaction_rewrites_buckets_with_new_rows(make_events, lake):
    sensors = [f"s{i}" for i in range(200)]
    lake.advance(statuses(make_events, NOW, *[event(0, s) for s in sensors]))
    lake.compact(NOW, m.SENSOR_LATEST)
    before = buckets(lake)
    assert APPENDED not in before and set(before) <= set(range(BUCKETS))
    for i in range(3):
        lake.advance(statuses(make_events, LATER, event(1 + i, "s7", 50.0)))
    lake.compact(NOW, m.SENSOR_LATEST)
    after = buckets(lake)
    assert sum(after[b] != before[b] for b in before) == 1
    found = {r.sensor_id: r for r in lake.read(m.SENSOR_LATEST).collect()}
    assert len(found) == 200 and found["s7"].status == "critical" and found["s8"].status == "normal"
    stored = lake.spark.read.table(f"{lake.file_schema}.{m.SENSOR_LATEST}")
    assert stored.count() == 200  # what a read costs follows the sensors, not the batches
    assert "Exchange" not in plan_of(lake.read(m.SENSOR_LATEST))


def test_a_rebuild_forgets_sensors_until_they_come_again(make_events, lake):
    lake.advance(statuses(make_events, NOW, event(30, "gone"), event(30, "kept")))
    lake.compact(NOW, m.SENSOR_LATEST)
    lake.overwrite(m.SENSOR_LATEST, statuses(make_events, LATER, event(10, "kept")))
    for again in range(2):
        found = rows_of(lake.read(m.SENSOR_LATEST).select("sensor_id", F.minute("event_time")))
        assert found == [("kept", 10)]
        lake.compact(NOW, m.SENSOR_LATEST)
    other = reopened(lake)
    other.advance(statuses(make_events, LATER, event(5, "gone"), event(5, "kept")))
    found = rows_of(other.read(m.SENSOR_LATEST).select("sensor_id", F.minute("event_time")))
    assert found == [("gone", 5), ("kept", 10)]


@pytest.mark.parametrize("step", ["_stage", "_publish", "_drop"])
def test_an_interrupted_status_compaction_loses_nothing(make_events, lake, monkeypatch, step):
    lake.advance(statuses(make_events, NOW, event(0, "a"), event(0, "b"), event(0, "c")))
    lake.compact(NOW, m.SENSOR_LATEST)
    lake.overwrite(m.SENSOR_LATEST, statuses(make_events, LATER, event(1, "a"), event(0, "b")))
    wanted = [("a", 1), ("b", 0)]

    def crash(self, *args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ParquetLake, step, crash)
        with pytest.raises(RuntimeError):
            lake.compact(NOW, m.SENSOR_LATEST)
    for reader in (lake, reopened(lake)):
        assert rows_of(reader.read(m.SENSOR_LATEST).select("sensor_id", F.minute("event_time"))) == wanted


# -- the job ------------------------------------------------------------------------------------


def test_files_stay_few_over_a_streamed_day(spark, make_raw, tmp_path):
    """Twelve batches, each with an event for most hours of a day; the job compacts every fourth."""
    root = str(tmp_path / "lake")
    config = StreamConfig(
        root=root, checkpoint=f"{root}/checkpoint", source_format="text", source_path=f"{root}/inbox",
        dead_letters=FileDeadLetters(f"{root}/letters"), schema="streamed_day", until_drained=True, compact_every=4,
    )
    for n in range(12):
        texts = [event(n, f"s{n % 3}", float(n), hour) for hour in range(0, 24, 6)]
        make_raw(*texts).write.mode("append").text(config.source_path)
        query = start_stream(spark, config)
        query.awaitTermination()
        assert query.exception() is None
    lake = ParquetLake(spark, root, "streamed_day").create()
    for table in (m.SILVER, m.SENSOR_MINUTE, m.SITE_MINUTE, m.SITE_ALERT_MINUTE):
        stored = spark.read.table(f"{lake.file_schema}.{table}")
        counts = stored.select("part_hour", "_metadata.file_path").distinct().groupBy("part_hour").count()
        assert max(c for _, c in rows_of(counts)) <= 1 + 3
        assert lake.read(table).count() == 48
    assert lake.spark.read.table(f"{lake.file_schema}.{m.SENSOR_LATEST}").count() <= 3 + 3
    before = {t: rows_of(lake.read(t).drop("processed_at")) for t in m.TABLES}
    rebuild_gold(lake)
    assert {t: rows_of(lake.read(t).drop("processed_at")) for t in m.TABLES} == before
