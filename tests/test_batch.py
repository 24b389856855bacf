"""Micro-batches: effects, replay, order, crash recovery, and equality with a rebuild."""

import random


import pytest

from fieldpulse import model as m
from fieldpulse.operators import minutes, sizing, status
from fieldpulse.plans import batch as plan
from fieldpulse.plans.batch import BatchOptions, process_batch
from fieldpulse.plans.rebuild import rebuild_gold
from fieldpulse.sources.dead_letters import FileDeadLetters
from fieldpulse.sources.files import children
from fieldpulse.sources.lake import ParquetLake
from tests.conftest import at, rows_of

NOW = at("2024-06-01T00:00:00")
LATER = at("2024-06-01T00:01:00")
T0 = "2024-01-01T00:00:"


def gold(lake, stamps=False):
    found = {}
    for name, spec in m.TABLES.items():
        columns = [c for c in spec.column_names if stamps or c != "processed_at"]
        found[name] = rows_of(lake.read(name), *columns)
    return found


def one_shot(lake):
    """What the tables must hold, computed from silver without any scoping."""
    silver = lake.read(m.SILVER)
    partials = minutes.minute_partials(silver)
    sites = minutes.site_minute(partials)
    return {
        m.SENSOR_MINUTE: rows_of(minutes.sensor_minute(partials)),
        m.SITE_MINUTE: rows_of(sites),
        m.SITE_ALERT_MINUTE: rows_of(minutes.site_alert_minute(sites)),
        m.SENSOR_LATEST: rows_of(status.sensor_latest_status(silver)),
    }


def assert_consistent(lake):
    kept = gold(lake)
    for name, rows in one_shot(lake).items():
        assert kept[name] == rows, name


def random_events(seed, count):
    draw = random.Random(seed)
    return [
        (
            draw.choice(["s1", "s2", "s3"]),
            draw.choice(["a", "b"]),
            draw.choice([None, 1.0, 20.25, 36.0, 50.0]),
            draw.choice([None, 10.0, 90.0]),
            f"2024-01-01T{draw.randrange(3):02d}:{draw.randrange(2):02d}:{draw.randrange(60):02d}",
        )
        for _ in range(count)
    ]


def test_empty_batch_does_nothing(make_raw, lake, tmp_path):
    sink = FileDeadLetters(str(tmp_path / "dlq"))
    profile = process_batch(lake, make_raw("{}").where("false"), 0, sink)
    assert (profile.rows, profile.valid) == (0, 0)
    assert not (tmp_path / "dlq").exists()


def test_only_invalid_rows_reach_only_the_dead_letters(spark, make_raw, lake, tmp_path):
    sink = FileDeadLetters(str(tmp_path / "dlq"))
    # the second is the faulty reading a producer injects now and then
    process_batch(
        lake, make_raw("not json", ("sensor-02", "factory-b", 999.0, 45.0, T0 + "00")), 4, sink
    )
    letters = sink.read(spark)
    assert rows_of(letters, "validation_error", "batch_id") == [
        ("missing_sensor_id", 4), ("temperature_out_of_range", 4)
    ]
    assert lake.read(m.SILVER).count() == 0


def test_no_dead_letters_without_invalid_rows(make_raw, lake, tmp_path):
    sink = FileDeadLetters(str(tmp_path / "dlq"))
    process_batch(lake, make_raw(("s", "a", 1.0, 1.0, T0 + "01")), 0, sink)
    assert not (tmp_path / "dlq").exists()
    assert lake.read(m.SILVER).count() == 1


def test_replaying_a_batch_changes_only_the_stamps_of_gold(spark, make_raw, lake, tmp_path):
    sink = FileDeadLetters(str(tmp_path / "dlq"))
    raw = make_raw(*random_events(1, 30), "not json")
    process_batch(lake, raw, 0, sink, "backfill", processed_at=NOW)
    before, silver = gold(lake), rows_of(lake.read(m.SILVER))
    process_batch(lake, raw, 0, sink, "backfill", processed_at=LATER)
    assert gold(lake) == before
    assert rows_of(lake.read(m.SILVER)) == silver
    assert sink.read(spark).count() == 1
    assert {r.processed_at for r in lake.read(m.SITE_MINUTE).collect()} == {
        LATER.replace(tzinfo=None)
    }


@pytest.mark.parametrize("broadcast_bytes", [sizing.BROADCAST_BYTES, 0])
def test_batches_in_any_order_equal_a_rebuild(make_raw, lake, broadcast_bytes):
    """With the limit at 0 every step takes its form for big batches."""
    options = BatchOptions(broadcast_bytes=broadcast_bytes)
    events = random_events(2, 60)
    batches = [events[:25], events[20:45], events[40:]]  # neighbours share events
    for n, batch in enumerate(reversed(batches)):
        process_batch(lake, make_raw(*batch), n, options=options)
    assert_consistent(lake)
    ids = [r.event_id for r in lake.read(m.SILVER).collect()]
    assert len(ids) == len(set(ids))


def test_late_event_updates_its_window_and_leaves_others(make_raw, lake):
    process_batch(
        lake,
        make_raw(("s", "a", 1.0, 1.0, T0 + "01"), ("s", "a", 1.0, 1.0, "2024-01-05T00:00:00")),
        0,
        processed_at=NOW,
    )
    process_batch(lake, make_raw(("t", "a", 50.0, 1.0, T0 + "02")), 1, processed_at=LATER)
    found = lake.read(m.SITE_MINUTE).selectExpr(
        "event_count", "active_sensors", "avg_temperature", "unix_seconds(processed_at)"
    )
    assert rows_of(found) == [
        (1, 1, 1.0, int(NOW.timestamp())), (2, 2, 25.5, int(LATER.timestamp()))
    ]
    # the untouched sensor minute of the same site window keeps its stamp
    stamps = lake.read(m.SENSOR_MINUTE).where("sensor_id = 's'").select("processed_at").distinct()
    assert stamps.count() == 1
    assert_consistent(lake)


def test_older_event_does_not_replace_the_latest_status(make_raw, lake):
    process_batch(lake, make_raw(("s", "a", 50.0, 1.0, T0 + "30")), 0, processed_at=NOW)
    process_batch(lake, make_raw(("s", "b", 1.0, 1.0, T0 + "10")), 1, processed_at=LATER)
    (row,) = lake.read(m.SENSOR_LATEST).collect()
    assert (row.site, row.status) == ("a", "critical")
    assert row.processed_at == LATER.replace(tzinfo=None)


STEPS = [m.SENSOR_MINUTE, m.SITE_MINUTE, m.SITE_ALERT_MINUTE, m.SENSOR_LATEST]


@pytest.mark.parametrize("failing", STEPS)
def test_crash_after_the_silver_append_is_repaired_by_replay(
    make_raw, lake, monkeypatch, failing
):
    process_batch(lake, make_raw(*random_events(3, 15)), 0)
    raw = make_raw(*random_events(4, 15))
    append = ParquetLake.append

    def crash(self, table, *args):
        if table == failing:
            raise RuntimeError("driver lost")
        append(self, table, *args)

    with monkeypatch.context() as patch:
        patch.setattr(ParquetLake, "append", crash)
        with pytest.raises(RuntimeError):
            process_batch(lake, raw, 1)
    process_batch(lake, raw, 1)
    assert_consistent(lake)


def test_literal_mode_keeps_repeats_inside_a_batch(make_raw, lake):
    event = ("s", "a", 1.0, 1.0, T0 + "01")
    options = BatchOptions(dedup_in_batch=False)
    process_batch(lake, make_raw(event, event), 0, options=options)
    process_batch(lake, make_raw(event, event), 1, options=options)
    assert lake.read(m.SILVER).count() == 2
    assert lake.read(m.SITE_MINUTE).first().event_count == 2


def test_ids_that_collide_across_sites_are_found(make_raw, lake):
    """The separator inside a name: two different events, one id."""
    first, second = ("a||b", "c", 1.0, 1.0, T0 + "01"), ("a", "b||c", 1.0, 1.0, T0 + "01")
    process_batch(lake, make_raw(first), 0)
    process_batch(lake, make_raw(second), 1)
    assert rows_of(lake.read(m.SILVER), "sensor_id") == [("a||b",)]
    assert rows_of(lake.read(m.SENSOR_LATEST), "sensor_id") == [("a||b",)]


def test_backfills_keep_each_others_dead_letters(spark, make_raw, lake, tmp_path):
    sink = FileDeadLetters(str(tmp_path / "dlq"))
    process_batch(lake, make_raw("not json"), 0, sink)
    process_batch(lake, make_raw("{}", "[]"), 0, sink)
    assert sink.read(spark).count() == 3
    for _ in range(2):  # a stream's batch that is tried again
        process_batch(lake, make_raw("null"), 0, sink, "stream")
    assert sink.read(spark).count() == 4


def test_dead_letters_can_be_judged_again(spark, make_raw, lake, tmp_path):
    sink = FileDeadLetters(str(tmp_path / "dlq"))
    hot = ("s", "a", 90.0, 1.0, T0 + "01")
    for keep_raw in (False, True):
        process_batch(lake, make_raw(hot, "broken"), int(keep_raw), sink, options=BatchOptions(keep_raw=keep_raw))
    wider = BatchOptions(limits=m.Limits(max_temperature=100.0))
    profile = process_batch(lake, sink.as_records(spark).select("value"), 2, options=wider)
    assert (profile.rows, profile.valid) == (4, 2)
    assert rows_of(lake.read(m.SILVER), "temperature") == [(90.0,)]


def test_a_batch_writes_the_rows_it_changes(make_raw, lake):
    def written():
        return {t: lake.spark.read.table(f"{lake.file_schema}.{t}").count() for t in m.TABLES}

    events = [(f"s{i % 3}", "ab"[i % 2], 1.0, 1.0, f"2024-01-01T00:{i:02d}:01") for i in range(40)]
    process_batch(lake, make_raw(*events), 0)
    before = written()
    assert before == {m.SILVER: 40, m.SENSOR_MINUTE: 40, m.SITE_MINUTE: 40, m.SITE_ALERT_MINUTE: 40, m.SENSOR_LATEST: 3}
    process_batch(lake, make_raw(("s0", "a", 2.0, 1.0, T0 + "30")), 1)
    assert {t: n - before[t] for t, n in written().items()} == dict.fromkeys(m.TABLES, 1)
    assert_consistent(lake)


def test_original_text_can_be_kept_in_dead_letters(spark, make_raw, lake, tmp_path):
    sink = FileDeadLetters(str(tmp_path / "dlq"))
    process_batch(lake, make_raw("broken"), 0, sink, options=BatchOptions(keep_raw=True))
    (text,) = [r.value for r in spark.read.option("recursiveFileLookup", True).text(sink.path).collect()]
    assert '"raw_value":"broken"' in text


def test_rebuild_replaces_gold(make_raw, lake):
    process_batch(lake, make_raw(*random_events(5, 30)), 0, processed_at=NOW)
    expected = gold(lake)
    lake.overwrite(m.SITE_MINUTE, lake.read(m.SITE_MINUTE).where("site = 'b'"))
    rebuild_gold(lake, processed_at=LATER)
    assert gold(lake) == expected


@pytest.mark.parametrize("table", STEPS)
def test_an_interrupted_rebuild_shows_old_rows(make_raw, lake, monkeypatch, table):
    process_batch(lake, make_raw(*random_events(6, 30)), 0, processed_at=NOW)
    before, append = gold(lake, stamps=True), ParquetLake.append

    def crash(self, name, *args):
        if name == table:
            raise RuntimeError("driver lost")
        append(self, name, *args)

    with monkeypatch.context() as patch:
        patch.setattr(ParquetLake, "append", crash)
        with pytest.raises(RuntimeError):
            rebuild_gold(lake, processed_at=LATER)
    assert gold(lake, stamps=True)[table] == before[table]
    assert_consistent(lake)
    assert children(lake.spark, f"{lake.root}/_staging") == []
    rebuild_gold(lake, processed_at=LATER)
    assert {r.processed_at for r in lake.read(table).collect()} == {LATER.replace(tzinfo=None)}
    assert children(lake.spark, f"{lake.root}/_staging") == []


def test_rebuild_of_an_empty_lake(lake):
    rebuild_gold(lake)
    assert all(rows == [] for rows in gold(lake).values())


def test_sizes_are_measured(make_events):
    from fieldpulse.operators import windows

    rows = [("s", "äb", 1.0, 1.0, f"2024-01-01T0{h}:00:0{i}") for h in range(2) for i in range(5)]
    touched = plan.Touched.of(windows.affected_sensor_windows(make_events(*rows)))
    assert touched.key_bytes == 2 * (4 + sizing.ROW_BYTES)
    assert [(h.hour, h.end - h.first) for h in touched.hours.hours] == [(0, 60), (1, 60)]


def test_only_known_small_sides_are_broadcast():
    assert sizing.is_small(sizing.BROADCAST_BYTES)
    assert not sizing.is_small(sizing.BROADCAST_BYTES + 1)
    assert not sizing.is_small(None)
