"""Batches that touch very many hours: those with few rows share partitions."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

import pytest

from checks.queries import GOLD
from fieldpulse import model as m
from fieldpulse.plans.batch import process_batch
from fieldpulse.plans.rebuild import rebuild_gold
from fieldpulse.plans.reports import report
from fieldpulse.sources import scope as scopes
from fieldpulse.sources.files import children
from fieldpulse.sources.lake import ParquetLake

BEGAN = datetime(2024, 1, 1, tzinfo=timezone.utc)
TABLES = [t for t in m.TABLES if m.TABLES[t].clock]


def record(minutes: int, value: float, sensor: str = "s") -> str:
    when = (BEGAN + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return f'{{"sensor_id":"{sensor}","site":"a","event_time":"{when}","temperature":{value},"humidity":1.0}}'


STRAY = [-60 * 199 * n for n in range(1, 1200, 100)]
FIRST = [record(n, 1.0) for n in [*STRAY, *range(50)]]
SECOND = [record(n, 2.0) for n in [*STRAY[::2], *range(40, 90)]]
#: Few hours, some of which lie in shared partitions by now: each of them gets a partition of its own.
THIRD = [record(n, 3.0, "t") for n in [STRAY[-1], 5]]


def rows(lake: ParquetLake, table: str) -> list[tuple]:
    names = [c for c in m.TABLES[table].column_names if c != "processed_at"]
    return sorted(tuple(map(str, row)) for row in lake.read(table).select(*names).collect())


def contents(lake: ParquetLake) -> dict[str, list[tuple]]:
    return {table: rows(lake, table) for table in m.TABLES}


def taken_in(spark, root, few, monkeypatch, after_each=lambda lake: None, batches=(FIRST, SECOND, THIRD)):
    monkeypatch.setattr(scopes, "FEW_HOURS", few)
    monkeypatch.setattr(scopes, "HOUR_ROWS", 20)
    lake = ParquetLake(spark, str(root / f"few{few}"), f"s_{uuid.uuid4().hex[:8]}").create()
    for number, texts in enumerate(batches):
        process_batch(lake, spark.createDataFrame([(t,) for t in texts], "value string"), number)
        after_each(lake)
    return lake


@pytest.fixture
def plain(spark, tmp_path, monkeypatch):
    """What the tables hold with a partition for every hour."""
    return contents(taken_in(spark, tmp_path, 10_000, monkeypatch))


def shown(lake: ParquetLake) -> dict[str, list[tuple]]:
    """The same through another lake over the same files, which has to look for their partitions."""
    return contents(ParquetLake(lake.spark, lake.root, f"s_{uuid.uuid4().hex[:8]}").create())


def test_sparse_hours_share_partitions_and_lose_no_row(spark, tmp_path, monkeypatch, plain):
    lake = taken_in(spark, tmp_path, 5, monkeypatch)
    assert contents(lake) == plain and shown(lake) == plain
    days = {d for d in children(spark, f"{lake.root}/{m.SITE_MINUTE}") if d.startswith("part_day=")}
    assert len(days) < len(STRAY)
    assert len(plain[m.SITE_MINUTE]) == len(STRAY) + 90


def test_compaction_of_shared_partitions(spark, tmp_path, monkeypatch, plain):
    def compact(lake):
        lake.compact(datetime(2100, 1, 1, tzinfo=timezone.utc))

    lake = taken_in(spark, tmp_path, 5, monkeypatch, compact)
    assert contents(lake) == plain and shown(lake) == plain
    for table in TABLES:  # one row per key and partition, and nothing left to do
        assert not lake.state.appended[table]
    compact(lake)
    assert contents(lake) == plain


def test_scopes_and_reports_read_shared_partitions(spark, tmp_path, monkeypatch):
    lake = taken_in(spark, tmp_path, 5, monkeypatch)
    events = lake.read(m.SILVER)
    first = "event_time < '2002-01-01'"
    one = scopes.HourScope.of(events.where(first), "event_time")
    for table in TABLES:
        clock = m.TABLES[table].clock
        assert lake.read(table, one).count() == lake.read(table).where(f"{clock} < '2002-01-01'").count() > 0
    found = report(lake, "latest_events", 95)
    expected = events.orderBy(events.event_time.desc(), "event_id").limit(95)
    assert found.select("event_id").collect() == expected.select("event_id").collect()


@pytest.mark.parametrize("compacted", [False, True])
def test_keys_that_go_stay_away(spark, tmp_path, monkeypatch, compacted):
    """A rebuild from less silver marks the others as gone, wherever their rows are."""
    whole = taken_in(spark, tmp_path, 5, monkeypatch)
    less = taken_in(spark, tmp_path / "less", 5, monkeypatch, batches=(SECOND,))
    kept = whole.read(m.SILVER).where("temperature = 2.0").select("event_id", *m.EVENT_COLUMNS, "processed_at")
    other = ParquetLake(spark, str(tmp_path / "other"), f"s_{uuid.uuid4().hex[:8]}").create()
    for table in GOLD:
        names = m.TABLES[table].column_names
        if m.TABLES[table].clock:
            stored = whole.read(table).select(*names)
            other.upsert(table, stored, scopes.HourScope.of(stored, "window_start", 60))
    other.append(m.SILVER, kept)
    rebuild_gold(other)
    if compacted:
        other.compact(datetime(2100, 1, 1, tzinfo=timezone.utc))
    for table in GOLD:
        assert rows(other, table) == rows(less, table)


def test_only_hours_worth_a_file_have_a_partition_of_their_own():
    hours = [(day, hour, 0, 60) for day in range(20_000, 20_030) for hour in range(24)]
    sizes = [4_800] * (len(hours) - 1) + [20_000]
    scope = scopes.HourScope.from_rows(hours, sizes)
    assert len(scope.written) <= 3 and 20_029 * 24 + 23 in scope.written
    assert len(scopes.HourScope.from_rows(hours[:24], sizes[:24]).written) == 24
