"""One micro-batch: dead letters, silver, then the gold rows the batch touches.

Everything after the silver append is a function of the batch and of silver, and is scoped by
all valid rows of the batch, not only by the new ones.  Running a batch again, for example
after a crash half way, therefore repairs whatever the first attempt left out.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.operators import events as ev
from fieldpulse.operators import minutes, status, windows
from fieldpulse.operators.sizing import (
    BROADCAST_BYTES,
    EVENT_ID_BYTES,
    ROW_BYTES,
    is_small,
    small,
)
from fieldpulse.operators.upserts import absent_rows
from fieldpulse.plans.together import together
from fieldpulse.sources.lake import Lake, stamped
from fieldpulse.sources.scope import MINUTE_SECONDS, HourScope, by_hour


class DeadLetterSink(Protocol):
    def write(self, letters: DataFrame, run: str, batch_id: int) -> None: ...


@dataclass(frozen=True)
class BatchOptions:
    limits: m.Limits = m.DEFAULT_LIMITS
    dedup_in_batch: bool = True
    keep_raw: bool = False
    #: Sides of joins up to this size, measured, are broadcast.
    broadcast_bytes: int = BROADCAST_BYTES


@dataclass(frozen=True)
class BatchProfile:
    """Row counts of a batch."""

    rows: int
    valid: int

    @classmethod
    def of(cls, classified: DataFrame) -> BatchProfile:
        counts = classified.agg(F.count(F.lit(1)), F.count_if(ev.is_valid()))
        return cls(*counts.first())

    @property
    def id_bytes(self) -> int:
        return self.valid * EVENT_ID_BYTES


@dataclass(frozen=True)
class Touched:
    """The sensor windows of a batch, with what bounds the work on them.

    ``key_bytes`` is the size of the windows, so also an upper bound for the fewer site windows
    and sensors.
    """

    sensor_windows: DataFrame
    key_bytes: int
    hours: HourScope
    limit: int = BROADCAST_BYTES

    @classmethod
    def of(cls, sensor_windows: DataFrame, limit: int = BROADCAST_BYTES) -> Touched:
        """One aggregation: a row per touched hour with its span, and the size and number of its keys."""
        names = F.octet_length("sensor_id") + F.octet_length("site")
        measures = F.sum(names + ROW_BYTES), F.count(F.lit(1))
        hours = by_hour(sensor_windows, "window_start", MINUTE_SECONDS, *measures).collect()
        scope = HourScope.from_rows(hours, [h[5] for h in hours])
        return cls(sensor_windows, sum(h[4] for h in hours), scope, limit)

    @property
    def site_windows(self) -> DataFrame:
        return self.sensor_windows.select(*windows.SITE_KEYS).distinct()

    @property
    def sensors(self) -> DataFrame:
        return small(self.sensor_windows.select("sensor_id").distinct(), self.key_bytes, self.limit)


def classified_batch(raw: DataFrame, options: BatchOptions) -> DataFrame:
    """Parsed, classified and identified events of one batch of raw records."""
    if options.keep_raw:
        raw = raw.withColumn("raw_value", F.col("value"))
    kept = ("raw_value",) if options.keep_raw else ()
    return ev.with_event_id(ev.classify(ev.parse_events(raw, kept), options.limits))


def process_batch(
    lake: Lake,
    raw: DataFrame,
    batch_id: int,
    dead_letters: DeadLetterSink | None = None,
    run: str | None = None,
    options: BatchOptions = BatchOptions(),
    processed_at: datetime | None = None,
) -> BatchProfile:
    """Apply one batch of raw records (column ``value``) to the lake.

    ``run`` names the stream or backfill in the dead letters: a batch given again with the same run
    and id replaces its letters.  Without it every call keeps letters of its own.
    """
    now = processed_at or datetime.now(timezone.utc)
    classified = classified_batch(raw, options).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        profile = BatchProfile.of(classified)
        if profile.rows > profile.valid and dead_letters is not None:
            letters = ev.dead_letters(
                ev.invalid_events(classified), batch_id, "raw_value" if options.keep_raw else None
            )
            dead_letters.write(letters, run or uuid.uuid4().hex, batch_id)
        if profile.valid:
            valid = ev.valid_events(classified).select("event_id", *m.EVENT_COLUMNS)
            _land(lake, valid, profile.id_bytes, options, now)
        return profile
    finally:
        classified.unpersist()


def _land(
    lake: Lake, valid: DataFrame, id_bytes: int, options: BatchOptions, now: datetime
) -> None:
    sensor_windows = windows.affected_sensor_windows(valid).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = Touched.of(sensor_windows, options.broadcast_bytes)
        insert_absent_events(lake, valid, touched.hours, id_bytes, options, now)
        _refresh_gold(lake, touched, options.limits, now)
    finally:
        sensor_windows.unpersist()


def _refresh_gold(lake: Lake, touched: Touched, limits: m.Limits, now: datetime) -> None:
    silver = lake.scan(m.SILVER, touched.hours)
    partials = affected_partials(silver, touched, limits).persist(StorageLevel.MEMORY_AND_DISK)
    site_minutes = minutes.site_minute(partials).persist(StorageLevel.MEMORY_AND_DISK)

    def sensor_minutes() -> None:
        keys = windows.SENSOR_KEYS
        changed = windows.in_windows(
            partials, touched.sensor_windows, keys, touched.key_bytes, touched.limit
        )
        rows = stamped(minutes.sensor_minute(changed), now)
        lake.upsert(m.SENSOR_MINUTE, rows, touched.hours)

    def site_aggregates() -> None:
        lake.upsert(m.SITE_MINUTE, stamped(site_minutes, now), touched.hours)

    def alert_levels() -> None:
        alerts = minutes.site_alert_minute(site_minutes)
        lake.upsert(m.SITE_ALERT_MINUTE, stamped(alerts, now), touched.hours)

    def latest() -> None:
        ours = partials.join(touched.sensors, "sensor_id", "left_semi")
        newest = status.newest_times(ours)
        silver_then = lake.scan(m.SILVER, HourScope.of(newest, "event_time"))
        candidates = status.at_newest(silver_then, small(newest, touched.key_bytes, touched.limit))
        lake.advance(stamped(status.latest_events(candidates, limits), now))

    try:
        together(lake.spark, sensor_minutes, site_aggregates, alert_levels, latest)
    finally:
        site_minutes.unpersist()
        partials.unpersist()


def insert_absent_events(
    lake: Lake,
    valid: DataFrame,
    hours: HourScope,
    id_bytes: int | None,
    options: BatchOptions,
    now: datetime,
) -> None:
    """Append the events whose id silver does not have.

    Equal ids imply equal event times (the time is the last part of the hashed text, and years
    from 0001 on are written uniquely), so looking only at the times of the batch is exact.
    """
    source = ev.first_per_id(valid) if options.dedup_in_batch else valid
    silver = lake.scan(m.SILVER, hours)
    fresh = absent_rows(
        source,
        silver,
        "event_id",
        id_bytes,
        target_unique=options.dedup_in_batch,
        limit=options.broadcast_bytes,
        source_unique=options.dedup_in_batch,
    )
    lake.append(m.SILVER, stamped(fresh, now), hours)


def affected_partials(
    silver: DataFrame, touched: Touched, limits: m.Limits = m.DEFAULT_LIMITS
) -> DataFrame:
    """Minute state of every site window the batch touches, from one read of silver.

    A small set of windows filters silver by broadcast before the aggregation.  A big one is
    applied after it, so that only aggregated rows are shuffled for the join.
    """
    rows, keys = windows.with_window_start(silver), windows.SITE_KEYS
    if is_small(touched.key_bytes, touched.limit):
        rows = windows.in_windows(rows, touched.site_windows, keys, touched.key_bytes, touched.limit)
        return minutes.minute_partials(rows, limits)
    return windows.in_windows(minutes.minute_partials(rows, limits), touched.site_windows, keys)
