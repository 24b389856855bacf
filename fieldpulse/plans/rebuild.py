"""Rebuild all gold tables from silver."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.operators import minutes, status
from fieldpulse.operators.sizing import ROW_BYTES, small
from fieldpulse.plans.together import together
from fieldpulse.sources.files import delete_tree
from fieldpulse.sources.lake import Lake, stamped
from fieldpulse.sources.scope import MINUTE_SECONDS, HourScope


def rebuild_gold(
    lake: Lake,
    limits: m.Limits = m.DEFAULT_LIMITS,
    processed_at: datetime | None = None,
) -> None:
    """Overwrite the four gold tables.  A reader sees each row either old or new.

    Silver is read once: the minute state is written out and everything else starts from the
    written copy, which also survives lost executors.  For the latest status only the hours of
    the sensors' newest events are read again.
    """
    now = processed_at or datetime.now(timezone.utc)
    scratch = lake.scratch("minute_partials")
    silver = lake.read(m.SILVER)
    try:
        minutes.minute_partials(silver, limits).write.mode("overwrite").parquet(scratch)
        _rebuild_from(lake, lake.spark.read.parquet(scratch), limits, now)
    finally:
        delete_tree(lake.spark, scratch)


def _rebuild_from(lake: Lake, partials: DataFrame, limits: m.Limits, now: datetime) -> None:
    hours = HourScope.of(partials, "window_start", MINUTE_SECONDS)

    def sensor_minutes() -> None:
        lake.overwrite(m.SENSOR_MINUTE, stamped(minutes.sensor_minute(partials), now), hours)

    def site_minutes() -> None:
        sites = minutes.site_minute(partials).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lake.overwrite(m.SITE_MINUTE, stamped(sites, now), hours)
            lake.overwrite(m.SITE_ALERT_MINUTE, stamped(minutes.site_alert_minute(sites), now), hours)
        finally:
            sites.unpersist()

    def latest() -> None:
        newest = status.newest_times(partials).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (size,) = newest.agg(F.sum(F.octet_length("sensor_id") + ROW_BYTES)).first()
            recent = lake.scan(m.SILVER, HourScope.of(newest, "event_time"))
            candidates = status.at_newest(recent, small(newest, size or 0))
            lake.overwrite(m.SENSOR_LATEST, stamped(status.latest_events(candidates, limits), now))
        finally:
            newest.unpersist()

    together(lake.spark, sensor_minutes, site_minutes, latest)
