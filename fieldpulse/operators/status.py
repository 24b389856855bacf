"""Latest known status of every sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.functions.severity import sensor_status
from fieldpulse.operators.events import latest_per_sensor

_MEASURED = ["sensor_id", "site", "event_time", "temperature", "humidity"]


def sensor_latest_status(events: DataFrame, limits: m.Limits = m.DEFAULT_LIMITS) -> DataFrame:
    """From identified events: the newest row per sensor with its status."""
    return latest_events(events, limits).drop("event_id")


def latest_events(events: DataFrame, limits: m.Limits = m.DEFAULT_LIMITS) -> DataFrame:
    """The same with the id of the event, which decides between events of equal time."""
    newest = latest_per_sensor(events.select("event_id", *_MEASURED))
    return newest.select("event_id", *_MEASURED, sensor_status(limits).alias("status"))


def newest_times(partials: DataFrame) -> DataFrame:
    """Newest event time per sensor, from minute state: a hash aggregation, nothing is sorted."""
    return partials.groupBy("sensor_id").agg(F.max("last_event_time").alias("event_time"))


def at_newest(events: DataFrame, newest: DataFrame) -> DataFrame:
    """The rows at the newest time of their sensor."""
    rows = events.select("event_id", *_MEASURED)
    return rows.join(newest, ["sensor_id", "event_time"], "left_semi")
