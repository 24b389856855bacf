"""One-minute tumbling windows and the set of windows a batch touches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldpulse.functions.timegrid import window_end, window_start
from fieldpulse.operators.sizing import BROADCAST_BYTES, small

SITE_KEYS = ["site", "window_start"]
SENSOR_KEYS = ["sensor_id", "site", "window_start"]


def with_window_start(events: DataFrame) -> DataFrame:
    return events.withColumn("window_start", window_start("event_time"))


def _touched(events: DataFrame, keys: list[str], per: tuple[str, ...]) -> DataFrame:
    starts = with_window_start(events).select(*keys, *per).distinct()
    return starts.withColumn("window_end", window_end("window_start"))


def affected_sensor_windows(events: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """Sensor windows touched, for each value of the columns ``per`` (say, a batch number)."""
    return _touched(events, SENSOR_KEYS, per)


def affected_site_windows(events: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    return _touched(events, SITE_KEYS, per)


def affected_sensors(events: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    return events.select("sensor_id", *per).distinct()


def in_windows(
    rows: DataFrame,
    windows: DataFrame,
    keys: list[str],
    max_bytes: int | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows (with ``window_start``) whose window is listed; an equi semi join.

    ``max_bytes`` bounds the size of ``windows``; within the broadcast limit ``rows`` are not
    shuffled.
    """
    return rows.join(small(windows.select(*keys), max_bytes, limit), keys, "left_semi")


def in_windows_per(rows: DataFrame, windows: DataFrame, keys: list[str], per: str) -> DataFrame:
    """Rows once for each value of ``per`` that touched their window; an equi join."""
    return rows.join(windows.select(*keys, per), keys)
