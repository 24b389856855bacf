"""Data model: event schema, table contracts and the tunable limits."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  Names, bounds, formats and defaults that results depend on, down to the table
# contracts at the end.
# ---------------------------------------------------------------------------
MISSING_SENSOR = "missing_sensor_id"
MISSING_SITE = "missing_site"
TEMPERATURE_RANGE = "temperature_out_of_range"
HUMIDITY_RANGE = "humidity_out_of_range"
MISSING_TIME = "missing_event_time"

LEVEL_NORMAL = "normal"
LEVEL_WARNING = "warning"
LEVEL_CRITICAL = "critical"

ID_SEPARATOR = "||"
ID_DECIMALS = 2
ID_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
ID_HASH_BITS = 256

MINUTE = "1 minute"
AVERAGE_DECIMALS = 2
REPORT_ROWS = 20

SILVER = "sensor_events_validated"
SENSOR_MINUTE = "sensor_minute"
SITE_MINUTE = "site_minute"
SITE_ALERT_MINUTE = "site_alert_minute"
SENSOR_LATEST = "sensor_latest_status"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("site", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()


@dataclass(frozen=True)
class Limits:
    """Accepted measurement ranges (inclusive) and alert thresholds (inclusive)."""

    min_temperature: float = -50.0
    max_temperature: float = 80.0
    min_humidity: float = 0.0
    max_humidity: float = 100.0
    high_temperature: float = 35.0
    critical_temperature: float = 45.0
    high_humidity: float = 85.0

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Limits:
        names = {
            "high_temperature": "HIGH_TEMPERATURE_THRESHOLD",
            "critical_temperature": "CRITICAL_TEMPERATURE_THRESHOLD",
            "high_humidity": "HIGH_HUMIDITY_THRESHOLD",
        }
        return cls(**{k: float(env[v]) for k, v in names.items() if v in env})


DEFAULT_LIMITS = Limits()


@dataclass(frozen=True)
class TableSpec:
    """Contract of one table.

    ``clock`` is the timestamp column whose UTC day and hour partition the table.  It is part of
    the merge key, or fixed by it, so an update can never move a row to another partition.
    """

    name: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    clock: str | None = None
    sort: tuple[str, ...] = field(default=())

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def partition_columns(self) -> tuple[tuple[str, str], ...]:
        return () if self.clock is None else (("part_day", "DATE"), ("part_hour", "INT"))

    @property
    def partition_names(self) -> list[str]:
        return [name for name, _ in self.partition_columns]


TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            name=SILVER,
            columns=(
                ("event_id", "STRING"),
                ("sensor_id", "STRING"),
                ("site", "STRING"),
                ("temperature", "DOUBLE"),
                ("humidity", "DOUBLE"),
                ("event_time", "TIMESTAMP"),
                ("processed_at", "TIMESTAMP"),
            ),
            keys=("event_id",),
            clock="event_time",
            sort=("site", "sensor_id", "event_time"),
        ),
        TableSpec(
            name=SENSOR_MINUTE,
            columns=(
                ("sensor_id", "STRING"),
                ("site", "STRING"),
                ("window_start", "TIMESTAMP"),
                ("window_end", "TIMESTAMP"),
                ("event_count", "BIGINT"),
                ("avg_temperature", "DOUBLE"),
                ("avg_humidity", "DOUBLE"),
                ("last_event_time", "TIMESTAMP"),
                ("processed_at", "TIMESTAMP"),
            ),
            keys=("sensor_id", "site", "window_start", "window_end"),
            clock="window_start",
            sort=("site", "sensor_id", "window_start"),
        ),
        TableSpec(
            name=SITE_MINUTE,
            columns=(
                ("site", "STRING"),
                ("window_start", "TIMESTAMP"),
                ("window_end", "TIMESTAMP"),
                ("event_count", "BIGINT"),
                ("active_sensors", "BIGINT"),
                ("avg_temperature", "DOUBLE"),
                ("avg_humidity", "DOUBLE"),
                ("high_temp_events", "BIGINT"),
                ("critical_temp_events", "BIGINT"),
                ("high_humidity_events", "BIGINT"),
                ("processed_at", "TIMESTAMP"),
            ),
            keys=("site", "window_start", "window_end"),
            clock="window_start",
            sort=("site", "window_start"),
        ),
        TableSpec(
            name=SITE_ALERT_MINUTE,
            columns=(
                ("site", "STRING"),
                ("window_start", "TIMESTAMP"),
                ("window_end", "TIMESTAMP"),
                ("high_temp_events", "BIGINT"),
                ("critical_temp_events", "BIGINT"),
                ("high_humidity_events", "BIGINT"),
                ("alert_level", "STRING"),
                ("processed_at", "TIMESTAMP"),
            ),
            keys=("site", "window_start", "window_end"),
            clock="window_start",
            sort=("site", "window_start"),
        ),
        TableSpec(
            name=SENSOR_LATEST,
            columns=(
                ("sensor_id", "STRING"),
                ("site", "STRING"),
                ("event_time", "TIMESTAMP"),
                ("temperature", "DOUBLE"),
                ("humidity", "DOUBLE"),
                ("status", "STRING"),
                ("processed_at", "TIMESTAMP"),
            ),
            keys=("sensor_id",),
            sort=("sensor_id",),
        ),
    )
}
