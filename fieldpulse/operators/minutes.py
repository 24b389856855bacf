"""One-minute aggregates.

All of them start from ``minute_partials``: additive state per site, sensor and minute, made by
one hash aggregation with map-side combining.  Sensor minutes are a projection of it, site
minutes a second, much smaller aggregation: since a sensor occurs once per site minute there,
the exact number of active sensors is a plain count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.functions.severity import alert_level
from fieldpulse.functions.timegrid import window_end
from fieldpulse.operators.windows import SENSOR_KEYS, SITE_KEYS, with_window_start

ALERT_COUNTS = ["high_temp_events", "critical_temp_events", "high_humidity_events"]


def minute_partials(events: DataFrame, limits: m.Limits = m.DEFAULT_LIMITS) -> DataFrame:
    rows = events if "window_start" in events.columns else with_window_start(events)
    return rows.groupBy(*SENSOR_KEYS).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum("temperature").alias("temperature_sum"),
        F.count("temperature").alias("temperature_count"),
        F.sum("humidity").alias("humidity_sum"),
        F.count("humidity").alias("humidity_count"),
        F.max("event_time").alias("last_event_time"),
        F.count_if(F.col("temperature") >= limits.high_temperature).alias("high_temp_events"),
        F.count_if(F.col("temperature") >= limits.critical_temperature).alias(
            "critical_temp_events"
        ),
        F.count_if(F.col("humidity") >= limits.high_humidity).alias("high_humidity_events"),
    )


def _average(total: str | Column, count: str | Column) -> Column:
    return F.round(F.try_divide(total, count), m.AVERAGE_DECIMALS)


def sensor_minute(partials: DataFrame) -> DataFrame:
    return partials.select(
        "sensor_id",
        "site",
        "window_start",
        window_end("window_start").alias("window_end"),
        "event_count",
        _average(F.col("temperature_sum"), F.col("temperature_count")).alias("avg_temperature"),
        _average(F.col("humidity_sum"), F.col("humidity_count")).alias("avg_humidity"),
        "last_event_time",
    )


def site_minute(partials: DataFrame) -> DataFrame:
    averages = [
        _average(F.sum(f"{name}_sum"), F.sum(f"{name}_count")).alias(f"avg_{name}")
        for name in ("temperature", "humidity")
    ]
    grouped = partials.groupBy(*SITE_KEYS).agg(
        F.sum("event_count").alias("event_count"),
        F.count(F.lit(1)).alias("active_sensors"),
        *averages,
        *(F.sum(name).alias(name) for name in ALERT_COUNTS),
    )
    return grouped.select(
        "site",
        "window_start",
        window_end("window_start").alias("window_end"),
        "event_count",
        "active_sensors",
        "avg_temperature",
        "avg_humidity",
        *ALERT_COUNTS,
    )


def site_alert_minute(site_minutes: DataFrame) -> DataFrame:
    return site_minutes.select(
        "site", "window_start", "window_end", *ALERT_COUNTS, alert_level().alias("alert_level")
    )
