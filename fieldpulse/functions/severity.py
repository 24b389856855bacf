"""Alert level of a site minute and status of a sensor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldpulse import model as m


def _graded(critical: Column, warning: Column) -> Column:
    return F.coalesce(
        F.when(critical, F.lit(m.LEVEL_CRITICAL)),
        F.when(warning, F.lit(m.LEVEL_WARNING)),
        F.lit(m.LEVEL_NORMAL),
    )


def alert_level() -> Column:
    """Humidity alone raises a warning, never a critical alert."""
    return _graded(
        critical=F.col("critical_temp_events") > 0,
        warning=(F.col("high_temp_events") > 0) | (F.col("high_humidity_events") > 0),
    )


def sensor_status(limits: m.Limits = m.DEFAULT_LIMITS) -> Column:
    """A missing measure never raises the status."""
    return _graded(
        critical=F.col("temperature") >= limits.critical_temperature,
        warning=(F.col("temperature") >= limits.high_temperature)
        | (F.col("humidity") >= limits.high_humidity),
    )
