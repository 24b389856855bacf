"""Event quality rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldpulse import model as m


def first_failure(rules: Iterable[tuple[str, Column]]) -> Column:
    """Name of the first rule whose failure condition is true, else null.

    A condition that evaluates to null counts as not failed.
    """
    return F.coalesce(*(F.when(failed, F.lit(name)) for name, failed in rules))


def blank(column: str) -> Column:
    """True for null and for the empty string; white space is a value."""
    return F.coalesce(F.length(column), F.lit(0)) == 0


def outside(column: str, low: float, high: float) -> Column:
    """True outside the closed range; NaN sorts above every number, null stays null."""
    return (F.col(column) < low) | (F.col(column) > high)


def validation_error(limits: m.Limits = m.DEFAULT_LIMITS) -> Column:
    """Why an event is rejected, or null for a valid event.  Missing measures are valid."""
    return first_failure(
        [
            (m.MISSING_SENSOR, blank("sensor_id")),
            (m.MISSING_SITE, blank("site")),
            (
                m.TEMPERATURE_RANGE,
                outside("temperature", limits.min_temperature, limits.max_temperature),
            ),
            (m.HUMIDITY_RANGE, outside("humidity", limits.min_humidity, limits.max_humidity)),
            (m.MISSING_TIME, F.col("event_time").isNull()),
        ]
    )


def reject_reason() -> Column:
    """Why the ingest contract refuses an event: names non-empty, both measures present."""
    return first_failure(
        [
            ("sensor_id", blank("sensor_id")),
            ("site", blank("site")),
            ("temperature", F.col("temperature").isNull()),
            ("humidity", F.col("humidity").isNull()),
        ]
    )
