"""Spark-native sensor-event analytics: raw JSON events to clean, queryable tables."""

from fieldpulse.model import DEFAULT_LIMITS, EVENT_SCHEMA, TABLES, Limits

__all__ = ["DEFAULT_LIMITS", "EVENT_SCHEMA", "TABLES", "Limits"]
