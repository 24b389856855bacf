"""Queries over the given tables, their SQL counterparts and the sensor-event fixture."""
