"""Time windows and partition values.

Day and hour are computed from the instant, so they do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldpulse import model as m


def window_start(column: str | Column, width: str = m.MINUTE) -> Column:
    return F.window(column, width)["start"]


def window_end(start: str | Column, width: str = m.MINUTE) -> Column:
    amount, unit = width.split()
    column = F.col(start) if isinstance(start, str) else start
    return column + F.expr(f"INTERVAL {int(amount)} {unit}")


def _hours_since_epoch(column: str | Column) -> Column:
    return F.floor(F.unix_seconds(column) / F.lit(3600))


def utc_day(column: str | Column) -> Column:
    return F.date_from_unix_date(F.floor(_hours_since_epoch(column) / F.lit(24)).cast("int"))


def utc_hour(column: str | Column) -> Column:
    return F.pmod(_hours_since_epoch(column), F.lit(24)).cast("int")
