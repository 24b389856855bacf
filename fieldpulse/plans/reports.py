"""The ready-made reports over a lake."""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame

from fieldpulse import model as m
from fieldpulse.operators.reports import REPORTS, newest_rows
from fieldpulse.sources.lake import Lake
from fieldpulse.sources.scope import Hour, HourScope


def report(lake: Lake, name: str, rows: int = m.REPORT_ROWS) -> DataFrame:
    """Top rows of a table.

    On a table partitioned by the ordering time the newest partitions hold the answer, so only
    as many of them are read as are needed to find enough rows.
    """
    table, newest_by, ties = REPORTS[name]
    hours = lake.newest_hours(table) if m.TABLES[table].clock == newest_by else None
    if hours is None:
        return newest_rows(lake.read(table), newest_by, ties, rows)
    taken: list[Hour] = []
    while True:
        more = list(islice(hours, max(1, len(taken))))
        taken += more
        newest = lake.read(table, HourScope(tuple(taken)))
        if not more or newest.limit(rows).count() >= rows:
            return newest_rows(newest, newest_by, ties, rows)
