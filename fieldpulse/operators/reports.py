"""Top-of-table reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse import model as m

# report name -> (table, column ordered newest first, columns that break ties)
REPORTS: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "latest_events": (m.SILVER, "event_time", ("event_id",)),
    "sensor_minute": (m.SENSOR_MINUTE, "window_start", ("sensor_id", "site")),
    "site_minute": (m.SITE_MINUTE, "window_start", ("site",)),
    "site_alerts": (m.SITE_ALERT_MINUTE, "window_start", ("site",)),
    "sensor_status": (m.SENSOR_LATEST, "processed_at", ("sensor_id",)),
}


def newest_rows(
    table: DataFrame, newest_by: str, ties: Sequence[str], rows: int = m.REPORT_ROWS
) -> DataFrame:
    """The top rows by time; planned as a top-k per task and one merge of the small rests."""
    return table.orderBy(F.col(newest_by).desc(), *(F.col(t).asc() for t in ties)).limit(rows)
