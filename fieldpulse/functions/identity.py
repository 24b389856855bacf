"""Content-based event identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldpulse import model as m


def event_id(prefix: str = "") -> Column:
    """SHA-256 over names, measures at two decimals and event time at milliseconds.

    Null parts are left out of the hashed text.  The time is written with the offset of the
    session time zone, so every writer of one table must use the same zone (UTC).  ``prefix``
    names the table of the columns, as in ``"target."``.
    """
    measures = [F.format_number(F.col(f"{prefix}{c}"), m.ID_DECIMALS) for c in ("temperature", "humidity")]
    moment = F.date_format(f"{prefix}event_time", m.ID_TIME_FORMAT)
    text = F.concat_ws(m.ID_SEPARATOR, f"{prefix}sensor_id", f"{prefix}site", *measures, moment)
    return F.sha2(text, m.ID_HASH_BITS)
