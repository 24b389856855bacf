"""The ingest contract: what an event must carry to be accepted for publishing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.quality import reject_reason
from fieldpulse import model as m


def ingest_contract(events: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Add ``accepted`` and ``reject_reason``; a missing event time becomes ``now``."""
    if now is None:
        now = F.current_timestamp()
    elif isinstance(now, datetime):
        now = F.lit(now).cast("timestamp")
    filled = events.withColumn("event_time", F.coalesce("event_time", now))
    judged = filled.withColumn("reject_reason", reject_reason())
    return judged.withColumn("accepted", F.col("reject_reason").isNull())


def publish_payload(contracted: DataFrame) -> DataFrame:
    """JSON text of the accepted events, event time in ISO 8601 with offset."""
    whole = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format("event_time", ".SSSSSS")
    offset = F.date_format("event_time", "xxx")
    iso = F.concat(whole, F.when(fraction != ".000000", fraction).otherwise(""), offset)
    fields = [F.col(c) for c in m.EVENT_COLUMNS if c != "event_time"]
    record = F.struct(*fields, iso.alias("event_time"))
    return contracted.where("accepted").select(F.to_json(record).alias("value"))
