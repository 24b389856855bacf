"""Sensor events and a request log derived from the whole ``events`` table.

Every row becomes a sensor event; some are broken on purpose, every tenth arrives twice, and the
events are spread over three arrival batches with event time out of order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.sources.streams import spread

BATCHES = (0, 1, 2)

_EPOCH = 1704067200000000
_PROPS_NUMBER = r"([0-9]+)"

_SENSOR = """
case when user_id % 50 = 7 then null
     when user_id % 50 = 8 then ''
     else concat('sensor-', lpad(cast(user_id % 20 as string), 2, '0')) end"""
_SITE = """
case when k = 11 then ''
     else concat('factory-', substr('abcd', cast(k % 4 as int) + 1, 1)) end"""
_TEMPERATURE = """
case when event_type = 'error' and k % 10 = 0 then null
     else cast(floor(value * 2) as double) / 4 end"""
_HUMIDITY = """
case when event_type = 'signup' and k % 10 = 1 then null
     else cast(k as double) + 3.5D end"""
_EVENT_TIME = f"""
case when event_type = 'view' and k = 13 then null
     else timestamp_micros({_EPOCH} + ((unix_micros(at) - {_EPOCH}) div 60000) * 1000) end"""
# The variant for clocks that restart: every 400th event is dated soon after the epoch.
_STRAY_TIME = f"""
case when event_id % 400 = 3 then timestamp_micros(event_id * 1000000 * 1800)
     else {_EVENT_TIME} end"""
# The batches one event arrives in: its own, and a second one for every tenth event.
_ARRIVALS = """
case when event_id % 10 = 0
     then array(event_id % 3, (event_id div 20) % 3) else array(event_id % 3) end"""


def use_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/events.parquet")


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "k": F.regexp_extract("props", _PROPS_NUMBER, 1).cast("int"),
            "at": F.col("ts").cast("timestamp"),
        }
    )


def arrivals(spark: SparkSession, folder: str, stray: bool = False) -> DataFrame:
    """src_id, batch_no and the five event columns, one row per arrival."""
    return _numbered(spread(_events(spark, folder))).select(
        F.col("event_id").alias("src_id"),
        F.expr(_SENSOR).alias("sensor_id"),
        F.expr(_SITE).alias("site"),
        F.expr(_TEMPERATURE).alias("temperature"),
        F.expr(_HUMIDITY).alias("humidity"),
        F.expr(_STRAY_TIME if stray else _EVENT_TIME).alias("event_time"),
        F.explode(F.expr(_ARRIVALS)).alias("batch_no"),
    )


def raw_records(spark: SparkSession, folder: str, stray: bool = False) -> DataFrame:
    """The arrivals as the producer sends them: JSON text in ``value``."""
    record = F.to_json(F.struct(*m.EVENT_COLUMNS))
    return arrivals(spark, folder, stray).select("src_id", "batch_no", record.alias("value"))


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    ok = F.col("event_type") != "error"
    failed = F.when(F.col("k") % 2 == 0, 502).otherwise(0)
    return _numbered(_events(spark, folder)).select(
        F.col("at").alias("started_at"),
        ok.alias("ok"),
        F.when(ok, 200).otherwise(failed).alias("status"),
        F.col("value").alias("latency_ms"),
    )
