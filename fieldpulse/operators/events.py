"""Parse, classify, split and identify raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.functions.identity import event_id
from fieldpulse.functions.quality import validation_error

ERROR = "validation_error"


def payload(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The record payload as text; binary payloads (Kafka) are decoded."""
    return records.select(F.col("value").cast("string").alias("value"), *keep)


def parse_events(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text to the five typed event columns; unreadable text gives five nulls.

    The struct goes through ``inline_outer`` so that later filters on the parsed fields stay
    above the parser: each text is parsed once instead of once per condition.
    """
    parsed = F.array(F.from_json("value", m.EVENT_SCHEMA))
    return raw.select(*keep, F.inline_outer(parsed))


def classify(events: DataFrame, limits: m.Limits = m.DEFAULT_LIMITS) -> DataFrame:
    """Add ``validation_error``: the first broken rule, or null."""
    return events.withColumn(ERROR, validation_error(limits))


def is_valid() -> Column:
    return F.col(ERROR).isNull()


def valid_events(classified: DataFrame) -> DataFrame:
    return classified.where(is_valid()).drop(ERROR)


def invalid_events(classified: DataFrame) -> DataFrame:
    return classified.where(~is_valid())


def with_event_id(events: DataFrame) -> DataFrame:
    return events.withColumn("event_id", event_id())


def dead_letters(
    invalid: DataFrame, batch_id: int | Column, raw_column: str | None = None
) -> DataFrame:
    """One JSON text per invalid event.  ``raw_column`` adds the original text, if kept."""
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    fields = [*m.EVENT_COLUMNS, ERROR, batch.cast("int").alias("batch_id")]
    if raw_column:
        fields.append(raw_column)
    return invalid.select(F.to_json(F.struct(*fields)).alias("value"))


def first_per_id(events: DataFrame) -> DataFrame:
    """One row per event id: the earliest, ties broken by the remaining columns.

    Spark keeps one row per id and input partition before it shuffles, so many copies of one
    event do not meet in one task.
    """
    order = ["event_time", "temperature", "humidity", "sensor_id", "site"]
    return _first(events, "event_id", [F.col(c).asc() for c in order])


def latest_per_sensor(events: DataFrame) -> DataFrame:
    """The newest row of every sensor, whatever its site; equal times go to the smaller id."""
    return _first(events, "sensor_id", [F.col("event_time").desc(), F.col("event_id").asc()])


def _first(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
