"""Dead-letter sinks.  Both take a DataFrame with one text column ``value``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.operators.events import ERROR


@dataclass(frozen=True)
class KafkaDeadLetters:
    """Writes to a topic; a retried batch is written again (at least once)."""

    servers: str
    topic: str

    def write(self, letters: DataFrame, run: str, batch_id: int) -> None:
        (
            letters.write.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("topic", self.topic)
            .save()
        )


@dataclass(frozen=True)
class FileDeadLetters:
    """Text files, one folder per run and batch; the same batch of the same run replaces its folder."""

    path: str

    def write(self, letters: DataFrame, run: str, batch_id: int) -> None:
        letters.write.mode("overwrite").text(f"{self.path}/run={run}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The recorded events with their reason, batch id and, where it was kept, their text."""
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in m.EVENT_SCHEMA)}"
        texts = spark.read.option("recursiveFileLookup", "true").text(self.path)
        fields = F.from_json("value", f"{schema}, {ERROR} string, batch_id int, raw_value string")
        return texts.select(F.inline_outer(F.array(fields)))

    def as_records(self, spark: SparkSession) -> DataFrame:
        """The letters as raw records for another attempt, say with wider limits."""
        return records_of(self.read(spark))


def records_of(letters: DataFrame) -> DataFrame:
    """Raw records (column ``value``): the original text, or the event written anew."""
    event = F.to_json(F.struct(*m.EVENT_COLUMNS))
    return letters.select(F.coalesce("raw_value", event).alias("value"), "batch_id")
