"""Start the continuous job: raw stream -> dead letters, silver and gold.

No streaming state is kept.  An event may arrive any time later; the windows it belongs to are
recomputed from silver.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldpulse.model import Limits
from fieldpulse.plans.batch import BatchOptions, DeadLetterSink, process_batch
from fieldpulse.session import prepare_writes
from fieldpulse.sources.dead_letters import KafkaDeadLetters
from fieldpulse.sources.lake import Lake, ParquetLake
from fieldpulse.sources.merge_lake import MergeLake
from fieldpulse.sources.streams import kafka_options, open_stream

# Defaults of the job's settings.
DEFAULT_SERVERS = "kafka:9092"
DEFAULT_TOPIC = "sensor-events"
DEFAULT_DEAD_LETTER_TOPIC = "sensor-events-dlq"
DEFAULT_TRIGGER = "15 seconds"
DEFAULT_COMPACT_EVERY = 20
DEFAULT_CLOSED_MINUTES = 10


@dataclass(frozen=True)
class StreamConfig:
    """``root`` is the folder of Parquet tables; without it ``schema`` names a catalog schema
    (for example ``iceberg.reporting``) whose tables run MERGE themselves."""

    root: str | None
    checkpoint: str
    source_format: str = "kafka"
    source_options: Mapping[str, str] = field(default_factory=dict)
    source_path: str | None = None
    dead_letters: DeadLetterSink | None = None
    schema: str = "reporting"
    trigger: str = DEFAULT_TRIGGER
    until_drained: bool = False
    batch: BatchOptions = BatchOptions()
    #: Every so many batches the job compacts what is ready; 0 leaves it to others.
    compact_every: int = DEFAULT_COMPACT_EVERY
    #: An hour is ready when it has been over for so long.
    closed_for: timedelta = timedelta(minutes=DEFAULT_CLOSED_MINUTES)

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> StreamConfig:
        """Kafka in and out.

        ``CHECKPOINT_PATH`` is required, and either ``WAREHOUSE_PATH`` (a folder for Parquet
        tables) or ``LAKE_SCHEMA`` (a catalog schema with MERGE support).
        """
        schema = env.get("LAKE_SCHEMA")
        servers = env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_SERVERS)
        options = kafka_options(
            servers,
            env.get("KAFKA_TOPIC", DEFAULT_TOPIC),
            int(env.get("MAX_OFFSETS_PER_TRIGGER", 0)),
            int(env.get("MIN_PARTITIONS", 0)),
        )
        letters = KafkaDeadLetters(servers, env.get("KAFKA_DLQ_TOPIC", DEFAULT_DEAD_LETTER_TOPIC))
        return cls(
            root=None if schema else env["WAREHOUSE_PATH"],
            schema=schema or "reporting",
            checkpoint=env["CHECKPOINT_PATH"],
            source_options=options,
            dead_letters=letters,
            batch=BatchOptions(limits=Limits.from_env(env)),
            compact_every=int(env.get("COMPACT_EVERY_BATCHES", DEFAULT_COMPACT_EVERY)),
            closed_for=timedelta(minutes=float(env.get("COMPACT_CLOSED_MINUTES", DEFAULT_CLOSED_MINUTES))),
        )

    def open_lake(self, spark: SparkSession) -> Lake:
        if self.root is None:
            return MergeLake(spark, self.schema)
        return ParquetLake(spark, self.root, self.schema)


def start_stream(spark: SparkSession, config: StreamConfig) -> StreamingQuery:
    prepare_writes(spark)
    lake = config.open_lake(spark).create()
    records = open_stream(
        spark, config.source_format, config.source_options, config.source_path
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        process_batch(
            lake.on(session), batch, batch_id, config.dead_letters, run, config.batch
        )
        if config.compact_every and (batch_id + 1) % config.compact_every == 0:
            lake.on(session).compact(datetime.now(timezone.utc) - config.closed_for)

    trigger = (
        {"availableNow": True} if config.until_drained else {"processingTime": config.trigger}
    )
    return (
        records.writeStream.foreachBatch(apply)
        .option("checkpointLocation", config.checkpoint)
        .trigger(**trigger)
        .start()
    )
