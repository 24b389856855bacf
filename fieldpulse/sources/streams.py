"""Raw record sources: any Spark streaming source with a ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldpulse.operators.events import payload


def kafka_options(
    servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options to follow one topic from its start; later starts resume from the checkpoint.

    ``min_partitions`` lets Spark cut topic partitions, so that a topic with few of them is
    still parsed by all cores.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def open_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    return payload(spark.readStream.format(fmt).options(**options).load(path))


def open_batch(
    spark: SparkSession, fmt: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """The same records read once as a table, for backfills."""
    return payload(spread(spark.read.format(fmt).options(**options).load(path)))


def spread(scan: DataFrame, factor: int = 16) -> DataFrame:
    """Spread a scan with fewer splits than cores, since parsing costs more than moving it.

    Each split is cut at most ``factor`` fold.  A scan that fills the cores is left alone; a big
    input is shuffled here only if it comes as a few files that cannot be split.
    """
    splits = scan.rdd.getNumPartitions()
    wanted = min(scan.sparkSession.sparkContext.defaultParallelism, splits * factor)
    return scan.repartition(wanted) if wanted > splits else scan
