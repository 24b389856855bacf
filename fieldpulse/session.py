"""Session settings the library relies on, and where it may write scratch data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The type of Parquet timestamps that has statistics, on which the pruning of row groups rests.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # One micro-batch has more generated classes than the default cache (100) can hold.
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def build_session(
    name: str, master: str | None = None, extra: Mapping[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Names of the zone event ids are written in.
UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")
_ZONE, _TIMESTAMPS = "spark.sql.session.timeZone", "spark.sql.parquet.outputTimestampType"


def prepare_writes(spark: SparkSession) -> None:
    """Make a session fit for writing tables, whoever built it.

    The type of Parquet timestamps is set once and stays, since writes run side by side.  The zone is
    only checked: event ids are hashed from text in the session zone, so rows planned in another zone
    already have other ids.
    """
    if (zone := spark.conf.get(_ZONE)) not in UTC_NAMES:
        raise ValueError(f"event ids need UTC, not {zone}: spark.conf.set('{_ZONE}', 'UTC') before reading events")
    if spark.conf.get(_TIMESTAMPS) != SETTINGS[_TIMESTAMPS]:
        spark.conf.set(_TIMESTAMPS, SETTINGS[_TIMESTAMPS])


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``.

    Without that setting only a local session gets one, in the machine's temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix=f"{purpose}-")
