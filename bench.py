"""Time the headline queries and print one JSON line.

Every query starts from the Parquet tables and is computed to the last column (``noop`` sink);
only the tables behind ``READS`` are shared between queries.  The best of several runs counts.
Settings: ``BENCH_SF_DIR``, ``BENCH_CPUS``, ``BENCH_RUNS``.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from checks import queries as q
from fieldpulse import model as m
from fieldpulse.session import build_session

QUERIES = [
    "parse_events",
    "validation_counts",
    "events_with_id",
    "silver_dedup",
    "silver_literal_merge",
    "affected_sensor_windows",
    "silver_in_affected_sensor_windows",
    "silver_in_affected_site_windows",
    "sensor_minute",
    "site_minute",
    "site_alert_minute",
    "sensor_latest_status",
    "ingest_contract",
    "request_log_report",
    "request_log_status_counts",
]

# Read from tables that took in the three batches before the clock starts.
READS = [
    "silver_insert_if_absent",
    "sensor_minute_upsert",
    "site_minute_upsert",
    "site_alert_minute_upsert",
    "sensor_latest_status_upsert",
    "report_latest_events",
    "report_sensor_minute",
    "report_site_minute",
    "report_site_alerts",
    "report_sensor_status",
    "adhoc_sql",
]


def three_batches(spark: SparkSession, folder: str) -> None:
    """Three micro-batches through dead letters, silver and all gold tables."""
    q.build_lake(spark, folder)


def stream(spark: SparkSession, folder: str) -> None:
    """The streaming job over the same batches, restarted for each of them."""
    q.stream_lake(spark, folder)


def compaction(spark: SparkSession, folder: str) -> None:
    """Compaction of all hours after three micro-batches, which count too."""
    lake = q.build_lake(spark, folder)
    lake.compact(datetime(2100, 1, 1, tzinfo=timezone.utc))


def rebuild(spark: SparkSession, folder: str) -> None:
    """Silver from raw records, then all gold tables from silver."""
    lake = q.new_lake(spark, "bench")
    lake.append(m.SILVER, q.stamped(q.silver(spark, folder), q.FIRST_BATCH_AT))
    q.rebuild_gold(lake)


def full(name: str) -> Callable[[SparkSession, str], None]:
    query = q.registered()[name]
    return lambda spark, folder: query(spark, folder).write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    q.kept_lake(spark, folder)
    work = {name: full(name) for name in (*QUERIES, *READS)}
    work |= {"three_batches": three_batches, "stream": stream, "compaction": compaction, "rebuild": rebuild}
    seconds: dict[str, float] = {}
    for name, run in work.items():
        taken = []
        for _ in range(runs):
            began = time.perf_counter()
            run(spark, folder)
            taken.append(time.perf_counter() - began)
        seconds[name] = round(min(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
