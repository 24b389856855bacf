"""One query per operator, over the whole fixture.

Output timestamps are cast to ``timestamp_ntz`` so that a reader without a time zone sees the
same UTC values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture as fx
from fieldpulse import model as m
from fieldpulse.operators import events as ev
from fieldpulse.operators import minutes, requests, status, windows
from fieldpulse.operators.ingest import ingest_contract
from fieldpulse.operators.upserts import first_batch_rows
from fieldpulse.plans.batch import BatchOptions, process_batch
from fieldpulse.plans.rebuild import rebuild_gold
from fieldpulse.plans.reports import report
from fieldpulse.session import work_folder
from fieldpulse.sources.dead_letters import FileDeadLetters
from fieldpulse.sources.lake import ParquetLake, stamped
from fieldpulse.streaming.job import StreamConfig, start_stream

Query = Callable[[SparkSession, str], DataFrame]

FIRST_BATCH_AT = datetime(2024, 6, 1, tzinfo=timezone.utc)


def batch_time(batch_no: int) -> datetime:
    return FIRST_BATCH_AT + timedelta(seconds=batch_no)


def naive(rows: DataFrame) -> DataFrame:
    stamps = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in rows.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return rows.withColumns(stamps) if stamps else rows


# -- derived frames ---------------------------------------------------------------------------


def classified(spark: SparkSession, folder: str) -> DataFrame:
    raw = fx.raw_records(spark, folder)
    return ev.classify(ev.parse_events(raw, ("src_id", "batch_no")))


def valid(spark: SparkSession, folder: str) -> DataFrame:
    return ev.with_event_id(ev.valid_events(classified(spark, folder)))


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return ev.first_per_id(valid(spark, folder)).select("event_id", *m.EVENT_COLUMNS)


# -- parsing, validity, identity --------------------------------------------------------------


def parse_events(spark, folder):
    return ev.parse_events(fx.raw_records(spark, folder), ("src_id", "batch_no"))


def validation_errors(spark, folder):
    return classified(spark, folder).select("src_id", "batch_no", ev.ERROR)


def validation_counts(spark, folder):
    outcome = F.coalesce(ev.ERROR, F.lit("valid")).alias("outcome")
    return classified(spark, folder).groupBy(outcome).agg(F.count(F.lit(1)).alias("events"))


def dlq_records(spark, folder):
    """The dead-letter texts of the three batches, read back as columns."""
    invalid = ev.invalid_events(classified(spark, folder))
    texts = ev.dead_letters(invalid, F.col("batch_no"))
    schema = T.StructType(
        [
            *m.EVENT_SCHEMA.fields,
            T.StructField(ev.ERROR, T.StringType()),
            T.StructField("batch_id", T.IntegerType()),
        ]
    )
    return texts.select(F.inline_outer(F.array(F.from_json("value", schema))))


def events_with_id(spark, folder):
    return valid(spark, folder).select("src_id", "batch_no", "event_id")


def silver_dedup(spark, folder):
    return silver(spark, folder)


# -- windows and scoping ----------------------------------------------------------------------


def affected_sensor_windows(spark, folder):
    return windows.affected_sensor_windows(valid(spark, folder), per=("batch_no",))


def affected_site_windows(spark, folder):
    return windows.affected_site_windows(valid(spark, folder), per=("batch_no",))


def affected_sensors(spark, folder):
    return windows.affected_sensors(valid(spark, folder), per=("batch_no",))


def _silver_in(touched: Query, keys: list[str]) -> Query:
    """All of silver against the windows of each arrival batch."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = windows.with_window_start(silver(spark, folder)).select("event_id", *keys)
        return windows.in_windows_per(rows, touched(spark, folder), keys, "batch_no")

    return query


silver_in_affected_sensor_windows = _silver_in(affected_sensor_windows, windows.SENSOR_KEYS)
silver_in_affected_site_windows = _silver_in(affected_site_windows, windows.SITE_KEYS)


# -- gold ------------------------------------------------------------------------------------


def _partials(spark, folder):
    return minutes.minute_partials(silver(spark, folder))


def sensor_minute(spark, folder):
    return minutes.sensor_minute(_partials(spark, folder))


def site_minute(spark, folder):
    return minutes.site_minute(_partials(spark, folder))


def site_alert_minute(spark, folder):
    return minutes.site_alert_minute(site_minute(spark, folder))


def sensor_latest_status(spark, folder):
    return status.sensor_latest_status(silver(spark, folder))


GOLD: dict[str, Query] = {
    m.SENSOR_MINUTE: sensor_minute,
    m.SITE_MINUTE: site_minute,
    m.SITE_ALERT_MINUTE: site_alert_minute,
    m.SENSOR_LATEST: sensor_latest_status,
}


# -- the tables after three batches -----------------------------------------------------------

_built: dict[tuple, ParquetLake] = {}

LARGE = BatchOptions(broadcast_bytes=0)


def new_lake(spark: SparkSession, purpose: str) -> ParquetLake:
    fx.use_utc(spark)
    schema = f"{purpose}_{uuid.uuid4().hex[:8]}"
    return ParquetLake(spark, work_folder(spark, purpose), schema).create()


def build_lake(
    spark: SparkSession, folder: str, options: BatchOptions = BatchOptions(), stray: bool = False
) -> ParquetLake:
    """A lake that took in the three arrival batches one after the other."""
    lake = new_lake(spark, "lake")
    records = fx.raw_records(spark, folder, stray)
    for n in fx.BATCHES:
        take_batch(lake, records, n, options)
    return lake


def take_batch(
    lake: ParquetLake, records: DataFrame, n: int, options: BatchOptions = BatchOptions(), again: int = 0
) -> None:
    process_batch(
        lake,
        records.where(F.col("batch_no") == n).select("value"),
        batch_id=n,
        dead_letters=letters_of(lake),
        run="fixture",
        options=options,
        processed_at=batch_time(n + again),
    )


def letters_of(lake: ParquetLake) -> FileDeadLetters:
    return FileDeadLetters(f"{lake.root}/dead_letters")


def kept_lake(spark: SparkSession, folder: str, *variant) -> ParquetLake:
    """The lake of :func:`build_lake`, built once per application, input folder and variant."""
    key = (spark.sparkContext.applicationId, folder, *variant)
    if key not in _built:
        _built[key] = build_lake(spark, folder, *variant)
    return _built[key].on(spark)


def _table_after_batches(table: str, *variant) -> Query:
    return lambda spark, folder: kept_lake(spark, folder, *variant).read(table)


def silver_literal_merge(spark, folder):
    """Silver as three insert-only merges leave it when a batch may repeat an id."""
    events = valid(spark, folder).select("event_id", *m.EVENT_COLUMNS, "batch_no")
    return first_batch_rows(events, "event_id", "batch_no")


def gold_rows(lake: ParquetLake, stamps: bool = True) -> DataFrame:
    """All rows of the four gold tables in one shape, with every contract column."""
    columns: dict[str, str] = {}
    for table in GOLD:
        columns |= dict(m.TABLES[table].columns)
    if not stamps:
        del columns["processed_at"]
    parts = []
    for table in GOLD:
        rows = lake.read(table)
        shape = [
            F.col(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in columns.items()
        ]
        parts.append(rows.select(F.lit(table).alias("table_name"), *shape))
    return reduce(DataFrame.unionByName, parts)


def gold_rebuild(spark, folder):
    """The gold tables after a rebuild from silver."""
    lake = new_lake(spark, "rebuild")
    lake.append(m.SILVER, stamped(silver(spark, folder), FIRST_BATCH_AT))
    rebuild_gold(lake, processed_at=FIRST_BATCH_AT)
    return gold_rows(lake)


def gold_large(spark, folder):
    """The gold tables of batches whose joins all take their form for big batches."""
    return gold_rows(kept_lake(spark, folder, LARGE))


def gold_stray_times(spark, folder):
    """The gold tables of batches with event times decades apart."""
    return gold_rows(kept_lake(spark, folder, BatchOptions(), True))


def gold_after_compaction(spark, folder):
    """The gold tables and silver after all hours were compacted."""
    lake = build_lake(spark, folder)
    lake.compact(datetime(2100, 1, 1, tzinfo=timezone.utc))
    return gold_rows(lake)


def gold_incremental_equals_rebuild(spark, folder):
    """Per gold table: rows kept up batch by batch, rows after a rebuild, rows that differ."""
    lake, other = kept_lake(spark, folder), new_lake(spark, "rebuilt")
    other.append(m.SILVER, lake.read(m.SILVER))
    rebuild_gold(other)
    parts = []
    for table in GOLD:
        columns = [c for c in m.TABLES[table].column_names if c != "processed_at"]
        kept, rebuilt = lake.read(table).select(*columns), other.read(table).select(*columns)
        marked = kept.withColumn("side", F.lit(1)).unionByName(rebuilt.withColumn("side", F.lit(-1)))
        balance = marked.groupBy(*columns).agg(
            F.sum("side").alias("surplus"),
            F.count_if(F.col("side") == 1).alias("kept"),
            F.count_if(F.col("side") == -1).alias("rebuilt"),
        )
        parts.append(
            balance.agg(
                F.sum("kept").alias("incremental_rows"),
                F.sum("rebuilt").alias("rebuilt_rows"),
                F.sum(F.abs("surplus")).alias("different_rows"),
            ).withColumn("table_name", F.lit(table))
        )
    return reduce(DataFrame.unionByName, parts)


def batch_replay(spark, folder):
    """The gold tables after the second batch came once more at the end."""
    lake = build_lake(spark, folder)
    take_batch(lake, fx.raw_records(spark, folder), 1, again=10)
    return gold_rows(lake)


def all_invalid_batch(spark, folder):
    """Rows per table, and dead letters per reason, after a batch of invalid records only."""
    lake = new_lake(spark, "invalid")
    judged = classified(spark, folder)
    bad = ev.invalid_events(judged).select(F.to_json(F.struct(*m.EVENT_COLUMNS)).alias("value"))
    letters = letters_of(lake)
    process_batch(lake, bad, 0, letters, "fixture")
    count = F.count(F.lit(1)).alias("found")
    tables = [lake.read(t).agg(count).select(F.lit(t).alias("name"), "found") for t in m.TABLES]
    reasons = letters.read(spark).groupBy(F.col(ev.ERROR).alias("name")).agg(count)
    return reduce(DataFrame.unionByName, [*tables, reasons])


def dlq_reprocessed(spark, folder):
    """The dead letters of the batches, fed back as raw records and judged again."""
    lake = kept_lake(spark, folder, BatchOptions(keep_raw=True))
    records = letters_of(lake).as_records(spark)
    return ev.classify(ev.parse_events(records, ("batch_id",)))


def adhoc_sql(spark, folder):
    """SQL of a reader over the views: alerts of each site per hour beside its events."""
    lake = kept_lake(spark, folder)
    return spark.sql(
        f"""
        SELECT a.site, date_trunc('HOUR', a.window_start) AS hour, a.alert_level,
               count(*) AS minutes, sum(s.event_count) AS events
        FROM {lake.view(m.SITE_ALERT_MINUTE)} a
        JOIN {lake.view(m.SITE_MINUTE)} s USING (site, window_start)
        GROUP BY ALL
        """
    )


# -- streaming --------------------------------------------------------------------------------


def stream_lake(spark: SparkSession, folder: str) -> ParquetLake:
    """Drop the batches as text files one by one; the job resumes from its checkpoint each time."""
    lake = new_lake(spark, "stream")
    inbox = f"{lake.root}/inbox"
    records = fx.raw_records(spark, folder)
    config = StreamConfig(
        root=lake.root,
        checkpoint=f"{lake.root}/checkpoint",
        source_format="text",
        source_path=inbox,
        dead_letters=letters_of(lake),
        schema=lake.schema,
        until_drained=True,
    )
    for n in fx.BATCHES:
        records.where(F.col("batch_no") == n).select("value").write.mode("append").text(inbox)
        query = start_stream(spark, config)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return lake


def stream_end_to_end(spark, folder):
    """Gold rows, silver events and dead letters the streaming job left behind."""
    lake = stream_lake(spark, folder)
    gold = gold_rows(lake, stamps=False).withColumn("label", F.lit(None).cast("string"))
    landed = lake.read(m.SILVER).select(
        F.lit(m.SILVER).alias("table_name"), F.col("event_id").alias("label"), *m.EVENT_COLUMNS
    )
    letters = letters_of(lake).read(spark).select(
        F.lit("dead_letters").alias("table_name"), F.col(ev.ERROR).alias("label"), *m.EVENT_COLUMNS
    )
    return gold.unionByName(landed, True).unionByName(letters, True)


# -- reports ----------------------------------------------------------------------------------


def _report(name: str) -> Query:
    return lambda spark, folder: report(kept_lake(spark, folder), name)


def ingest(spark, folder):
    judged = ingest_contract(fx.arrivals(spark, folder), now=FIRST_BATCH_AT)
    return judged.select("src_id", "batch_no", "accepted", "reject_reason", "event_time")


def ingest_filled_times(spark, folder):
    """Times the contract fills in by itself: within the run, whatever the instant."""
    began = datetime.now(timezone.utc)
    arrivals = fx.arrivals(spark, folder).withColumn("given", F.col("event_time"))
    filled = F.col("event_time").between(F.lit(began), F.current_timestamp())
    return ingest_contract(arrivals).select(
        "src_id",
        "batch_no",
        "accepted",
        "given",
        F.when(F.col("given").isNull(), F.coalesce(filled, F.lit(False)))
        .otherwise(F.col("event_time") == F.col("given"))
        .alias("as_expected"),
    )


def request_log_report(spark, folder):
    return requests.request_log_report(fx.request_log(spark, folder))


def request_log_report_small_steps(spark, folder):
    """The same with a last step so small that the percentile takes several rounds."""
    return requests.request_log_report(fx.request_log(spark, folder), final_rows=3)


def request_log_status_counts(spark, folder):
    return requests.status_counts(fx.request_log(spark, folder))


QUERIES: dict[str, Query] = {
    "parse_events": parse_events,
    "validation_errors": validation_errors,
    "validation_counts": validation_counts,
    "dlq_records": dlq_records,
    "events_with_id": events_with_id,
    "silver_dedup": silver_dedup,
    "silver_literal_merge": silver_literal_merge,
    "affected_sensor_windows": affected_sensor_windows,
    "affected_site_windows": affected_site_windows,
    "affected_sensors": affected_sensors,
    "silver_in_affected_sensor_windows": silver_in_affected_sensor_windows,
    "silver_in_affected_site_windows": silver_in_affected_site_windows,
    "sensor_minute": sensor_minute,
    "site_minute": site_minute,
    "site_alert_minute": site_alert_minute,
    "sensor_latest_status": sensor_latest_status,
    "gold_rebuild": gold_rebuild,
    "silver_insert_if_absent": _table_after_batches(m.SILVER),
    "sensor_minute_upsert": _table_after_batches(m.SENSOR_MINUTE),
    "site_minute_upsert": _table_after_batches(m.SITE_MINUTE),
    "site_alert_minute_upsert": _table_after_batches(m.SITE_ALERT_MINUTE),
    "sensor_latest_status_upsert": _table_after_batches(m.SENSOR_LATEST),
    "silver_insert_if_absent_large": _table_after_batches(m.SILVER, LARGE),
    "gold_large": gold_large,
    "gold_stray_times": gold_stray_times,
    "silver_stray_times": _table_after_batches(m.SILVER, BatchOptions(), True),
    "gold_after_compaction": gold_after_compaction,
    "gold_incremental_equals_rebuild": gold_incremental_equals_rebuild,
    "batch_replay": batch_replay,
    "all_invalid_batch": all_invalid_batch,
    "dlq_reprocessed": dlq_reprocessed,
    "adhoc_sql": adhoc_sql,
    "stream_end_to_end": stream_end_to_end,
    "report_latest_events": _report("latest_events"),
    "report_sensor_minute": _report("sensor_minute"),
    "report_site_minute": _report("site_minute"),
    "report_site_alerts": _report("site_alerts"),
    "report_sensor_status": _report("sensor_status"),
    "ingest_contract": ingest,
    "ingest_filled_times": ingest_filled_times,
    "request_log_report": request_log_report,
    "request_log_report_small_steps": request_log_report_small_steps,
    "request_log_status_counts": request_log_status_counts,
}


def registered() -> dict[str, Query]:
    def output(query: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            fx.use_utc(spark)
            return naive(query(spark, folder))

        return run

    return {name: output(query) for name, query in QUERIES.items()}
