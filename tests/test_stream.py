"""The continuous job on a folder of text files."""

import json
import uuid
from dataclasses import replace

import pytest

from fieldpulse import model as m
from fieldpulse.plans import batch
from fieldpulse.sources import streams
from fieldpulse.sources.dead_letters import FileDeadLetters, KafkaDeadLetters
from fieldpulse.sources.lake import ParquetLake
from fieldpulse.streaming import job
from fieldpulse.streaming.job import StreamConfig, start_stream
from tests.conftest import rows_of


@pytest.fixture
def config(tmp_path):
    (tmp_path / "inbox").mkdir()
    return StreamConfig(
        root=str(tmp_path / "lake"),
        checkpoint=str(tmp_path / "checkpoint"),
        source_format="text",
        source_path=str(tmp_path / "inbox"),
        dead_letters=FileDeadLetters(str(tmp_path / "dlq")),
        schema=f"s_{uuid.uuid4().hex[:8]}",
        until_drained=True,
    )


def drop(config, *events):
    names = ["sensor_id", "site", "temperature", "humidity", "event_time"]
    texts = [e if isinstance(e, str) else json.dumps(dict(zip(names, e))) for e in events]
    with open(f"{config.source_path}/{uuid.uuid4().hex}.txt", "w") as file:
        file.write("\n".join(texts) + "\n")


def run(spark, config):
    query = start_stream(spark, config)
    query.awaitTermination()
    return query


def table(spark, config, name):
    return ParquetLake(spark, config.root, config.schema).read(name)


def test_restart_resumes_and_late_events_count(spark, config):
    drop(config, ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01Z"), "broken")
    run(spark, config)
    assert table(spark, config, m.SILVER).count() == 1

    drop(config, ("s", "a", 1.0, 1.0, "2024-01-02T00:00:01Z"))
    run(spark, config)
    drop(config, ("t", "a", 3.0, 1.0, "2024-01-01T00:00:59.999Z"))
    run(spark, config)
    found = table(spark, config, m.SITE_MINUTE)
    assert rows_of(found, "event_count", "avg_temperature") == [(1, 1.0), (2, 2.0)]
    assert rows_of(config.dead_letters.read(spark), "batch_id") == [(0,)]
    # views in the catalog show the same rows
    assert spark.table(f"{config.schema}.{m.SITE_MINUTE}").count() == 2


def test_a_backlog_is_worked_off_in_several_batches(spark, config):
    config = replace(config, source_options={"maxFilesPerTrigger": "1"})
    for day in (1, 2):
        drop(config, ("s", "a", 1.0, 1.0, f"2024-01-0{day}T00:00:01Z"), "broken")
    run(spark, config)
    assert rows_of(config.dead_letters.read(spark), "batch_id") == [(0,), (1,)]
    assert table(spark, config, m.SITE_MINUTE).count() == 2


def test_the_continuous_trigger(spark, config):
    drop(config, ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01Z"))
    query = start_stream(spark, replace(config, until_drained=False, trigger="1 second"))
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert table(spark, config, m.SENSOR_LATEST).count() == 1


def test_a_failed_batch_is_run_again_after_restart(spark, config, monkeypatch):
    drop(config, ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01Z"), "broken")
    with monkeypatch.context() as patch:

        def crash(*args, **kwargs):
            raise RuntimeError("driver lost")

        patch.setattr(ParquetLake, "upsert", crash)
        with pytest.raises(Exception, match="driver lost"):
            run(spark, config)
    assert table(spark, config, m.SILVER).count() == 1
    assert table(spark, config, m.SITE_MINUTE).count() == 0

    run(spark, config)
    assert table(spark, config, m.SILVER).count() == 1
    assert table(spark, config, m.SITE_MINUTE).count() == 1
    assert config.dead_letters.read(spark).count() == 1


def test_nothing_new_runs_no_batch(spark, config, monkeypatch):
    drop(config, ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01Z"))
    run(spark, config)
    calls = []
    monkeypatch.setattr(job, "process_batch", lambda *a, **k: calls.append(a))
    run(spark, config)
    assert calls == []


def test_another_session_zone_is_refused(spark, config):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            start_stream(spark, config)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_settings_from_the_environment():
    config = StreamConfig.from_env(
        {
            "KAFKA_BOOTSTRAP_SERVERS": "broker:1",
            "KAFKA_TOPIC": "in",
            "KAFKA_DLQ_TOPIC": "dead",
            "WAREHOUSE_PATH": "s3a://bucket/tables",
            "CHECKPOINT_PATH": "s3a://bucket/checkpoint",
            "CRITICAL_TEMPERATURE_THRESHOLD": "60",
        }
    )
    assert config.source_format == "kafka"
    assert config.source_options["subscribe"] == "in"
    assert config.source_options["startingOffsets"] == "earliest"
    assert config.dead_letters == KafkaDeadLetters("broker:1", "dead")
    assert config.batch.limits.critical_temperature == 60.0
    assert config.trigger == "15 seconds"
    assert not config.until_drained


def test_defaults_of_topics():
    config = StreamConfig.from_env({"WAREHOUSE_PATH": "/t", "CHECKPOINT_PATH": "/c"})
    assert config.source_options["subscribe"] == "sensor-events"
    assert config.dead_letters.topic == "sensor-events-dlq"


def test_only_scans_with_few_splits_are_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    few = spark.range(0, 100, 1, 1)
    assert streams.spread(few).rdd.getNumPartitions() == cores
    assert streams.spread(few, 2).rdd.getNumPartitions() == 2
    many = spark.range(0, 100, 1, cores)
    assert streams.spread(many) is many


def test_input_tasks_can_be_set():
    env = {"WAREHOUSE_PATH": "/t", "CHECKPOINT_PATH": "/c", "MIN_PARTITIONS": "96"}
    assert StreamConfig.from_env(env).source_options["minPartitions"] == "96"
    assert "minPartitions" not in streams.kafka_options("b", "t")


def test_backfill_reads_the_same_records(spark, config):
    drop(config, ("s", "a", 1.0, 1.0, "2024-01-01T00:00:01Z"), "broken")
    raw = streams.open_batch(spark, "text", {}, config.source_path)
    lake = ParquetLake(spark, config.root, config.schema).create()
    profile = batch.process_batch(lake, raw, 0)
    assert (profile.rows, profile.valid) == (2, 1)
