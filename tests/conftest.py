from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

import pytest

from fieldpulse.model import EVENT_SCHEMA
from fieldpulse.session import build_session
from fieldpulse.sources.lake import ParquetLake

SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def without_settings(spark):
    """A session as Spark itself makes it, without this library's settings."""
    session = spark.newSession()
    session.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    session.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    return session


@pytest.fixture
def plain_session(spark):
    return without_settings(spark)


@pytest.fixture
def lake(spark, tmp_path):
    return ParquetLake(spark, str(tmp_path / "lake"), f"r_{uuid.uuid4().hex[:8]}").create()


@pytest.fixture
def make_events(spark):
    """Events from (sensor_id, site, temperature, humidity, ISO time text) tuples."""

    def make(*rows):
        typed = [(*row[:4], at(row[4]) if row[4] else None) for row in rows]
        return spark.createDataFrame(typed, EVENT_SCHEMA)

    return make


@pytest.fixture
def make_raw(spark):
    """Raw records from texts or from the same tuples as ``make_events``."""

    def text(row):
        if isinstance(row, str):
            return row
        names = EVENT_SCHEMA.fieldNames()
        return json.dumps({n: v for n, v in zip(names, row) if v is not None})

    def make(*rows):
        return spark.createDataFrame([(text(r),) for r in rows], "value string")

    return make


def at(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def rows_of(frame, *columns):
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)
