"""Request log report, exact quantile, ingest contract."""

import json
import math
import random
from datetime import timedelta

import pytest

from fieldpulse.operators import requests
from fieldpulse.operators.ingest import ingest_contract, publish_payload
from fieldpulse.operators.reports import newest_rows
from tests.conftest import at, rows_of

NOW = at("2024-06-01T00:00:00")


def expected_value(values, share):
    return sorted(values)[max(math.floor(len(values) * share), 1) - 1]


def shapes():
    draw = random.Random(7)
    return {
        "one": [5.0],
        "two": [2.0, 1.0],
        "twenty": [float(i) for i in range(20)],
        "uniform": [draw.random() for _ in range(3000)],
        "a third is one value": [1.5] * 1000 + [draw.random() * 3 for _ in range(2000)],
        "nearly all equal": [3.0] * 2990 + [draw.random() for _ in range(10)],
        "huge spread": [10.0 ** draw.uniform(-200, 200) for _ in range(3000)],
        "negative too": [draw.gauss(0, 1) for _ in range(3000)],
    }


@pytest.mark.parametrize("shape", shapes())
@pytest.mark.parametrize("share", [0.95, 0.5, 0.0, 1.0])
def test_value_at_share_is_exact(spark, shape, share):
    values = shapes()[shape]
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    # a coarse sketch and a tiny last step force several rounds
    found = requests.value_at_share(frame, "x", share, accuracy=20, final_rows=15)
    assert found == expected_value(values, share)


def test_value_at_share_of_nothing(spark):
    assert requests.value_at_share(spark.createDataFrame([(None,)], "x double"), "x", 0.95) is None


def make_log(spark, *rows):
    typed = [(at(t), ok, s, ms) for t, ok, s, ms in rows]
    return spark.createDataFrame(
        typed, "started_at timestamp, ok boolean, status int, latency_ms double"
    )


def test_request_report(spark):
    log = make_log(
        spark,
        ("2024-01-01T00:00:00", True, 200, 500.0),
        ("2024-01-01T00:00:01", False, 502, 1000.0),
        ("2024-01-01T00:00:01", False, 0, 10.0),
    )
    row = requests.request_log_report(log).first()
    assert (row.requests, row.successes, row.failures) == (3, 1, 2)
    assert (row.duration_seconds, row.throughput_rps) == (2.0, 1.5)
    assert (row.latency_avg_ms, row.latency_p95_ms) == (503.33, 500.0)
    assert rows_of(requests.status_counts(log)) == [(0, 1), (200, 1), (502, 1)]


def test_request_report_of_one_and_of_none(spark):
    log = make_log(spark, ("2024-01-01T00:00:00", True, 200, 0.0))
    row = requests.request_log_report(log).first()
    assert (row.latency_p95_ms, row.throughput_rps) == (0.0, 0.0)
    nothing = requests.request_log_report(log.where("false")).first()
    assert (nothing.requests, nothing.latency_p95_ms) == (0, None)


def test_contract_rejects_an_empty_sensor_id(make_events):
    judged = ingest_contract(make_events(("", "factory-a", 20.0, 30.0, None)), NOW).first()
    assert (judged.accepted, judged.reject_reason) == (False, "sensor_id")


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        ((None, "a", 1.0, 1.0, None), "sensor_id"),
        (("s", "", 1.0, 1.0, None), "site"),
        (("s", "a", None, 1.0, None), "temperature"),
        (("s", "a", 1.0, None, None), "humidity"),
        (("s", "a", 999.0, -5.0, None), None),
    ],
)
def test_contract_needs_both_measures_but_no_range(make_events, row, reason):
    judged = ingest_contract(make_events(row), NOW).first()
    assert (judged.accepted, judged.reject_reason) == (reason is None, reason)


def payloads(frame):
    return [json.loads(r.value) for r in publish_payload(frame).collect()]


def test_missing_event_time_becomes_now(make_events):
    event = ("sensor-01", "factory-a", 21.5, 40.0, None)
    (payload,) = payloads(ingest_contract(make_events(event), NOW))
    assert payload == {
        "sensor_id": "sensor-01",
        "site": "factory-a",
        "temperature": 21.5,
        "humidity": 40.0,
        "event_time": NOW.isoformat(),
    }
    (current,) = payloads(ingest_contract(make_events(event)))
    assert at(current["event_time"]) > NOW


def test_explicit_event_time_is_kept(make_events):
    for time in ("2026-04-02T13:45:00+00:00", "2026-04-02T13:45:00.250000+00:00"):
        event = ("sensor-02", "factory-b", 25.0, 55.0, time)
        (payload,) = payloads(ingest_contract(make_events(event), NOW))
        assert payload["event_time"] == time


def test_only_accepted_events_are_published(make_events):
    judged = ingest_contract(
        make_events(("", "a", 1.0, 1.0, None), ("s", "a", 1.0, 1.0, None)), NOW
    )
    assert len(payloads(judged)) == 1


def test_newest_rows_break_ties_and_stop_at_the_limit(spark):
    start = at("2024-01-01T00:00:00")
    rows = [(start + timedelta(minutes=i // 2), f"s{i:02d}") for i in range(50)]
    frame = spark.createDataFrame(rows, "t timestamp, k string")
    found = [r.k for r in newest_rows(frame, "t", ["k"], 3).collect()]
    assert found == ["s48", "s49", "s46"]
    plan = newest_rows(frame, "t", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
