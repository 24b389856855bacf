"""Report over a request log: counts, throughput and latency.

Input columns: ``started_at timestamp, ok boolean, status int, latency_ms double``.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE = 0.95
SKETCH_ACCURACY = 10_000
FINAL_ROWS = 50_000


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("requests"))


def _totals() -> list[Column]:
    """Aggregates of one report row; the wall clock runs from first start to last completion."""
    started = F.unix_micros("started_at")
    ended = started + F.round(F.col("latency_ms") * 1000).cast("long")
    seconds = (F.max(ended) - F.min(started)) / F.lit(1_000_000)
    rate = F.try_divide(F.count(F.lit(1)).cast("double"), seconds)
    return [
        F.count(F.lit(1)).alias("requests"),
        F.count_if("ok").alias("successes"),
        F.count_if(~F.col("ok")).alias("failures"),
        seconds.alias("duration_seconds"),
        F.round(F.avg("latency_ms"), 2).alias("latency_avg_ms"),
        F.coalesce(rate, F.lit(0.0)).alias("throughput_rps"),
    ]


def request_totals(log: DataFrame) -> DataFrame:
    return log.agg(*_totals())


def request_log_report(log: DataFrame, final_rows: int = FINAL_ROWS) -> DataFrame:
    """Totals plus the 95th percentile, taken as the element at rank ``floor(0.95 n)``.

    Eager: the one row is computed here, in three reads of the log (more where the bracket of the
    percentile holds over ``final_rows``): totals with a sketch, counts beside the bracket, bracket.
    """
    values = log.select("latency_ms")
    size = F.count("latency_ms").alias("size")
    first = log.agg(*_totals(), size, *_bracket("latency_ms", QUANTILE)).first()
    sketch = first["size"], first["low"], first["high"]
    p95 = value_at_share(values, "latency_ms", QUANTILE, final_rows=final_rows, sketch=sketch)
    shape = request_totals(log).schema.add("latency_p95_ms", "double")
    row = [first[name] for name in shape.names[:-1]]
    return log.sparkSession.createDataFrame([(*row, None if p95 is None else round_half_up(p95))], shape)


def round_half_up(value: float) -> float:
    """Two decimals as SQL rounds them."""
    return float(Decimal(repr(value)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def _bracket(column: str, share: float, accuracy: int = SKETCH_ACCURACY) -> list[Column]:
    """Two values around a share, from a mergeable sketch, with room for its error."""
    room = 2 / accuracy
    shares = [max(share - room, 0.0), min(share + room, 1.0)]
    found = F.percentile_approx(column, shares, accuracy)
    return [found[0].alias("low"), found[1].alias("high")]


def value_at_share(
    values: DataFrame,
    column: str,
    share: float,
    accuracy: int = SKETCH_ACCURACY,
    final_rows: int = FINAL_ROWS,
    sketch: tuple[int, float, float] | None = None,
) -> float | None:
    """The exact value at rank ``max(floor(share * n), 1)`` among the sorted non-null values.

    Nothing is sorted as a whole.  Each round takes two values around the rank from a mergeable
    quantile sketch, counts exactly how many rows lie on each side of them, and goes on with the
    rows strictly between, about ``5 / accuracy`` of the round before; once these are ``final_rows``
    or fewer they are sorted directly.  Sketch and counts are one aggregation each with map-side
    combining.  The counts decide, so the result does not depend on the sketch's quality.
    ``sketch``: size and bracket of the first round, if known.
    """
    x = F.col(column)
    inside = values.where(x.isNotNull())
    if sketch is None:
        sketch = tuple(inside.agg(F.count(x), *_bracket(column, share, accuracy)).first())
    size, low, high = sketch
    if size == 0:
        return None
    rank = max(math.floor(size * share), 1)
    while True:
        below, upto_low, below_high, upto_high = inside.agg(
            F.count_if(x < low), F.count_if(x <= low), F.count_if(x < high), F.count_if(x <= high)
        ).first()
        if below < rank <= upto_low:
            return low
        if below_high < rank <= upto_high:
            return high
        if rank <= below:
            inside, size = inside.where(x < low), below
        elif rank <= below_high:
            inside, size = inside.where((x > low) & (x < high)), below_high - upto_low
            rank -= upto_low
        else:
            inside, size = inside.where(x > high), size - upto_high
            rank -= upto_high
        if size <= final_rows:
            return inside.agg(F.element_at(F.sort_array(F.collect_list(x)), rank)).first()[0]
        low, high = inside.agg(*_bracket(column, rank / size, accuracy)).first()
