"""Which part of the time tables a batch touches, as filters that prune at planning time."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.functions.timegrid import utc_day, utc_hour

#: Partitions are listed one by one up to here; more are covered by ranges.
LISTED_HOURS = 10_000
#: Ranges a filter is made of at most; what they add lies in the narrowest gaps.
RANGES = 200
#: Ranges for the scan of Parquet files, which tests each of them on every row group.
SCAN_RANGES = 50
#: A batch that touches more hours than this lets those with few rows share partitions.
FEW_HOURS = 200
#: Touched rows from which on an hour of such a batch has its own partition.
HOUR_ROWS = 10_000
#: Days whose sparse hours share a partition, counted from the first day of year 1, and its hour.
PERIOD_DAYS = 3652
FIRST_DAY = -719162
SHARED_HOUR = -1
#: Shared partitions are numbered from here on, far beyond all hours.
SHARED = 10**9
HOUR_SECONDS = 3600
MINUTE_SECONDS = 60

Range = tuple[int, int]


@dataclass(frozen=True, order=True)
class Hour:
    """One partition of the time tables and the touched span in it.

    The day is counted from the epoch; ``first`` and ``end`` are seconds since the epoch, the
    end not included.
    """

    day: int
    hour: int
    first: int
    end: int

    @classmethod
    def whole(cls, day: int, hour: int) -> Hour:
        first = (day * 24 + hour) * HOUR_SECONDS
        return cls(day, hour, first, first + HOUR_SECONDS)

    @property
    def number(self) -> int:
        return self.day * 24 + self.hour


def period(day: int) -> int:
    """The first day of the period of a day."""
    return day - (day - FIRST_DAY) % PERIOD_DAYS


def shared_number(first: int) -> int:
    """Number of the shared partition of a period, which may begin before the epoch."""
    return 2 * SHARED + first


def shared_day(number: int) -> int:
    return number - 2 * SHARED


def period_sql(day: str) -> str:
    return f"({day} - pmod({day} - ({FIRST_DAY}), {PERIOD_DAYS}))"


def covered(ranges: Sequence[Range], most: int) -> list[Range]:
    """At most ``most`` ranges that cover sorted ranges and leave out the widest gaps between them.

    A stray range far from the others so costs one range, and nothing in between.
    """
    gaps = [(after[0] - before[1], i) for i, (before, after) in enumerate(zip(ranges, ranges[1:]))]
    kept = {i for gap, i in sorted(gaps, reverse=True)[: most - 1] if gap > 0}
    found: list[Range] = []
    for i, (first, end) in enumerate(ranges):
        if found and i - 1 not in kept:
            found[-1] = (found[-1][0], max(found[-1][1], end))
        else:
            found.append((first, end))
    return found


@dataclass(frozen=True)
class HourScope:
    """The touched (day, hour) partitions with the span of time touched in each.

    Everything touched is inside the filters, so they lose no row.  ``own`` names the hours whose rows
    are written to a partition of their own; None: all of them.
    """

    hours: tuple[Hour, ...] = ()
    own: frozenset[int] | None = None

    @classmethod
    def of(cls, rows: DataFrame, clock: str, lasting: int = 1) -> HourScope:
        """Scope of rows that each last ``lasting`` seconds from the second of their clock."""
        found = by_hour(rows, clock, lasting, F.count(F.lit(1))).collect()
        return cls.from_rows(found, [row[4] for row in found])

    @classmethod
    def from_rows(cls, rows: Iterable, sizes: Sequence[int] | None = None) -> HourScope:
        """From rows that begin with the columns of :func:`by_hour`, and the number of rows of each hour."""
        hours = [Hour(*row[:4]) for row in rows]
        own = None
        if sizes is not None and len(hours) > FEW_HOURS:
            own = frozenset(h.number for h, size in zip(hours, sizes) if size >= HOUR_ROWS)
        return cls(tuple(sorted(hours)), own)

    @property
    def written(self) -> set[int]:
        """Numbers of the partitions that rows of this scope are written to."""
        own = self.own
        return {h.number if own is None or h.number in own else shared_number(period(h.day)) for h in self.hours}

    def partitions(self, periods: Iterable[int] = ()) -> Column:
        """All rows of the touched partitions; ``periods`` are those that have a shared one."""
        shared = sorted({period(h.day) for h in self.hours}.intersection(periods))
        held = self._own_partitions() & (F.col("part_hour") != SHARED_HOUR)
        return held | _shared(shared) if shared else held

    def _own_partitions(self) -> Column:
        number = F.unix_date("part_day") * 24 + F.col("part_hour")
        if len(self.hours) <= LISTED_HOURS:
            return number.isin([h.number for h in self.hours]) & F.col("part_day").isin(
                [_day(d) for d in sorted({h.day for h in self.hours})]
            )
        ranges = covered([(h.number, h.number + 1) for h in sorted(self.hours)], RANGES)
        return _any((number >= first) & (number < end) for first, end in ranges)

    def spans(self, clock: Column, most: int = SCAN_RANGES) -> Column:
        """Rows in the touched spans, by the clock column itself.

        Parquet skips row groups outside of them, so of an hour that fills up over time only the
        recent files are read.
        """
        spans = covered([(hour.first, hour.end) for hour in sorted(self.hours)], most)
        return _any((clock >= _second(first)) & (clock < _second(end)) for first, end in spans)


def numbered(numbers: Iterable[int]) -> Column:
    """Rows of exactly these partitions."""
    numbers = list(numbers)
    held = HourScope(tuple(Hour.whole(n // 24, n % 24) for n in numbers if n < SHARED)).partitions()
    shared = [shared_day(n) for n in numbers if n >= SHARED]
    return held | _shared(shared) if shared else held


def placed(clock: str, own: frozenset[int] | None) -> tuple[Column, Column]:
    """Day and hour of the partition that a row is written to."""
    day, hour = utc_day(clock), utc_hour(clock)
    if own is None:
        return day, hour
    number = F.unix_date(day) * 24 + hour
    alone = number.isin(sorted(own)) if own else F.lit(False)
    since = F.unix_date(day)
    first = F.date_from_unix_date(since - F.pmod(since - F.lit(FIRST_DAY), F.lit(PERIOD_DAYS)))
    return F.when(alone, day).otherwise(first), F.when(alone, hour).otherwise(F.lit(SHARED_HOUR))


def by_hour(rows: DataFrame, clock: str, lasting: int, *measures: Column) -> DataFrame:
    """One row per touched hour: day, hour, first and last second, and aggregates beside them."""
    second = F.unix_seconds(clock)
    day, hour = F.unix_date(utc_day(clock)).alias("day"), utc_hour(clock).alias("hour")
    return rows.groupBy(day, hour).agg(F.min(second), F.max(second) + F.lit(lasting), *measures)


def _any(conditions) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _shared(periods: Iterable[int]) -> Column:
    return (F.col("part_hour") == SHARED_HOUR) & F.col("part_day").isin([_day(d) for d in periods])


def _second(seconds_since_epoch: int) -> Column:
    return F.timestamp_seconds(F.lit(seconds_since_epoch))


def _day(days_since_epoch: int) -> Column:
    return F.date_from_unix_date(F.lit(days_since_epoch))
