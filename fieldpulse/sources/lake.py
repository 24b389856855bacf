"""The five tables as Parquet tables of the session catalog that batches only ever append to.

Readers use the views of the ``reporting`` schema, which show exactly the contract columns.  The
files belong to tables of a second schema, partitioned by UTC day, hour and level: level 0 is what
batches appended, level 1 what a compaction made of it.  The catalog knows the partitions, so a read
with a partition filter lists only the folders it needs.

Gold rows are appended with a version, and the newest row of each key counts (for the latest status:
the row of the newest event).  A version is the number after the largest one in the tables, which the
writer reads once; it owes nothing to a clock, so a writer on another machine goes on where the last
one ended.  A batch writes the rows it changed and nothing else, reads no gold, and never takes a file
away from a reader.  A row of a key that is gone is marked as such.

:meth:`ParquetLake.compact` turns hours that are over into level 1: one row per key, few files.  The
views read level 1 as it is and look for newest rows only in the other hours, so what a read costs
follows the rows, not the batches.  An hour that gets rows again after its compaction is *reopened*: the
views name it before the first row is written, and find its newest rows in both levels.  The latest
status is kept in buckets of sensors instead of hours; a compaction rewrites those that got rows.

A batch that touches very many hours writes those of them with few rows to partitions that the sparse
hours of ten years share, so that the number of files follows the rows and not the span of their times.
Where rows of an hour lie then no longer follows from their time: the hours of a period with a shared
partition are read together with it, and of each key the newest row counts wherever it is.

A compaction first writes the merged partitions beside the table and then publishes them; if the
driver dies in between, the finished copy is published before the table is written again.  Each lake
has one writer at a time, which opens it with :meth:`ParquetLake.create`.  Appends are single Spark
jobs, so lost executors only cost task retries.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldpulse.functions.timegrid import utc_day, utc_hour
from fieldpulse.model import SENSOR_LATEST, SILVER, TABLES, TableSpec
from fieldpulse.session import prepare_writes
from fieldpulse.sources.files import children, delete_tree, path_exists
from fieldpulse.sources.scope import (
    LISTED_HOURS,
    RANGES,
    SHARED,
    SHARED_HOUR,
    Hour,
    HourScope,
    covered,
    numbered,
    period,
    period_sql,
    placed,
    shared_day,
    shared_number,
)


class Lake(Protocol):
    """What the plans need from a set of tables."""

    spark: SparkSession

    def create(self) -> Lake: ...
    def on(self, spark: SparkSession) -> Lake: ...
    def read(self, table: str, scope: HourScope | None = None) -> DataFrame: ...
    def scan(self, table: str, scope: HourScope | None = None) -> DataFrame: ...
    def newest_hours(self, table: str) -> Iterator[Hour] | None: ...
    def append(self, table: str, rows: DataFrame, scope: HourScope | None = None) -> None: ...
    def upsert(self, table: str, rows: DataFrame, scope: HourScope) -> None: ...
    def advance(self, rows: DataFrame) -> None: ...
    def overwrite(self, table: str, rows: DataFrame, scope: HourScope | None = None) -> None: ...
    def compact(self, until: datetime, *tables: str) -> None: ...
    def scratch(self, name: str) -> str: ...


#: Columns of the gold files that the views do not show.  Rows of the latest status from before the
#: last rebuild (an older epoch) do not count; the event id decides between events of equal time.
_VERSIONED = (("written_at", "BIGINT"), ("gone", "BOOLEAN"))
_STATUS = (("event_id", "STRING"), ("epoch", "BIGINT"))
#: Buckets of sensors in the latest status, and the one that batches append to.
BUCKETS = 64
APPENDED = -1
#: Partitions named in one statement that drops them.
DROPPED_AT_ONCE = 500


def _versioned(spec: TableSpec) -> bool:
    return spec.name != SILVER


def _hidden(spec: TableSpec) -> tuple[tuple[str, str], ...]:
    if spec.name == SENSOR_LATEST:
        return _STATUS + _VERSIONED
    return _VERSIONED if _versioned(spec) else ()


def _partitions(spec: TableSpec) -> tuple[tuple[str, str], ...]:
    if spec.clock is None:
        return (("part_bucket", "INT"),)
    return (*spec.partition_columns, ("part_level", "INT"))


def _names(columns: Iterable[tuple[str, str]]) -> list[str]:
    return [name for name, _ in columns]


def _hours_sql(numbers: Iterable[int]) -> str:
    """A filter on partitions that holds for these hours, and if they are many for some between."""
    ranges = covered([(n, n + 1) for n in sorted(numbers)], RANGES)
    number = "unix_date(part_day) * 24 + part_hour"
    return " OR ".join(f"{number} BETWEEN {first} AND {end - 1}" for first, end in ranges) or "false"


@dataclass
class _State:
    """What the writer knows of its tables.

    Hours are numbered; the status has hour 0 only, and shared partitions have numbers from SHARED on.
    """

    lock: threading.Lock = field(default_factory=threading.Lock)
    version: int | None = None
    epoch: int = 0
    appended: dict[str, set[int]] = field(default_factory=dict)
    compacted: dict[str, set[int]] = field(default_factory=dict)
    views: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ParquetLake:
    spark: SparkSession
    root: str
    schema: str = "reporting"
    state: _State = field(default_factory=_State, compare=False, repr=False)

    @property
    def file_schema(self) -> str:
        return f"{self.schema}_files"

    def on(self, spark: SparkSession) -> ParquetLake:
        """The same lake through another session (a streaming batch has its own)."""
        return replace(self, spark=spark)

    # -- definition ---------------------------------------------------------------------

    def create(self) -> ParquetLake:
        """Create what is missing, learn what is there, and finish an interrupted compaction.

        Only a catalog that does not know a table yet looks for its partitions in the folders.
        """
        for schema in (self.schema, self.file_schema):
            location = f"{self.root}/_schemas/{schema}"
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{location}'")
        self.state.version = None
        self.state.views.clear()
        for spec in TABLES.values():
            self._create_table(spec)
            self._publish_staged(spec)
        return self

    def _create_table(self, spec: TableSpec) -> None:
        if not self.spark.catalog.tableExists(self._files(spec)):
            columns = [*spec.columns, *_hidden(spec), *_partitions(spec)]
            self.spark.sql(
                f"CREATE TABLE {self._files(spec)} ({', '.join(f'{n} {t}' for n, t in columns)}) "
                f"USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
                f"PARTITIONED BY ({', '.join(_names(_partitions(spec)))}) LOCATION '{self._location(spec)}'"
            )
            if path_exists(self.spark, self._location(spec)):
                self.spark.sql(f"ALTER TABLE {self._files(spec)} RECOVER PARTITIONS")
        self._check_location(spec)
        self._look(spec)
        self._show(spec)

    def _check_location(self, spec: TableSpec) -> None:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._files(spec)}")
        location = described.where("col_name = 'Location'").first().data_type
        if not location.endswith(self._location(spec)):
            raise ValueError(f"{self._files(spec)} already exists at {location}")

    def view(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def _files(self, spec: TableSpec) -> str:
        return f"{self.file_schema}.{spec.name}"

    def _location(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def _staging(self, spec: TableSpec) -> str:
        return f"{self.root}/_staging/{spec.name}"

    def scratch(self, name: str) -> str:
        return f"{self.root}/_staging/{name}"

    # -- which partitions there are -------------------------------------------------------

    def _look(self, spec: TableSpec) -> None:
        """Take from the catalog which hours have appended rows and which have compacted ones."""
        appended, compacted = set(), set()
        days: dict[str, int] = {}
        for (text,) in self.spark.sql(f"SHOW PARTITIONS {self._files(spec)}").collect():
            value = dict(part.split("=", 1) for part in text.split("/"))
            if spec.clock is None:
                (appended if int(value["part_bucket"]) == APPENDED else compacted).add(0)
                continue
            day = value["part_day"]
            if day not in days:
                days[day] = self._day_number(day)
            hour = _number(days[day], int(value["part_hour"]))
            (compacted if int(value["part_level"]) else appended).add(hour)
        self.state.appended[spec.name], self.state.compacted[spec.name] = appended, compacted

    def _day_number(self, text: str) -> int:
        return self.spark._jvm.java.time.LocalDate.parse(text).toEpochDay()

    def _periods(self, spec: TableSpec) -> set[int]:
        """First days of the periods that have a shared partition."""
        numbers = self.state.appended[spec.name] | self.state.compacted[spec.name]
        return {shared_day(n) for n in numbers if n >= SHARED}

    def _reopened(self, spec: TableSpec) -> set[int]:
        """Compacted hours that may have rows elsewhere."""
        periods = self._periods(spec)
        appended, compacted = self.state.appended[spec.name], self.state.compacted[spec.name]
        return {h for h in compacted if h < SHARED and (h in appended or period(h // 24) in periods)}

    def newest_hours(self, table: str) -> Iterator[Hour]:
        """Hours of a time-partitioned table, newest first; looks at days as they are needed."""
        spec = TABLES[table]
        if path_exists(self.spark, self._location(spec)):
            self._look(spec)
        if periods := self._periods(spec):
            yield from self._newest_of_periods(spec, periods)
            return
        day_number = {}
        for name in children(self.spark, self._location(spec)):
            if name.startswith("part_day="):
                text = name.removeprefix("part_day=")
                day_number[text] = self._day_number(text)
        for text in sorted(day_number, key=day_number.get, reverse=True):
            folder = f"{self._location(spec)}/part_day={text}"
            hours = [int(n.removeprefix("part_hour=")) for n in children(self.spark, folder) if "=" in n]
            for hour in sorted(hours, reverse=True):
                yield Hour.whole(day_number[text], hour)

    def _newest_of_periods(self, spec: TableSpec, shared: set[int]) -> Iterator[Hour]:
        """The same period by period, with the hours that share partitions."""
        hours: dict[int, set[int]] = {first: set() for first in shared}
        for number in self.state.appended[spec.name] | self.state.compacted[spec.name]:
            if number < SHARED:
                hours.setdefault(period(number // 24), set()).add(number)
        for first in sorted(hours, reverse=True):
            if first in shared:
                rows = self.spark.read.table(self._files(spec)).where(numbered([shared_number(first)]))
                number = F.unix_date(utc_day(spec.clock)) * 24 + utc_hour(spec.clock)
                hours[first] |= {n for (n,) in rows.select(number).distinct().collect()}
            yield from (Hour.whole(n // 24, n % 24) for n in sorted(hours[first], reverse=True))

    # -- the rows that count --------------------------------------------------------------

    def _rows_sql(
        self, spec: TableSpec, columns: list[str], where: str, newest: bool, within: bool = True, marks: str = "false"
    ) -> str:
        """Stored rows of some partitions; if wanted only the newest of each key.

        Partition columns are window keys, so filters on them still prune, unless a key may have rows in
        several partitions (not ``within`` one).  Marks of keys that are gone stay where ``marks`` holds.
        """
        names = ", ".join(columns)
        files = f"{self._files(spec)} WHERE {where}"
        if not newest:
            return f"SELECT {names} FROM {files}"
        if spec.name == SENSOR_LATEST:  # the newest event, but the stamp of the newest batch
            last = ["processed_at", "written_at"]
            others = [c for c in columns if c != "sensor_id" and c not in last]
            held = ", ".join([*(c for c in others if c != "gone"), "gone"])
            order = "struct(-epoch AS e, gone, -unix_micros(event_time) AS t, event_id, -written_at AS w)"
            picked = ", ".join(f"newest.{c}" if c in others else c for c in columns)
            return (
                f"SELECT {picked} FROM (SELECT sensor_id, min_by(struct({held}), {order}) "
                f"AS newest, max_by(processed_at, written_at) AS processed_at, max(written_at) AS written_at "
                f"FROM {files} GROUP BY sensor_id) WHERE NOT newest.gone"
            )
        keys = ", ".join((*spec.partition_names, *spec.keys) if within else spec.keys)
        return (
            f"SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY written_at DESC) AS age FROM {files}) WHERE age = 1 AND (NOT gone OR {marks})"
        )

    def _counting_sql(self, spec: TableSpec) -> str:
        """The text of a table's view, for the partitions the writer knows."""
        columns = spec.column_names
        appended, compacted = self.state.appended[spec.name], self.state.compacted[spec.name]
        shared = bool(self._periods(spec))
        if not _versioned(spec) or not appended and compacted and not shared:
            return self._rows_sql(spec, columns, "true", newest=False)
        if spec.clock is None or not compacted:
            return self._rows_sql(spec, columns, "true", newest=True, within=not shared)
        open_ = f"part_level = 0 OR {_hours_sql(self._reopened(spec))}"
        if shared:
            open_ += f" OR part_hour = {SHARED_HOUR}"
        settled = self._rows_sql(spec, columns, f"NOT ({open_})", newest=False)
        return f"{settled} UNION ALL {self._rows_sql(spec, columns, open_, newest=True, within=not shared)}"

    def _show(self, spec: TableSpec) -> None:
        """Let the view follow the partitions, if its text changes."""
        text = self._counting_sql(spec)
        if self.state.views.get(spec.name) != text:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.view(spec.name)} AS {text}")
            self.state.views[spec.name] = text

    # -- reading ------------------------------------------------------------------------

    def read(self, table: str, scope: HourScope | None = None) -> DataFrame:
        """Contract columns of a table, cut to the rows in scope.

        Looks for changes by other sessions first.  That drops cached frames which depend on
        the table, so the steps of a batch use :meth:`scan`.
        """
        spec = TABLES[table]
        self.spark.catalog.refreshTable(self._files(spec))
        if scope is not None and spec.clock:
            self._look(spec)
        return self.scan(table, scope)

    def scan(self, table: str, scope: HourScope | None = None) -> DataFrame:
        """Like :meth:`read`, for the writer of the lake: sees the session's own writes.

        Of compacted hours the stored rows are read as they are.
        """
        spec = TABLES[table]
        if scope is None or spec.clock is None:
            return self.spark.read.table(self.view(table))
        if not _versioned(spec):
            return self._in_scope(spec, scope, newest=False)
        appended, periods = self.state.appended[table], self._periods(spec)
        unsure = {h for h in scope.hours if h.number in appended or period(h.day) in periods}
        open_ = HourScope(tuple(h for h in scope.hours if h in unsure))
        settled = HourScope(tuple(h for h in scope.hours if h not in unsure))
        if not settled.hours or len(scope.hours) > LISTED_HOURS:  # ranges would not tell them apart
            return self._in_scope(spec, scope, newest=True)
        rows = self._in_scope(spec, settled, newest=False)
        return rows.unionByName(self._in_scope(spec, open_, newest=True)) if open_.hours else rows

    def _in_scope(self, spec: TableSpec, scope: HourScope, newest: bool) -> DataFrame:
        columns, periods = [*spec.column_names, *_names(_partitions(spec))], self._periods(spec)
        touched = scope.partitions(periods)
        if newest and periods:  # a key may have rows in several partitions
            stored = self.spark.read.table(self._files(spec)).where(touched)
            age = F.row_number().over(Window.partitionBy(*spec.keys).orderBy(F.col("written_at").desc()))
            rows = stored.withColumn("age", age).where("age = 1 AND NOT gone")
        else:
            rows = self.spark.sql(self._rows_sql(spec, columns, "true", newest)).where(touched)
        return rows.where(scope.spans(F.col(spec.clock))).select(*spec.column_names)

    # -- writing ------------------------------------------------------------------------

    def _next_version(self) -> int:
        """One more than any version in the tables or given before."""
        with self.state.lock:
            if self.state.version is None:
                self.state.version, self.state.epoch = self._stored_versions()
            self.state.version += 1
            return self.state.version

    def _stored_versions(self) -> tuple[int, int]:
        """The largest version and epoch, from one column of each table that has partitions."""
        found = []
        for spec in filter(_versioned, TABLES.values()):
            if self.state.appended[spec.name] or self.state.compacted[spec.name]:
                epoch = F.max("epoch") if spec.name == SENSOR_LATEST else F.lit(0)
                found.append(self.spark.read.table(self._files(spec)).agg(F.max("written_at"), epoch).first())
        return max((v or 0 for v, _ in found), default=0), max((e or 0 for _, e in found), default=0)

    def _stamped_rows(self, rows: DataFrame, gone: Column | None = None) -> DataFrame:
        gone = F.lit(False) if gone is None else gone
        return rows.withColumns({"written_at": F.lit(self._next_version()).cast("long"), "gone": gone})

    def _laid_out(
        self, spec: TableSpec, rows: DataFrame, level: int = 0, own: frozenset[int] | None = None
    ) -> DataFrame:
        """Rows with partition columns, gathered per partition and sorted for the writer.

        The rebalance step is adaptive: it splits a big partition over several tasks and packs
        small ones together, so a hot hour is not written by one task.  Compacted rows stay in the
        partition they come from.
        """
        parts = _names(_partitions(spec))
        if spec.clock:
            where = map(F.col, spec.partition_names) if level else placed(spec.clock, own)
            values = [*where, F.lit(level)]
        else:
            values = [_bucket() if level else F.lit(APPENDED)]
        laid = rows.select(
            *spec.column_names, *_names(_hidden(spec)), *[v.alias(n) for v, n in zip(values, parts)]
        )
        order = list(spec.sort)
        if spec.clock and (level or own is not None):  # by time, so that scans skip what they do not need
            order.insert(0, F.when(F.col("part_hour") == SHARED_HOUR, F.col(spec.clock)))
        return laid.hint("rebalance", *parts).sortWithinPartitions(*parts, *order)

    def append(self, table: str, rows: DataFrame, scope: HourScope | None = None) -> None:
        """Add rows; those of hours that ``scope`` does not give a partition share one."""
        spec = TABLES[table]
        prepare_writes(rows.sparkSession)
        self._publish_staged(spec)
        if scope is None or scope.own is None:
            laid = self._laid_out(spec, rows)
        else:
            self.state.appended[table] |= scope.written
            laid = self._laid_out(spec, rows, own=scope.own)
        laid.write.insertInto(self._files(spec))

    def _append_versions(
        self, spec: TableSpec, rows: DataFrame, hours: set[int] | None, scope: HourScope | None = None
    ) -> None:
        """Append gold rows of some partitions (None: of any), which the view names before they are there."""
        self._publish_staged(spec)
        known = self.state.appended[spec.name]
        known |= self.state.compacted[spec.name] if hours is None else hours
        if scope is not None and scope.own is not None:
            known |= scope.written
        self._show(spec)
        self.append(spec.name, rows, scope)

    def upsert(self, table: str, rows: DataFrame, scope: HourScope) -> None:
        """Add rows that replace those with equal keys; nothing is read or rewritten."""
        self._append_versions(TABLES[table], self._stamped_rows(rows), scope.written or None, scope)

    def advance(self, rows: DataFrame) -> None:
        """Add candidates for the latest status, with the id of their event."""
        spec = TABLES[SENSOR_LATEST]
        written = self._stamped_rows(rows)
        self._append_versions(spec, written.withColumn("epoch", F.lit(self.state.epoch).cast("long")), {0})

    def overwrite(self, table: str, rows: DataFrame, scope: HourScope | None = None) -> None:
        """Replace the whole table by one append: the new rows, and a mark for each key that goes.

        ``scope`` is that of the new rows, if it is known.  Readers see every row either old or new.  :meth:`compact` drops what is outdated.
        """
        spec = TABLES[table]
        written = self._stamped_rows(self.replacing(table, rows), F.col("gone"))
        if spec.name == SENSOR_LATEST:
            with self.state.lock:
                self.state.epoch = self.state.version
            written = written.withColumn("epoch", F.lit(self.state.epoch).cast("long"))
        self._append_versions(spec, written, None if spec.clock else {0}, scope)
        if spec.clock:
            self._look(spec)
            self._show(spec)

    def replacing(self, table: str, rows: DataFrame) -> DataFrame:
        """The rows that replace a table, and its other keys marked as gone: one pass over either side."""
        spec = TABLES[table]
        keys = list(spec.keys)
        others = [c for c in rows.columns if c not in keys]
        stored = self.spark.read.table(self._files(spec)).select(*keys).distinct()
        new = rows.select(*keys, F.struct(*others).alias("new"))
        joined = new.join(stored, keys, "full_outer")
        return joined.select(*keys, "new.*", F.col("new").isNull().alias("gone"))

    # -- compaction ---------------------------------------------------------------------

    def compact(self, until: datetime, *tables: str) -> None:
        """Turn hours before ``until`` that batches appended to into one row per key and few files.

        Looks at nothing else: hours compacted before, and buckets of sensors without new rows, stay
        as they are.  The latest status has no hours and is always brought up to date.
        """
        last = int(until.timestamp()) // 3600
        for spec in map(TABLES.get, tables or TABLES):
            self._publish_staged(spec)
            self.spark.catalog.refreshTable(self._files(spec))
            self._look(spec)
            appended = self.state.appended[spec.name]
            todo = sorted(h for h in appended if h < last or h >= SHARED or spec.clock is None)
            for at in range(0, len(todo), LISTED_HOURS):
                hours = todo[at : at + LISTED_HOURS]
                self._stage(spec, self._merged(spec, hours))
                self._publish(spec, hours)

    def _merged(self, spec: TableSpec, hours: list[int]) -> DataFrame:
        """The rows of some hours that count, with their hidden columns."""
        columns = [*spec.column_names, *_names(_hidden(spec))]
        if spec.clock:
            columns += spec.partition_names
            periods = self._periods(spec)
            marks = f"{period_sql('unix_date(part_day)')} IN ({', '.join(map(str, sorted(periods)))})"
            sql = self._rows_sql(spec, columns, "true", newest=_versioned(spec), marks=marks if periods else "false")
            return self.spark.sql(sql).where(numbered(hours))
        buckets = ", ".join(map(str, [APPENDED, *self._touched_buckets(spec)]))
        return self.spark.sql(self._rows_sql(spec, columns, f"part_bucket IN ({buckets})", newest=True))

    def _touched_buckets(self, spec: TableSpec) -> list[int]:
        """The buckets of the sensors with appended status rows."""
        appended = self.spark.read.table(self._files(spec)).where(F.col("part_bucket") == APPENDED)
        return sorted(r[0] for r in appended.select(_bucket()).distinct().collect())

    def _stage(self, spec: TableSpec, rows: DataFrame) -> None:
        prepare_writes(rows.sparkSession)
        writer = self._laid_out(spec, rows, level=1).write.mode("overwrite")
        writer.partitionBy(*_names(_partitions(spec))).parquet(self._staging(spec))

    def _publish(self, spec: TableSpec, hours: list[int] | None = None) -> None:
        """Let the staged partitions take the place of the rows they were made of.

        Versioned rows may be there twice for a while, since readers pick the newest.  Other rows may not,
        so the old ones leave the catalog first.  Hours of which nothing is left have no staged partition:
        their compacted rows go before the marks do.
        """
        staged_parts = self._staged_parts(spec)
        if spec.clock:
            merged = {h for h, _ in staged_parts} | set(hours or ())
            old = [self._part(h, 0) for h in sorted(merged)]
            empty = [self._part(h, 1) for h in sorted(merged - {h for h, _ in staged_parts})]
        else:
            merged, old = {0}, [f"part_bucket={APPENDED}"]
            empty = [f"part_bucket={b}" for b in self._touched_buckets(spec) if (0, b) not in staged_parts]
        self.state.appended[spec.name] |= merged
        self._show(spec)
        if not _versioned(spec):
            self._forget(spec, [*old, *empty])
        if staged_parts:
            table = self.spark.read.table(self._files(spec))
            staged = self.spark.read.schema(table.schema).parquet(self._staging(spec))
            staged.select(*table.columns).write.insertInto(self._files(spec), overwrite=True)
        self._drop(spec, empty)
        self._drop(spec, old)
        delete_tree(self.spark, f"{self._staging(spec)}/_SUCCESS")  # what is left now is not complete
        delete_tree(self.spark, self._staging(spec))
        self.spark.catalog.refreshTable(self._files(spec))
        self._look(spec)
        self._show(spec)

    def _staged_parts(self, spec: TableSpec) -> set[tuple[int, int]]:
        """(hour, level) or (0, bucket) of the staged partitions."""
        def values(folder: str, name: str) -> list[str]:
            names = children(self.spark, folder)
            return [n.removeprefix(f"{name}=") for n in names if n.startswith(f"{name}=")]

        root = self._staging(spec)
        if spec.clock is None:
            return {(0, int(b)) for b in values(root, "part_bucket")}
        return {
            (_number(self._day_number(day), int(hour)), 1)
            for day in values(root, "part_day")
            for hour in values(f"{root}/part_day={day}", "part_hour")
        }

    def _part(self, hour: int, level: int) -> str:
        number, at = (shared_day(hour), SHARED_HOUR) if hour >= SHARED else (hour // 24, hour % 24)
        day = self.spark._jvm.java.time.LocalDate.ofEpochDay(number).toString()
        return f"part_day={day}/part_hour={at}/part_level={level}"

    def _forget(self, spec: TableSpec, parts: list[str]) -> None:
        """Take partitions out of the catalog; their files stay."""
        for at in range(0, len(parts), DROPPED_AT_ONCE):
            named = []
            for part in parts[at : at + DROPPED_AT_ONCE]:
                values = (p.split("=", 1) for p in part.split("/"))
                named.append("PARTITION (" + ", ".join(f"{n} = '{v}'" for n, v in values) + ")")
            self.spark.sql(f"ALTER TABLE {self._files(spec)} DROP IF EXISTS {', '.join(named)}")

    def _drop(self, spec: TableSpec, parts: list[str]) -> None:
        self._forget(spec, parts)
        for part in parts:
            delete_tree(self.spark, f"{self._location(spec)}/{part}")

    def _publish_staged(self, spec: TableSpec) -> None:
        """Finish a compaction whose merged partitions are complete but perhaps not published."""
        if path_exists(self.spark, f"{self._staging(spec)}/_SUCCESS"):
            self._publish(spec)


def _number(day: int, hour: int) -> int:
    return shared_number(day) if hour == SHARED_HOUR else day * 24 + hour


def _bucket() -> Column:
    return F.pmod(F.xxhash64("sensor_id"), F.lit(BUCKETS)).cast("int")


def stamped(rows: DataFrame, processed_at: datetime) -> DataFrame:
    return rows.withColumn("processed_at", F.lit(processed_at).cast("timestamp"))
