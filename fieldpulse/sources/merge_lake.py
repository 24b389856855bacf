"""The five tables in a catalog whose table format runs ``MERGE`` itself, such as Iceberg.

Spark's ``mergeInto`` does the upserts and the format commits each of them atomically.  Column
names, types and partitioning are those of existing deployments, so their tables can be kept.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse import model as m
from fieldpulse.functions.identity import event_id
from fieldpulse.model import TABLES
from fieldpulse.session import prepare_writes, work_folder
from fieldpulse.sources.files import delete_tree
from fieldpulse.sources.scope import RANGES, HourScope

# Partitioning of existing tables.
PARTITIONING = {
    m.SILVER: "days(event_time), site",
    m.SENSOR_MINUTE: "days(window_start), site",
    m.SITE_MINUTE: "days(window_start), site",
    m.SITE_ALERT_MINUTE: "days(window_start), site, alert_level",
    m.SENSOR_LATEST: "site",
}

#: Lengths of prefixes by which sensor names are gathered to ranges.
PREFIXES = (1, 2, 3, 4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64)


@dataclass(frozen=True)
class MergeLake:
    spark: SparkSession
    schema: str = "iceberg.reporting"
    provider: str = "iceberg"

    def on(self, spark: SparkSession) -> MergeLake:
        return replace(self, spark=spark)

    def definitions(self) -> list[str]:
        statements = [f"CREATE NAMESPACE IF NOT EXISTS {self.schema}"]
        for spec in TABLES.values():
            columns = ", ".join(f"{name} {kind}" for name, kind in spec.columns)
            statements.append(
                f"CREATE TABLE IF NOT EXISTS {self.view(spec.name)} ({columns}) "
                f"USING {self.provider} PARTITIONED BY ({PARTITIONING[spec.name]})"
            )
        return statements

    def create(self) -> MergeLake:
        for statement in self.definitions():
            self.spark.sql(statement)
        return self

    def view(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def scratch(self, name: str) -> str:
        return work_folder(self.spark, name)

    def read(self, table: str, scope: HourScope | None = None) -> DataFrame:
        return self.scan(table, scope)

    def scan(self, table: str, scope: HourScope | None = None) -> DataFrame:
        rows = self.spark.read.table(self.view(table))
        if scope is not None and TABLES[table].clock:
            rows = rows.where(scope.spans(F.col(TABLES[table].clock), RANGES))
        return rows

    def newest_hours(self, table: str) -> None:
        return None

    def append(self, table: str, rows: DataFrame, scope: HourScope | None = None) -> None:
        prepare_writes(rows.sparkSession)
        rows.select(*TABLES[table].column_names).writeTo(self.view(table)).append()

    def upsert(self, table: str, rows: DataFrame, scope: HourScope) -> None:
        prepare_writes(rows.sparkSession)
        spec = TABLES[table]
        matches = [F.col(f"{table}.{key}") == F.col(f"source.{key}") for key in spec.keys]
        matches.append(scope.spans(F.col(f"{table}.{spec.clock}"), RANGES))
        (
            rows.select(*spec.column_names)
            .alias("source")
            .mergeInto(self.view(table), reduce(and_, matches))
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )

    def advance(self, rows: DataFrame) -> None:
        """A status gives way to a newer event; an older event only renews the stamp.

        The rows are written out first, so that the merge does not compute them again for each of its
        passes.  Ranges of names that hold all sensors of the batch let the format skip files.
        """
        prepare_writes(rows.sparkSession)
        table = m.SENSOR_LATEST
        names = TABLES[table].column_names
        folder = self.scratch("status")
        try:
            rows.select(*names, "event_id").write.mode("overwrite").parquet(folder)
            self._merge_status(self.spark.read.parquet(folder), table, names)
        finally:
            delete_tree(self.spark, folder)

    def _merge_status(self, rows: DataFrame, table: str, names: list[str]) -> None:
        ranges = name_ranges(rows, "sensor_id")
        if not ranges:
            return
        new, old = (lambda c, side=side: F.col(f"{side}.{c}") for side in ("source", table))
        touched = reduce(or_, [old("sensor_id").between(first, last) for first, last in ranges])
        later = (new("event_time") > old("event_time")) | (
            (new("event_time") == old("event_time")) & (new("event_id") <= event_id(f"{table}."))
        )
        (
            rows.alias("source")
            .mergeInto(self.view(table), (old("sensor_id") == new("sensor_id")) & touched)
            .whenMatched(later)
            .update({c: new(c) for c in names})
            .whenMatched()
            .update({"processed_at": new("processed_at")})
            .whenNotMatched()
            .insert({c: new(c) for c in names})
            .merge()
        )

    def compact(self, until: datetime, *tables: str) -> None:
        """The table format's own maintenance does this."""

    def overwrite(self, table: str, rows: DataFrame, scope: HourScope | None = None) -> None:
        prepare_writes(rows.sparkSession)
        written = rows.select(*TABLES[table].column_names)
        written.writeTo(self.view(table)).overwrite(F.lit(True))


def name_ranges(rows: DataFrame, column: str) -> list[tuple[str, str]]:
    """About ``RANGES`` ranges at most that hold all names, without what lies between unlike prefixes.

    Names with the same prefix share a range; the prefix is as long as the number of ranges allows.
    """
    prefixes = {n: F.substring(column, 1, n) for n in PREFIXES}
    counts = rows.agg(*(F.approx_count_distinct(p).alias(str(n)) for n, p in prefixes.items())).first()
    longest = max((n for n in PREFIXES if counts[str(n)] <= RANGES), default=0)
    prefix = prefixes[longest] if longest else F.lit("")
    found = rows.groupBy(prefix).agg(F.min(column).alias("first"), F.max(column).alias("last")).collect()
    return sorted((r["first"], r["last"]) for r in found)
