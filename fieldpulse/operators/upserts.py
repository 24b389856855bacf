"""Set maintenance by key, as plain joins.  Key columns must not be null."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.operators.sizing import BROADCAST_BYTES, is_small


#: Rows of one key from which on the key is not shuffled.
HOT_ROWS = 100_000


def absent_rows(
    source: DataFrame,
    target: DataFrame,
    key: str,
    source_key_bytes: int | None = None,
    target_unique: bool = True,
    limit: int = BROADCAST_BYTES,
    source_unique: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Source rows whose key is not in the target.

    ``source_key_bytes`` is an upper bound on the size of the source keys.  If they are few, the
    target is filtered in place by a broadcast semi join and only the hits are joined back.
    Otherwise both sides are shuffled on the key; a target that repeats keys is reduced before.

    A source that repeats keys is counted per key first, and the keys are looked up once each.  Keys
    with more than ``hot_rows`` rows, of which there are few by their number alone, are settled by a
    broadcast, so their rows stay where they are.
    """
    present = target.select(key)
    if is_small(source_key_bytes, limit):
        wanted = F.broadcast(source.select(key).distinct())
        present = present.join(wanted, key, "left_semi").distinct()
        return source.join(present, key, "left_anti")
    if not target_unique:
        present = present.distinct()
    if source_unique or not is_small(_over(source_key_bytes, hot_rows)):
        return source.join(present, key, "left_anti")
    counts = source.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    known = counts.join(present.withColumn("_known", F.lit(True)), key, "left")
    hot = known.where(F.col("_rows") > hot_rows).select(
        F.col(key).alias("_hot"), F.coalesce("_known", F.lit(False)).alias("_known")
    )
    marked = source.join(F.broadcast(hot), source[key] == F.col("_hot"), "left")
    seldom = marked.where(F.col("_hot").isNull()).select(*source.columns)
    fresh = seldom.join(known.where("_known").select(key), key, "left_anti")
    return fresh.unionByName(marked.where(~F.col("_known")).select(*source.columns))


def _over(size: int | None, parts: int) -> int | None:
    return None if size is None else size // max(1, parts)


def first_batch_rows(rows: DataFrame, key: str, batch: str) -> DataFrame:
    """What insert-only merges of batches one after the other leave: the first batch's rows of a key.

    A batch's own repeats stay.  Spark drops later batches' rows before the shuffle and after it.
    """
    place = F.rank().over(Window.partitionBy(key).orderBy(batch))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")
