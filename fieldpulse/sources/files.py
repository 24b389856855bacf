"""File system helpers through Hadoop, so they work on any storage Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _resolve(spark, path)
    return fs.exists(location)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, location = _resolve(spark, path)
    if not fs.exists(location):
        return []
    return [status.getPath().getName() for status in fs.listStatus(location)]


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, location = _resolve(spark, path)
    fs.delete(location, True)
