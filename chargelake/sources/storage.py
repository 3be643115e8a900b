"""Paths in whatever store the tables are in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    store, place = _at(spark, path)
    store.delete(place, True)


def drop_at_exit(spark: SparkSession, folder: str) -> None:
    """Make a folder that is deleted, with all in it, when the application ends."""
    store, place = _at(spark, folder)
    store.mkdirs(place)
    store.deleteOnExit(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What is in a folder; nothing if it is not there."""
    store, place = _at(spark, folder)
    if not store.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in store.listStatus(place))
