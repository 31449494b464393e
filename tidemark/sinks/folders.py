"""Folders of the stored tables, through the file system that Spark itself uses for the path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def found(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, which may have wildcards, leads to anything."""
    system, place = _at(spark, pattern)
    return len(system.globStatus(place) or []) > 0


def remove(spark: SparkSession, path: str) -> None:
    """A folder and what is in it; one that is gone already is fine."""
    system, place = _at(spark, path)
    system.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if the path is not there."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())
