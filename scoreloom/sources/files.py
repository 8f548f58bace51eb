"""Folders of the file systems that Spark knows."""

from __future__ import annotations

from pyspark.sql import SparkSession

SUCCESS = "_SUCCESS"  # a writer's last act


def _at(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it does not exist."""
    files, place = _at(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all it holds; whether there was one."""
    files, place = _at(spark, path)
    return files.delete(place, True)


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder has come to its end."""
    return SUCCESS in children(spark, folder)
