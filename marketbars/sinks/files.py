"""Folders of the shared storage, through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _found(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none if it does not exist."""
    system, at = _found(spark, path)
    if not system.exists(at):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(at) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; one that does not exist is fine."""
    system, at = _found(spark, path)
    system.delete(at, True)
