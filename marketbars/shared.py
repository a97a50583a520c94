"""Shared-storage helpers that follow the session's own settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from marketbars.sinks import files


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, where driver and
    executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="marketbars-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/marketbars/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result that several later steps read: they scan the columns they
    need instead of computing it again, and a lost executor costs no
    recomputation.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stored(df: DataFrame) -> None:
    """Removes the files of a table as ``stored`` returned it, once no later step reads it."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        files.remove(df.sparkSession, folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles goes from the disk when the query ends, not when the driver next collects garbage.

    For operators that store one large result after the other.
    """
    with session_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the length of a ``with`` block; then it is as before."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def scratch(df: DataFrame, name: str = "table") -> Iterator[DataFrame]:
    """``df`` as ``stored`` gives it, for the length of a ``with`` block; then its files go."""
    path = run_dir(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        files.remove(df.sparkSession, path)
