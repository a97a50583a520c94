"""Catalog tables on plain parquet files.

A published name is a view over one version: a typed table of its own over a run
folder that is written once. Replacing the rows, with the same columns or others,
writes a new folder, declares a new version over it and then replaces the view, in
one step. Readers see the old rows or the new ones, never none; no folder that a
plan may be reading is ever overwritten, and a lost executor only repeats its tasks.
A version can hold partitions of earlier run folders (see ``monthly``).

``retain`` removes versions that no reader needs any more, and the folders that no
version left names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.operators.staging import view_queries
from marketbars.schema import BARS, conform
from marketbars.settings import Settings, quoted
from marketbars.sinks import files

VERSION = "marketbars.version"
PARTITIONS = "marketbars.partitions"
LAYERS = ("raw", "adhoc", "analytics", "staging", "snapshots")


class EmptyWriteError(RuntimeError):
    """A write that must hold rows held none."""


def ensure_tables(spark: SparkSession, cfg: Settings) -> None:
    """Create the layer schemas and the typed raw and stage tables, if absent."""
    for layer in LAYERS:
        path = f"{cfg.base_path.rstrip('/')}/{cfg.schema(layer)}"
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(cfg.catalog, cfg.schema(layer))} LOCATION '{path}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {cfg.stage} ({ddl(BARS)}) USING parquet")
    if not spark.catalog.tableExists(cfg.raw):
        switch(spark, cfg.raw, BARS, cfg.location("raw", "market_data"), new_run())


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def new_run() -> str:
    """A folder name no earlier run has used; names sort by time."""
    now = datetime.now(timezone.utc).strftime("%Y%m%dt%H%M%S%f")
    return f"run_{now}_{uuid.uuid4().hex[:8]}"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted by the write itself, not by a second job."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def require_rows(seen: Observation, target: str, allow_empty: bool = False) -> int:
    """The rows a counted write saw; none is an error unless allowed."""
    rows = seen.get["rows"]
    if rows == 0 and not allow_empty:
        raise EmptyWriteError(f"nothing to write to {target}")
    return rows


def empty_table(spark: SparkSession, table: str) -> None:
    """Remove all rows of a managed table; a table that is absent is fine."""
    if spark.catalog.tableExists(table):
        spark.sql(f"TRUNCATE TABLE {table}")


def append(df: DataFrame, table: str, allow_empty: bool = False) -> int:
    """Append by column name and type; the number of rows written."""
    target = df.sparkSession.table(table).schema
    rows, seen = counted(conform(df, target))
    rows.write.mode("append").insertInto(table)
    return require_rows(seen, table, allow_empty)


def insert_select(spark: SparkSession, table: str, columns: Sequence[str], query: str) -> None:
    """``INSERT INTO table (columns) query``; columns left out become null."""
    names = ", ".join(map(quoted, columns))
    spark.sql(f"INSERT INTO {table} ({names}) {query}")


def publish(
    df: DataFrame,
    table: str,
    location: str,
    allow_empty: bool = False,
    range_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> int:
    """Create the table, or replace its rows, with ``df``.

    The rows are written and counted before readers are switched over. With
    ``range_by`` the files are ranges of those columns, split evenly by sampled
    size, so reads by symbol or date skip most of them; ``sort_by`` only sorts each
    file, of rows that are dealt in ranges already. With ``bucket_by`` the files are dealt into ``buckets`` by the hash of those
    columns, and later aggregates and joins on them need no exchange; give rows that
    a shuffle on these columns has dealt already, or every task writes every bucket.
    """
    spark, run = df.sparkSession, new_run()
    if range_by:
        df = df.repartitionByRange(*range_by)
    if range_by or sort_by:
        df = df.sortWithinPartitions(*(range_by or sort_by))
    rows, seen = counted(df)
    if bucket_by:
        version = version_table(table, run)
        written = rows.write.format("parquet").mode("errorifexists").bucketBy(buckets, *bucket_by)
        written.option("path", f"{location}/{run}").saveAsTable(version)
    else:
        rows.write.mode("errorifexists").parquet(f"{location}/{run}")
    try:
        n = require_rows(seen, table, allow_empty)
    except EmptyWriteError:
        if bucket_by:
            spark.sql(f"DROP TABLE {version}")
        raise
    if not bucket_by:
        _declare(spark, table, df.schema, location, run)
    _point(spark, table, df.schema, run)
    return n


def version_table(table: str, run: str) -> str:
    """Quoted name of the version of ``table`` that ``run`` made."""
    return f"{table[:-1]}__{run}`"


def switch(spark: SparkSession, table: str, schema: T.StructType, location: str, run: str,
           partition: T.StructField | None = None, parts: Mapping[str, str] | None = None) -> None:
    """Make ``table`` read the folder of ``run``, in one step for its readers.

    With ``partition`` the version's partitions are ``parts``: the value of each, and
    the run whose folder holds it.
    """
    _declare(spark, table, schema, location, run, partition, parts)
    _point(spark, table, schema, run, parts)


def _declare(spark: SparkSession, table: str, schema: T.StructType, location: str, run: str,
             partition: T.StructField | None = None, parts: Mapping[str, str] | None = None) -> None:
    """A typed table over the folder of ``run``, or over the folders of ``parts``."""
    version, columns = version_table(table, run), ddl(schema)
    if partition is None:
        spark.sql(f"CREATE TABLE {version} ({columns}) USING parquet LOCATION '{location}/{run}'")
        return
    name, held = quoted(partition.name), json.dumps(dict(parts or {}))
    columns += f", {name} {partition.dataType.simpleString()}"
    spark.sql(f"CREATE TABLE {version} ({columns}) USING parquet PARTITIONED BY ({name}) "
              f"LOCATION '{location}/{run}' TBLPROPERTIES ('{PARTITIONS}' = '{held}')")
    listed = " ".join(f"PARTITION ({name} = {value}) LOCATION '{location}/{of}/{partition.name}={value}'"
                      for value, of in (parts or {}).items())
    if listed:
        spark.sql(f"ALTER TABLE {version} ADD {listed}")


def _point(spark: SparkSession, table: str, schema: T.StructType, run: str,
           parts: Mapping[str, str] | None = None) -> None:
    """Replace the view ``table`` by one over the version of ``run``."""
    kind = spark.catalog.getTable(table).tableType if spark.catalog.tableExists(table) else "VIEW"
    if kind == "MANAGED":
        raise ValueError(f"{table} is a managed table, whose files would go with it")
    if kind != "VIEW":
        spark.sql(f"DROP TABLE {table}")  # once, of a table that was published before there were versions
    names, held = ", ".join(quoted(f.name) for f in schema), json.dumps(dict(parts or {}))
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{VERSION}' = '{run}', '{PARTITIONS}' = '{held}') "
              f"AS SELECT {names} FROM {version_table(table, run)}")


def current_version(spark: SparkSession, table: str) -> tuple[str, dict[str, str]] | None:
    """The run that made the rows ``table`` shows, and the run of each of its partitions."""
    if not spark.catalog.tableExists(table):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if VERSION not in found:
        return None
    return found[VERSION], json.loads(found[PARTITIONS])


def retain(spark: SparkSession, table: str, location: str, keep: int = 1) -> list[str]:
    """Remove all but the current version and the ``keep`` ones before it; the run folders that went.

    Plans that still read an older version fail, so keep as many as runs may overlap
    with their readers. Versions and folders newer than the current version are left
    alone: a run may be writing them.
    """
    current = current_version(spark, table)
    if current is None:
        return []
    schema, _, name = table.rpartition(".")
    prefix = f"{name.strip('`')}__"
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema} LIKE '{prefix}run_*'").collect()]
    runs = sorted(n.removeprefix(prefix) for n in found if n.startswith(prefix))
    if current[0] not in runs:
        raise RuntimeError(f"the catalog does not list version {current[0]} of {table}")
    older = [r for r in runs if r < current[0]]
    gone = older[:max(len(older) - keep, 0)]
    for run in gone:
        spark.sql(f"DROP TABLE IF EXISTS {version_table(table, run)}")
    named = set(runs) - set(gone)
    for run in list(named):
        named |= _folders_of(spark, version_table(table, run))
    out = [f for f in files.folders(spark, location) if f.startswith("run_") and f < current[0] and f not in named]
    for folder in out:
        files.remove(spark, f"{location}/{folder}")
    return out


def _folders_of(spark: SparkSession, version: str) -> set[str]:
    """The run folders that hold a version's partitions."""
    held = spark.sql(f"SHOW TBLPROPERTIES {version}").collect()
    found = {r["key"]: r["value"] for r in held}
    return set(json.loads(found.get(PARTITIONS, "{}")).values())


def create_view(spark: SparkSession, view: str, query: str) -> DataFrame:
    """Create or replace a stored view; it reads its tables anew at each use."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return spark.table(view)


def create_train_view(spark: SparkSession, cfg: Settings) -> DataFrame:
    """The stored view over raw that training reads."""
    return create_view(spark, cfg.train_view, f"SELECT symbol, date, close FROM {cfg.raw}")


def create_staging_views(spark: SparkSession, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """The stored staging views of history and of forecasts."""
    history, ahead = view_queries(cfg.raw, cfg.final, cfg.strict_forecast)
    return (
        create_view(spark, cfg.stg_history, history),
        create_view(spark, cfg.stg_forecast, ahead),
    )
