"""Tables kept in parts by a number such as the month, of which a refresh writes only those it touches.

A part is a folder of some run. A refresh reads the parts that new rows fall in, lets a
new row replace the one of its key, and writes these parts to a folder of its own. The
next version of the table takes these, and all other parts from where they are: their
files are neither read nor written. The version is complete before readers are switched
to it, so all parts change in one step, and a run that fails changes none.

The cost follows the touched parts; the list of parts grows by twelve a year, where
months are the parts. A part of any size is written in files of the size Spark aims at:
it is dealt by a rebalancing exchange, which splits what is large.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.operators.dedup import KEYS, keep_one
from marketbars.sinks import files
from marketbars.sinks.tables import counted, current_version, new_run, require_rows, switch, version_table

MONTH = "month"


def month_of(day: Column) -> Column:
    """A date's month as a number such as 202401."""
    return F.year(day) * 100 + F.month(day)


def month_number(day: date) -> int:
    return day.year * 100 + day.month


def months(rows: DataFrame, day: str = "date") -> list[int]:
    """The months of ``rows``: twelve numbers a year reach the driver."""
    found = rows.where(F.col(day).isNotNull()).select(month_of(F.col(day))).distinct().collect()
    return sorted(r[0] for r in found)


def in_parts(spark: SparkSession, table: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """The rows of the current version with their part; only folders of ``wanted`` parts are listed."""
    run, _ = current_version(spark, table)
    rows = spark.table(version_table(table, run))
    return rows if wanted is None else rows.where(F.col(rows.columns[-1]).isin(*wanted))


def replace_parts(rows: DataFrame, part: str, touched: Sequence[int], table: str, location: str,
                  first: int | None = None, allow_empty: bool = False) -> int:
    """Make ``rows``, which hold the number ``part``, the touched parts of ``table``.

    A touched part without rows leaves the table, and with ``first`` so do all parts
    before it, without being read. The number of rows written.
    """
    spark = rows.sparkSession
    held = current_version(spark, table)
    parts = {int(p): run for p, run in held[1].items()} if held else {}
    run = new_run()
    written, seen = counted(rows.hint("rebalance", part))
    written.write.mode("errorifexists").partitionBy(part).parquet(f"{location}/{run}")
    n = require_rows(seen, table, allow_empty)
    found = [int(f.partition("=")[2]) for f in files.folders(spark, f"{location}/{run}") if f.startswith(f"{part}=")]
    parts = {p: r for p, r in parts.items() if p not in touched} | dict.fromkeys(found, run)
    kept = {str(p): parts[p] for p in sorted(parts) if first is None or p >= first}
    schema = T.StructType([f for f in rows.schema if f.name != part])
    switch(spark, table, schema, location, run, T.StructField(part, T.IntegerType()), kept)
    return n


def refresh_touched(rows: DataFrame, table: str, location: str, day: str = "date",
                    keys: Sequence[str] = KEYS, first: int | None = None) -> list[int]:
    """Put ``rows`` into ``table``, kept by month; the months that were written.

    Of rows that share a key the first by all other columns counts, nulls last, and
    any of them counts before the row the table holds. Rows must have a date. Months
    before ``first`` leave the table. A table that is not yet kept by month is, from
    now on.
    """
    spark = rows.sparkSession
    held = current_version(spark, table)
    month = month_of(F.col(day))
    columns = rows.columns
    touched = [m for m in months(rows, day) if first is None or m >= first]
    before = None
    if not (held and held[1]) and spark.catalog.tableExists(table):
        before = spark.table(table).select(*columns).withColumn(MONTH, month)
        touched = sorted({*touched, *months(before, day)})
    elif held and (again := [m for m in touched if str(m) in held[1]]):
        before = in_parts(spark, table, again).select(*columns, MONTH)
    merged = rows.withColumn(MONTH, month).where(F.col(MONTH).isin(*touched)).withColumn("_held", F.lit(0))
    if before is not None:
        merged = merged.unionByName(before.withColumn("_held", F.lit(1)))
    others = [F.col(c).asc_nulls_last() for c in columns if c not in keys]
    merged = keep_one(merged, keys, ["_held", *others]).drop("_held")
    replace_parts(merged, MONTH, touched, table, location, first)
    return touched
