"""One row per key, and reports on keys that have more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketbars.functions import duplicate_line

KEYS = ("symbol", "date")


def keep_one(
    df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """The first row of each key under a total order.

    Without ``order`` every other column orders the rows, nulls last, so the
    survivor does not depend on how rows arrive. Spark trims each map task to
    one row per key before the shuffle, so a hot key moves one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    if order is None:
        if not others:
            return df.distinct()
        order = [F.col(c).asc_nulls_last() for c in others]
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1")


def duplicate_key_count(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("dupes"))


def duplicate_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` worst duplicate (symbol, date) keys with a line of text each."""
    return (
        duplicate_keys(df)
        .orderBy(F.desc("c"), F.col("symbol").asc_nulls_last(), F.col("date").asc_nulls_last())
        .limit(n)
        .withColumn("line", duplicate_line(F.col("symbol"), F.col("date"), F.col("c")))
    )


def row_stats(df: DataFrame) -> DataFrame:
    """Total rows and distinct complete (symbol, date) keys, in one pass."""
    per_key = df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("c"))
    complete = F.col("symbol").isNotNull() & F.col("date").isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("total_rows"),
        F.count_if(complete).alias("distinct_pairs"),
    )
