"""The trend model from sufficient statistics kept in blocks of days.

A block holds, per series, the number of observations, their mean, and the centred
sums of squares and products with their index within the block. Blocks are merged by
the exact two-level formula: within-block sums plus those of the block means. Nothing
is ever subtracted from a merged sum, so no digits cancel: a block that leaves the
look-back is left out whole, one that gets new bars is computed anew.

A day's refit reads the bars of the touched blocks and one row per series and block,
instead of all bars. Blocks of one series are dealt apart, so a series that holds a
third of all bars is no hot key here.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketbars.functions import nan_to_null
from marketbars.operators.forecast import TOO_FEW, method_of

BLOCK_DAYS = 30
BLOCK = "block"
_EPOCH = date(1970, 1, 1)


def block_of(day: Column, block_days: int = BLOCK_DAYS) -> Column:
    """The number of a date's block."""
    return F.floor(F.datediff(day, F.lit(_EPOCH)) / block_days).cast("int")


def block_number(day: date, block_days: int = BLOCK_DAYS) -> int:
    return (day - _EPOCH).days // block_days


def block_span(block: int, block_days: int = BLOCK_DAYS) -> tuple[date, date]:
    """First and last day of a block."""
    first = _EPOCH.toordinal() + block * block_days
    return date.fromordinal(first), date.fromordinal(first + block_days - 1)


def block_stats(bars: DataFrame, block_days: int = BLOCK_DAYS, series: str = "symbol",
                ts: str = "date", target: str = "close") -> DataFrame:
    """One row per series and block, from one row per series and day.

    Null and NaN targets are no observations, but their day counts as the last one.
    One shuffle, by series and block.
    """
    rows = bars.where(F.col(ts).isNotNull()).select(
        F.col(series).alias("series"), F.col(ts).cast("date").alias("ts"),
        nan_to_null(F.col(target).cast("double")).alias("y"))
    rows = rows.withColumn(BLOCK, block_of(F.col("ts"), block_days))
    in_order = W.partitionBy("series", BLOCK).orderBy(F.col("y").isNull(), "ts")
    rows = rows.withColumn("x", F.row_number().over(in_order).cast("double"))
    return rows.groupBy("series", BLOCK).agg(
        F.count("y").alias("n"),
        F.avg("y").alias("y_mean"),
        F.regr_sxy("y", "x").alias("sxy"),
        F.regr_syy("y", "x").alias("syy"),
        F.max("ts").alias("last_ts"),
    ).select("series", "n", "y_mean", "sxy", "syy", "last_ts", BLOCK)


def merge_blocks(blocks: DataFrame, min_obs: int | None = None) -> DataFrame:
    """The trend model of each series from all its blocks, as ``fit`` gives it.

    Observations are indexed 1 to n through all blocks. One shuffle of one row per
    series and block.
    """
    each = W.partitionBy("series")
    n, total = F.col("n"), F.col("n_obs")
    rows = blocks.select(
        "series", "n", "last_ts", BLOCK,
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("y_mean", "sxy", "syy")],
        F.coalesce(F.sum("n").over(each.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        .alias("before"),
        F.sum("n").over(each).alias("n_obs"))
    rows = rows.withColumn("mean", F.sum(n * F.col("y_mean")).over(each) / F.nullif(total, F.lit(0)))
    x_off = F.col("before") + (n + 1) / 2 - (total + 1) / 2
    y_off = F.when(n > 0, F.col("y_mean") - F.col("mean")).otherwise(0.0)
    merged = rows.groupBy("series").agg(
        F.max("n_obs").alias("n_obs"),
        F.max("last_ts").alias("last_ts"),
        F.max("mean").alias("y_mean"),
        F.sum(F.col("sxy") + n * x_off * y_off).alias("sxy"),
        F.sum(F.col("syy") + n * y_off * y_off).alias("syy"),
    )
    # The index runs from 1 to n without gaps, so its own moments are closed forms.
    sxx = total * (total * total - 1) / F.lit(12.0)
    merged = (
        merged.withColumn("x_mean", F.when(total > 0, (total + 1) / 2))
        .withColumn("sxx", F.when(total > 0, sxx))
        .withColumn("slope", F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0)))
        .withColumn("intercept", F.col("y_mean") - F.col("slope") * F.col("x_mean"))
    )
    spec = method_of("trend")
    for name, value in spec.parameters:
        merged = merged.withColumn(name, value)
    needed = max(spec.min_obs, min_obs or 0)
    return merged.select(
        "series", "n_obs", "last_ts", "slope", "intercept", "x_mean", "sxx", "sxy", "syy", "sigma",
        F.when(total < needed, TOO_FEW).alias("reason"), F.lit("trend").alias("method"))
