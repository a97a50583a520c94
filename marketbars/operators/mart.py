"""History and forecasts in one table, history winning every shared key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketbars.functions import null_double, strip_quotes, symbol_key

# Tags of the two kinds of mart rows.
HISTORICAL = "historical"
FORECAST = "forecast"

BAND = ("forecast", "lower_bound", "upper_bound")


def clean_series(predictions: DataFrame) -> DataFrame:
    """Predictions keyed like history: quotes off the series name, day of ``ts``."""
    return predictions.select(
        strip_quotes(F.col("series")).alias("symbol"),
        F.col("ts").cast("date").alias("date"),
        *BAND,
    )


def final_union(raw: DataFrame, predictions: DataFrame) -> DataFrame:
    """History with its actual price, then predictions with their band."""
    history = raw.select(
        "symbol",
        F.col("date").cast("date").alias("date"),
        F.col("close").cast("double").alias("actual"),
        *[null_double().alias(c) for c in BAND],
    )
    ahead = clean_series(predictions).withColumn("actual", null_double())
    return history.unionByName(ahead)


def mart_stock_analysis(history: DataFrame, forecasts: DataFrame, ranges: bool = False) -> DataFrame:
    """One tagged row per (symbol, date) from staged history and forecasts.

    Either side may hold exact repeats; the choice of one row per key absorbs
    them, so the plan has one shuffle, trimmed to one row per key and map task.
    With ``ranges`` that shuffle deals ranges of the key, and is not trimmed.
    """
    key = symbol_key(F.col("symbol"), F.col("date")).alias("pk_symbol_date")
    past = history.select(
        "symbol",
        "date",
        F.col("close").alias("actual_price"),
        null_double().alias("forecast_price"),
        null_double().alias("lower_bound"),
        null_double().alias("upper_bound"),
        F.lit(HISTORICAL).alias("record_type"),
        key,
    )
    ahead = forecasts.select(
        "symbol",
        "date",
        null_double().alias("actual_price"),
        F.col("forecast").alias("forecast_price"),
        "lower_bound",
        "upper_bound",
        F.lit(FORECAST).alias("record_type"),
        key,
    )
    history_first = F.when(F.col("record_type") == HISTORICAL, 1).otherwise(2)
    ties = ("actual_price", "forecast_price", "lower_bound", "upper_bound")
    best = W.partitionBy("symbol", "date").orderBy(
        history_first, *[F.col(c).asc_nulls_last() for c in ties]
    )
    rows = past.unionByName(ahead)
    rows = rows.repartitionByRange("symbol", "date") if ranges else rows
    return rows.withColumn("rn", F.row_number().over(best)).where("rn = 1")


def trend_read(mart: DataFrame) -> DataFrame:
    """The dashboard read: price, forecast and band by symbol and day."""
    return mart.select(
        "symbol",
        "date",
        "record_type",
        "actual_price",
        "forecast_price",
        "lower_bound",
        "upper_bound",
    ).orderBy("symbol", "date")
