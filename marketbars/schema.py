"""Table schemas and the column contract for incoming bars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names, order and types of the published tables.
BARS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# Bars as delivered in text files: numbers stay text until they are coerced.
BARS_TEXT = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Open", T.StringType()),
    T.StructField("High", T.StringType()),
    T.StructField("Low", T.StringType()),
    T.StructField("Close", T.StringType()),
    T.StructField("Volume", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("lower_bound", T.DoubleType()),
    T.StructField("upper_bound", T.DoubleType()),
])

FINAL = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("actual", T.DoubleType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("lower_bound", T.DoubleType()),
    T.StructField("upper_bound", T.DoubleType()),
])

# Fields every incoming bar must carry.
REQUIRED_FIELDS = ("Date", "Open", "High", "Low", "Close", "Volume")


class SchemaContractError(ValueError):
    """Incoming data lacks columns the bars contract names."""


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_FIELDS) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every missing column.

    Works on the analysed schema only, so it costs no job. Names are compared
    without regard to case, as Spark resolves them.
    """
    present = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in present]
    if missing:
        raise SchemaContractError(f"missing columns {missing}; got {df.columns}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the columns of ``schema``, in its order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
