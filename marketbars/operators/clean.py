"""From incoming bars to typed, keyed bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.functions import coerce_day, coerce_number, coerce_volume, tidy_symbol
from marketbars.schema import BARS, REQUIRED_FIELDS, require_columns

BAR_COLUMNS = tuple(BARS.names)


def _day(incoming: DataFrame) -> Column:
    text = isinstance(_types(incoming)["date"], T.StringType)
    return coerce_day(F.col("date"), text).alias("date")


def _types(incoming: DataFrame) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in incoming.schema}


def typed_bars(incoming: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Check the contract, then rename, coerce and project every row.

    Columns that arrive typed are cast directly; only text is parsed.
    """
    require_columns(incoming, ("symbol", *REQUIRED_FIELDS))
    types = _types(incoming)

    def number(name: str) -> Column:
        text = not isinstance(types[name], T.NumericType)
        value = F.col(name).cast("string") if text else F.col(name)
        if name != "volume":
            return coerce_number(value, text).alias(name)
        if isinstance(types[name], T.IntegralType):
            return value.cast("bigint").alias(name)
        return coerce_volume(value, text).alias(name)

    return incoming.select(
        tidy_symbol(F.col("symbol")).alias("symbol"),
        _day(incoming),
        *[number(c) for c in BAR_COLUMNS[2:]],
        *keep,
    )


def normalize(incoming: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed bars with a date. Narrow: no shuffle between scan and result.

    ``keep`` names extra columns to carry along, such as an arrival order for
    the later choice among duplicates.
    """
    return typed_bars(incoming, keep).dropna(subset=["date"])


def clean_counts(incoming: DataFrame) -> DataFrame:
    """Rows per symbol before cleaning, and after it (one per dated key)."""
    return counts_of(incoming.select(tidy_symbol(F.col("symbol")).alias("symbol"), _day(incoming)))


def counts_of(typed: DataFrame) -> DataFrame:
    """``clean_counts`` of typed bars.

    Counts per (symbol, date) first: the shuffle carries one row per key and
    task, and no task holds a whole symbol.
    """
    per_key = typed.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("symbol").agg(
        F.sum("n").alias("rows_before"), F.count("date").alias("rows_after")
    )
