"""The symbols a run is limited to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.functions import tidy_symbol
from marketbars.settings import parse_symbols


def universe(lists: DataFrame, column: str = "symbols") -> DataFrame:
    """Distinct symbols named by comma lists held in a text column."""
    names = F.transform(F.split(column, ","), tidy_symbol)
    return (
        lists.select(F.explode(F.filter(names, lambda s: s != "")).alias("symbol"))
        .distinct()
    )


def in_universe(bars: DataFrame, symbols: str | Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the named symbols only.

    A list from the settings becomes a literal filter that reaches the scan; a
    DataFrame (a universe kept as a table) becomes a semi join whose strategy
    Spark picks by measured size. ``bars.symbol`` must be tidy already.
    """
    if isinstance(symbols, DataFrame):
        return bars.join(symbols, "symbol", "left_semi")
    return bars.where(F.col("symbol").isin(*_names(symbols)))


def missing_symbols(
    spark: SparkSession, bars: DataFrame, symbols: str | Sequence[str] | DataFrame
) -> DataFrame:
    """Symbols of the universe that have no row in ``bars``.

    ``bars`` is first cut to the universe and reduced to distinct symbols, so
    both join sides hold at most one row per symbol of the universe.
    """
    wanted = symbols
    if not isinstance(symbols, DataFrame):
        names = F.array(*map(F.lit, _names(symbols)))
        wanted = spark.range(1).select(F.explode(names).alias("symbol"))
    found = in_universe(bars.select("symbol"), symbols).distinct()
    return wanted.join(found, "symbol", "left_anti")


def _names(symbols: str | Sequence[str]) -> Sequence[str]:
    return parse_symbols(symbols if isinstance(symbols, str) else ",".join(symbols))
