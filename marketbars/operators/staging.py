"""Staging projections over the raw and final tables.

The columns are SQL expressions, so that the DataFrame form and the stored
views are one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_KEY = {
    "symbol": "upper(symbol)",
    "date": "CAST(date AS DATE)",
}
_PK = {"pk_symbol_date": "concat(upper(symbol), '|', CAST(CAST(date AS DATE) AS STRING))"}


def _doubles(*names: str) -> dict[str, str]:
    return {n: f"CAST({n} AS DOUBLE)" for n in names}


HISTORY = {**_KEY, **_doubles("open", "high", "low", "close", "volume"), **_PK}
FORECAST = {**_KEY, **_doubles("forecast", "lower_bound", "upper_bound"), **_PK}

DATED = "date IS NOT NULL"


def _ahead(strict: bool) -> str:
    unpriced = f"{DATED} AND CAST(actual AS DOUBLE) IS NULL"
    return f"{unpriced} AND forecast IS NOT NULL" if strict else unpriced


def _columns(expressions: dict[str, str]) -> list[str]:
    return [f"{e} AS {n}" for n, e in expressions.items()]


def train_view(raw: DataFrame) -> DataFrame:
    """The three columns training reads; the scan reads no others."""
    return raw.select("date", "close", "symbol")


def history_rows(raw: DataFrame) -> DataFrame:
    """Typed, keyed history rows, duplicates included."""
    return raw.where(DATED).selectExpr(*_columns(HISTORY))


def stg_market_data(raw: DataFrame) -> DataFrame:
    """History staging: one row per distinct bar."""
    return history_rows(raw).distinct()


def forecast_rows(final: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of the final table that carry no actual price, duplicates included.

    A history row whose close is null qualifies too, with a null forecast;
    ``strict`` leaves such rows out.
    """
    return final.where(_ahead(strict)).selectExpr(*_columns(FORECAST))


def stg_market_forecast(final: DataFrame, strict: bool = False) -> DataFrame:
    """Forecast staging: one row per distinct forecast."""
    return forecast_rows(final, strict).distinct()


def view_queries(raw: str, final: str, strict: bool = False) -> tuple[str, str]:
    """The two staging queries over named tables, for stored views."""
    return (
        f"SELECT DISTINCT {', '.join(_columns(HISTORY))} FROM {raw} WHERE {DATED}",
        f"SELECT DISTINCT {', '.join(_columns(FORECAST))} FROM {final} WHERE {_ahead(strict)}",
    )
