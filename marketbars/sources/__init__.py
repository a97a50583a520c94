"""Reading bars and shaping them into one long table."""

from marketbars.sources.bars import (
    daily_bars,
    flatten_symbol,
    lookback,
    read_bars,
    wide_to_long,
)
from marketbars.sources.delivered import index_files, read_named, write_delivery
from marketbars.sources.universe import in_universe, missing_symbols, universe

__all__ = [
    "daily_bars",
    "flatten_symbol",
    "in_universe",
    "index_files",
    "lookback",
    "missing_symbols",
    "read_bars",
    "read_named",
    "universe",
    "wide_to_long",
    "write_delivery",
]
