"""Run settings, passed explicitly to every plan."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import date


def parse_symbols(text: str) -> tuple[str, ...]:
    """Comma list to upper-case symbols: blanks dropped, order kept, no repeats."""
    symbols = dict.fromkeys(s.strip().upper() for s in text.split(",") if s.strip())
    if not symbols:
        raise ValueError(f"symbol list {text!r} names no symbol")
    return tuple(symbols)


@dataclass(frozen=True)
class Settings:
    """What one daily run works on.

    ``database`` prefixes the layer schemas (``market_raw``, ``market_adhoc``
    and so on); the environment variable ``MARKETBARS_DATABASE`` overrides it.
    ``base_path`` is the shared folder that holds the table files. ``as_of``
    ends the look-back; without it each symbol's own last date does. Without
    ``train_days`` there is no look-back. ``refresh`` says whether a delivery
    replaces the raw table (``full``) or only the rows of its keys (``touched``);
    then the trend is refitted from statistics of blocks of ``block_days``.
    ``buckets`` deal the stored snapshot: about its bytes over 256 MB, and fixed
    when it is first written.
    """

    base_path: str
    catalog: str = "spark_catalog"
    database: str = field(default_factory=lambda: os.environ.get("MARKETBARS_DATABASE", "market"))
    symbols: tuple[str, ...] | None = ("AAPL", "NVDA")
    train_days: int | None = 180
    as_of: date | None = None
    horizon: int = 7
    level: float = 0.95
    method: str = "trend"
    calendar: str = "daily"
    min_obs: int | None = None
    strict_forecast: bool = False
    refresh: str = "full"
    buckets: int = 8
    block_days: int = 30

    def schema(self, layer: str) -> str:
        return f"{self.database}_{layer}"

    def table(self, layer: str, name: str) -> str:
        """Quoted three-part name."""
        return quoted(self.catalog, self.schema(layer), name)

    def location(self, layer: str, name: str) -> str:
        return f"{self.base_path.rstrip('/')}/{self.schema(layer)}/{name}"

    # Declared sources and published tables.
    @property
    def raw(self) -> str:
        return self.table("raw", "market_data")

    @property
    def stage(self) -> str:
        return self.table("raw", "market_data_stage")

    @property
    def train_view(self) -> str:
        return self.table("adhoc", "market_data_view")

    @property
    def forecast(self) -> str:
        return self.table("adhoc", "market_data_forecast")

    @property
    def ingest_counts(self) -> str:
        return self.table("adhoc", "ingest_counts")

    @property
    def stg_history(self) -> str:
        return self.table("staging", "stg_market_data")

    @property
    def stg_forecast(self) -> str:
        return self.table("staging", "stg_market_forecast")

    @property
    def metrics(self) -> str:
        return self.table("analytics", "price_model_metrics")

    @property
    def model(self) -> str:
        return self.table("analytics", "price_model")

    @property
    def blocks(self) -> str:
        return self.table("analytics", "price_blocks")

    @property
    def final(self) -> str:
        return self.table("analytics", "market_data")

    @property
    def mart(self) -> str:
        return self.table("analytics", "mart_stock_analysis")

    @property
    def snapshot(self) -> str:
        return self.table("snapshots", "market_data_snapshot")

    @property
    def snapshot_files(self) -> str:
        return self.table("snapshots", "market_data_snapshot_files")


def quoted(*parts: str) -> str:
    """Backticked multi-part name."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)
