"""The daily run, in data order: ingest, forecast, publish.

Stages hand over through published tables, so each starts from stored files
and a failed stage can be run again alone, for the same moment.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators.blocks import BLOCK, block_number, block_of, block_span, block_stats, merge_blocks
from marketbars.operators.clean import counts_of, typed_bars
from marketbars.operators.dedup import KEYS, keep_one, row_stats
from marketbars.operators.forecast import fits, model_of, predict, scores
from marketbars.operators.mart import final_union, mart_stock_analysis
from marketbars.operators.quality import (
    MODEL_CHECKS,
    distinct_report,
    raise_on_duplicates,
    raise_on_failure,
    report,
)
from marketbars.operators.staging import forecast_rows, history_rows
from marketbars.settings import Settings
from marketbars.shared import scratch
from marketbars.sinks.history import remove_dead, source_parts, update_snapshot
from marketbars.sinks.parts import in_parts, month_number, refresh_touched, replace_parts
from marketbars.sinks.tables import (
    append,
    create_staging_views,
    create_train_view,
    current_version,
    empty_table,
    ensure_tables,
    publish,
    retain,
)
from marketbars.sources import in_universe, lookback, missing_symbols, read_bars, read_named

log = logging.getLogger(__name__)


def read_delivery(spark: SparkSession, path: str, cfg: Settings, file_format: str = "parquet") -> DataFrame:
    """A delivery folder as ``run_ingest`` takes it.

    Where the settings name symbols, files that hold none of them are not opened (see
    ``sources.delivered``); counts per symbol then cover the named symbols only.
    """
    if cfg.symbols is None:
        return read_bars(spark, path, file_format)
    return read_named(spark, path, cfg.symbols, file_format)


def run_ingest(spark: SparkSession, incoming: DataFrame, cfg: Settings) -> dict[str, int]:
    """Incoming bars to the stage, then the raw table refreshed from it.

    The delivery is scanned once: its typed rows are kept for the length of the run,
    and the look-back, the stage and the counts per symbol before and after cleaning
    read the columns they need from there. Duplicates are settled once, at the refresh.
    With ``refresh="touched"`` raw is kept by month, and only the months that the stage
    touches are read and written.
    """
    ensure_tables(spark, cfg)
    empty_table(spark, cfg.stage)
    with scratch(typed_bars(incoming), "typed") as typed:
        bars = typed.dropna(subset=["date"])
        if cfg.symbols is not None:
            bars = in_universe(bars, cfg.symbols)
        staged = append(lookback(bars, cfg.train_days, cfg.as_of), cfg.stage)
        counts = counts_of(typed.select("symbol", "date"))
        publish(counts, cfg.ingest_counts, cfg.location("adhoc", "ingest_counts"))
    stage = spark.table(cfg.stage)
    if cfg.symbols is not None:
        # At most one row per configured symbol.
        absent = [r["symbol"] for r in missing_symbols(spark, stage, cfg.symbols).collect()]
        if absent:
            raise RuntimeError(f"no data for {sorted(absent)}")
    place = cfg.location("raw", "market_data")
    if cfg.refresh == "touched":
        months = refresh_touched(stage, cfg.raw, place, first=_first(cfg, month_number))
        written = in_parts(spark, cfg.raw, months)
    else:
        # Dealt by key, as the choice of one row per key has left it.
        publish(keep_one(stage), cfg.raw, place, bucket_by=KEYS, buckets=cfg.buckets)
        written = spark.table(cfg.raw)
    stats = {"staged_rows": staged, **row_stats(written).first().asDict()}
    if stats["total_rows"] != stats["distinct_pairs"]:
        raise_on_duplicates(written)
    if cfg.refresh == "touched" and cfg.method == "trend":
        refresh_blocks(spark, cfg, stage)
    log.info("ingested %s", stats)
    return stats


def _first(cfg: Settings, number: Callable[[date], int]) -> int | None:
    """The number of the first part that the look-back reaches; none if it has no fixed end."""
    if cfg.as_of is None or cfg.train_days is None:
        return None
    return number(cfg.as_of - timedelta(days=cfg.train_days - 1))


def refresh_blocks(spark: SparkSession, cfg: Settings, rows: DataFrame) -> list[int]:
    """Compute the statistics of the blocks that ``rows`` touch anew from raw; their numbers.

    Reads the months of those blocks and no others. Blocks before the look-back leave
    the table whole.
    """
    days = cfg.block_days
    first = _first(cfg, lambda d: block_number(d, days))
    block = block_of(F.col("date"), days)
    # At most one number per block of days that the rows span.
    touched = sorted(r[0] for r in rows.select(block).distinct().collect())
    touched = [b for b in touched if first is None or b >= first]
    spans = [block_span(b, days) for b in touched]
    months = sorted({y * 100 + m for a, z in spans for y, m in _months_between(a, z)})
    bars = in_parts(spark, cfg.raw, months).where(block.isin(*touched))
    replace_parts(block_stats(bars, days), BLOCK, touched, cfg.blocks, cfg.location("analytics", "price_blocks"),
                  first, allow_empty=True)
    return touched


def _months_between(first: date, last: date) -> list[tuple[int, int]]:
    counted = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [(m // 12, m % 12 + 1) for m in counted]


def run_forecast(spark: SparkSession, cfg: Settings) -> DataFrame:
    """Fit, evaluate, predict, and the final table of history and predictions.

    The ingest has checked that raw holds one row per symbol and day, so the
    fit need not combine repeats. The model and its evaluation come from one pass and
    one shuffle. Where raw is kept by month, the trend itself comes from the stored
    blocks instead.
    """
    train = create_train_view(spark, cfg)
    place = cfg.location("analytics", "price_model")
    with scratch(fits(train, cfg.method, (0, cfg.horizon), keyed=True), "fits") as found:
        if cfg.refresh == "touched" and cfg.method == "trend":
            publish(merge_blocks(in_parts(spark, cfg.blocks), cfg.min_obs), cfg.model, place)
        else:
            publish(model_of(found, cfg.method, 0, cfg.min_obs), cfg.model, place)
        held_back = model_of(found, cfg.method, cfg.horizon, cfg.min_obs)
        # Series too short to hold anything back have no score.
        publish(scores(held_back, cfg.method, cfg.horizon, cfg.level), cfg.metrics,
                cfg.location("analytics", "price_model_metrics"), allow_empty=True)
    ahead = predict(spark.table(cfg.model), cfg.method, cfg.horizon, cfg.level, cfg.calendar)
    publish(ahead, cfg.forecast, cfg.location("adhoc", "market_data_forecast"))
    final = final_union(spark.table(cfg.raw), spark.table(cfg.forecast))
    publish(final, cfg.final, cfg.location("analytics", "market_data"))
    return spark.table(cfg.final)


def mart_from(raw: DataFrame, final: DataFrame, strict: bool = False, ranges: bool = False) -> DataFrame:
    """The mart straight from the raw and final tables, in one shuffle.

    The staged rows go in before their ``distinct``: choosing one row per key
    drops the same repeats, so the two extra shuffles would change nothing. With
    ``ranges`` the shuffle deals ranges of (symbol, date), split evenly by sampled
    size: the choice needs no other, and the files written hold a range each.
    """
    return mart_stock_analysis(history_rows(raw), forecast_rows(final, strict), ranges)


def changed_months(spark: SparkSession, cfg: Settings) -> list[int]:
    """The months of raw that were written since the snapshot last read them."""
    _, parts = current_version(spark, cfg.raw)
    seen = source_parts(spark, cfg.snapshot)
    return sorted(int(m) for m, run in parts.items() if seen.get(m) != run)


def run_publish(spark: SparkSession, cfg: Settings, as_of: datetime) -> DataFrame:
    """Snapshot, mart, then every check of the staging tables and the mart."""
    raw, final = spark.table(cfg.raw), spark.table(cfg.final)
    # The ingest has checked that keys are unique, and has dealt the whole table by key.
    if cfg.refresh == "touched":
        _, parts = current_version(spark, cfg.raw)
        changed = changed_months(spark, cfg)
        update_snapshot(spark, in_parts(spark, cfg.raw, changed).select(*raw.columns), cfg, as_of, checked=True,
                        parts=parts)
    else:
        update_snapshot(spark, raw, cfg, as_of, checked=True, dealt=True)
    publish(
        mart_from(raw, final, cfg.strict_forecast, ranges=True),
        cfg.mart,
        cfg.location("analytics", "mart_stock_analysis"),
        sort_by=("symbol", "date"),
    )
    mart = spark.table(cfg.mart)
    create_staging_views(spark, cfg)
    staged = {"stg_market_data": history_rows(raw), "stg_market_forecast": forecast_rows(final, cfg.strict_forecast)}
    # The staging tables are distinct rows; what they hold is told without making them.
    found = {name: distinct_report(rows, MODEL_CHECKS[name]) for name, rows in staged.items()}
    found["mart_stock_analysis"] = report(mart, MODEL_CHECKS["mart_stock_analysis"], mart_rule=True)
    for name, checks in found.items():
        log.info("%s passed %d checks", name, len(raise_on_failure(checks, name)))
    return mart


def published(cfg: Settings) -> dict[str, str]:
    """The tables that a run publishes, and where their folders lie."""
    return {
        cfg.raw: cfg.location("raw", "market_data"),
        cfg.ingest_counts: cfg.location("adhoc", "ingest_counts"),
        cfg.forecast: cfg.location("adhoc", "market_data_forecast"),
        cfg.blocks: cfg.location("analytics", "price_blocks"),
        cfg.model: cfg.location("analytics", "price_model"),
        cfg.metrics: cfg.location("analytics", "price_model_metrics"),
        cfg.final: cfg.location("analytics", "market_data"),
        cfg.mart: cfg.location("analytics", "mart_stock_analysis"),
    }


def clean_up(spark: SparkSession, cfg: Settings, keep: int = 1) -> int:
    """Remove versions older than the ``keep`` before the current ones, and dead snapshot files.

    How many folders went. Run it between daily runs, not beside one.
    """
    gone = [f for table, place in published(cfg).items() for f in retain(spark, table, place, keep)]
    if spark.catalog.tableExists(cfg.snapshot):
        gone += remove_dead(spark, cfg)
    return len(gone)
