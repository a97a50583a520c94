"""

The driver tables stand in for market data. ``events`` are the ticks: by
``event_type`` they make a few long series, by ``user_id`` many short ones. The
deliveries derived from them carry the usual faults: a lower-case symbol with
blanks, a text price of ``n/a`` (error events), a missing date (values over 200)
and several rows per symbol and day.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import bar_oracle as oracle  # noqa: E402
from marketbars.operators import dedup, mart, quality, snapshot, staging  # noqa: E402
from marketbars.operators import forecast as fc  # noqa: E402
from marketbars.operators.blocks import merge_blocks  # noqa: E402
from marketbars.operators.clean import clean_counts, normalize, typed_bars  # noqa: E402
from marketbars.plans.daily import mart_from, run_forecast, run_ingest, run_publish  # noqa: E402
from marketbars.schema import BARS, require_columns, conform  # noqa: E402
from marketbars.settings import Settings  # noqa: E402
from marketbars.shared import run_dir, stored  # noqa: E402
from marketbars.sinks.history import compact, update_snapshot  # noqa: E402
from marketbars.sinks.parts import in_parts  # noqa: E402
from marketbars.sinks.tables import (  # noqa: E402
    append,
    create_staging_views,
    empty_table,
    ensure_tables,
    insert_select,
    publish,
)
from marketbars.sources import (  # noqa: E402
    daily_bars,
    flatten_symbol,
    in_universe,
    lookback,
    missing_symbols,
    read_bars,
    read_named,
    universe,
    wide_to_long,
    write_delivery,
)

try:
    import corpus_pipeline
    from marketbars.llm import queries as llm
except ModuleNotFoundError as missing:  # the subpackage and its pipeline may be left out
    if missing.name not in ("corpus_pipeline", "marketbars.llm"):
        raise
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
FIRST_RUN = datetime(2024, 2, 1)
FAILED_RUN = datetime(2024, 2, 1, 12)
SECOND_RUN = datetime(2024, 2, 2)


# ---------------------------------------------------------------- inputs

def _events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet")


def _numbers(events: DataFrame) -> tuple[int, int]:
    """The range of event ids: one narrow scan."""
    return tuple(events.agg(F.min("event_id"), F.max("event_id")).first())


def _by_type(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    return daily_bars(events, F.upper("event_type"), "ts", "value", sequence="event_id",
                      sequence_range=_numbers(events))


def _user(column: str = "user_id"):
    return F.concat(F.lit("U"), F.col(column).cast("string"))


def _incoming(spark: SparkSession, sf: str) -> DataFrame:
    """One delivered bar per event, faults included."""
    value = F.col("value")
    return _events(spark, sf).select(
        F.concat(F.lit(" u"), F.col("user_id").cast("string"), F.lit(" ")).alias("symbol"),
        F.when(value <= 200, F.col("ts")).alias("Date"),
        (value - 0.5).alias("Open"),
        (value + 1).alias("High"),
        (value - 1).alias("Low"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(value.cast("string")).alias("Close"),
        F.col("event_id").alias("Volume"),
    )


def _stage(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(_incoming(spark, sf))


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.keep_one(_stage(spark, sf))


def _with_predictions(raw: DataFrame, holdout: int = 0) -> DataFrame:
    """History and trend predictions; ``holdout`` makes the model a stale one."""
    return mart.final_union(raw, fc.predict(fc.fit(staging.train_view(raw), holdout=holdout, keyed=True)))


def _final(spark: SparkSession, sf: str) -> DataFrame:
    return _with_predictions(stored(_raw(spark, sf), "raw"))


def _mart(spark: SparkSession, sf: str, holdout: int = 0) -> DataFrame:
    raw = stored(_raw(spark, sf), "raw")
    return mart_from(raw, _with_predictions(raw, holdout))


def _snapshot_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Bars of the same events under two day boundaries: midnight and 18:00."""
    events = _events(spark, sf)
    shifted = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 6 HOURS"))
    return (
        daily_bars(events, _user(), "ts", "value", sequence="event_id"),
        daily_bars(shifted, _user(), "ts", "value", sequence="event_id"),
    )


def _settings(spark: SparkSession, **changes) -> Settings:
    """Settings of a fresh database, so that runs do not share tables."""
    return Settings(
        base_path=run_dir(spark, "tables"),
        database=f"mb_{uuid.uuid4().hex[:10]}",
        **{"symbols": None, **changes},
    )


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 places, without negative zero, for comparison by value."""
    return df.select(
        *[
            (F.round(f.name, 6) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


# --------------------------------------------------------------- queries

def _read_back(file_format: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        path = run_dir(spark, f"bars-{file_format}")
        if file_format in ("csv", "json"):
            rows = _incoming(spark, sf).withColumn("Date", F.to_date("Date"))
            rows = rows.select("symbol", "Date", "Open", "High", "Low", "Close", "Volume")
            options = {"header": True} if file_format == "csv" else {}
            rows.write.format(file_format).options(**options).save(path)
            return _rounded(normalize(read_bars(spark, path, file_format)))
        conform(_by_type(spark, sf), BARS).write.format(file_format).save(path)
        return _rounded(read_bars(spark, path, file_format))

    return query


def _lookback(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(lookback(stored(_raw(spark, sf), "raw"), oracle.LOOKBACK_DAYS))


def _lookback_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(lookback(_raw(spark, sf), oracle.LOOKBACK_DAYS, oracle.LOOKBACK_END))


def _symbol_universe(spark: SparkSession, sf: str) -> DataFrame:
    wanted = universe(spark.range(1).select(F.lit(oracle.SYMBOL_LIST).alias("symbols")))
    return _rounded(in_universe(_by_type(spark, sf), wanted))


def _universe_literal(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(in_universe(_by_type(spark, sf), oracle.SYMBOL_LIST))


def _read_bars_named(spark: SparkSession, sf: str) -> DataFrame:
    """Named symbols of two indexed deliveries; files that hold none of them are not opened."""
    path = run_dir(spark, "delivered")
    for half in (0, 1):
        bars = conform(_by_type(spark, sf), BARS).where(F.dayofmonth("date") % 2 == half)
        write_delivery(bars, path, range_by=("symbol",))
    return _rounded(read_named(spark, path, oracle.SYMBOL_LIST))


def _missing_symbols(spark: SparkSession, sf: str) -> DataFrame:
    ticks = _events(spark, sf).select(F.upper("event_type").alias("symbol"))
    return missing_symbols(spark, ticks, oracle.SYMBOL_LIST)


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as one column per field and symbol, of the event types listed."""
    bars = _by_type(spark, sf)
    wide = bars.groupBy(F.col("date").alias("Date")).pivot("symbol", oracle.EVENT_TYPES).agg(
        *[F.first(c).alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")]
    )
    names = [c if c == "Date" else "|".join(reversed(c.rsplit("_", 1))) for c in wide.columns]
    return wide.toDF(*names)


def _wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(typed_bars(wide_to_long(_wide(spark, sf))))


def _wide_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """One symbol's plain columns, and their names in lower case."""
    one = flatten_symbol(_wide(spark, sf), oracle.FLAT_SYMBOL)
    return _rounded(one.toDF(*[c.lower() for c in one.columns]))


def _schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery whose columns come in another order passes and conforms."""
    delivery = _incoming(spark, sf)
    delivery = require_columns(delivery.select(*sorted(delivery.columns)))
    return _rounded(conform(typed_bars(delivery), BARS))


def _ensure_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Created twice, filled, emptied and filled again: each row is there once."""
    cfg = _settings(spark)
    ensure_tables(spark, cfg)
    append(_stage(spark, sf), cfg.stage)
    ensure_tables(spark, cfg)
    empty_table(spark, cfg.stage)
    append(_stage(spark, sf), cfg.stage)
    return _rounded(spark.table(cfg.stage))


def _insert_columns(spark: SparkSession, sf: str) -> DataFrame:
    """An insert that names some columns leaves the others null."""
    cfg = _settings(spark)
    ensure_tables(spark, cfg)
    view = f"closes_{uuid.uuid4().hex[:10]}"
    _raw(spark, sf).createOrReplaceTempView(view)
    columns = ("symbol", "date", "close")
    insert_select(spark, cfg.stage, columns, f"SELECT symbol, date, close FROM {view}")
    return _rounded(spark.table(cfg.stage))


def _write_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Rows counted by the write beside rows found in the table."""
    cfg = _settings(spark)
    ensure_tables(spark, cfg)
    written = append(_stage(spark, sf), cfg.stage)
    return spark.table(cfg.stage).agg(
        F.lit(written).cast("bigint").alias("rows_written"),
        F.count(F.lit(1)).alias("rows_stored"),
    )


def _full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table after two ingest runs: refreshed, not added to."""
    cfg = _settings(spark, train_days=None)
    for _ in range(2):
        run_ingest(spark, _incoming(spark, sf), cfg)
    return _rounded(spark.table(cfg.raw))


def _orders_delivery(spark: SparkSession, sf: str, number: int) -> DataFrame:
    """One of three deliveries of orders as bars: each covers some years, and later ones restate earlier days."""
    first, last = oracle.DELIVERED[number]
    orders = spark.read.parquet(f"{sf}/orders.parquet").where(F.col("o_orderdate").between(first, last))
    price = F.col("o_totalprice") + number
    return orders.select(
        F.concat(F.lit("c"), (F.col("o_custkey") % 40).cast("string")).alias("symbol"),
        F.col("o_orderdate").alias("Date"), price.alias("Open"), price.alias("High"), price.alias("Low"),
        price.alias("Close"), F.col("o_orderkey").alias("Volume"))


def _refresh_touched(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table after three deliveries, of which each is written to the months it touches."""
    cfg = _settings(spark, train_days=None, refresh="touched")
    for number in sorted(oracle.DELIVERED):
        run_ingest(spark, _orders_delivery(spark, sf, number), cfg)
    return _rounded(spark.table(cfg.raw))


def _trend_params_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The trend after three deliveries, merged from blocks of which each delivery computes those it touches."""
    cfg = _settings(spark, train_days=None, refresh="touched", block_days=oracle.BLOCK_DAYS)
    for first, last in oracle.SPANS:
        day = F.to_date("Date")
        part = _incoming(spark, sf).where(day.isNull() | day.between(first, last))
        run_ingest(spark, part, cfg)
    model = merge_blocks(in_parts(spark, cfg.blocks), cfg.min_obs)
    return _rounded(model.where("reason IS NULL").select(
        "series", "n_obs", "last_ts", "slope", "intercept", "sigma", "method"))


def _table_replace(spark: SparkSession, sf: str) -> DataFrame:
    """A published table replaced by one with other columns."""
    cfg = _settings(spark)
    ensure_tables(spark, cfg)
    raw, place = _raw(spark, sf), cfg.location("raw", "market_data")
    publish(raw, cfg.raw, place)
    publish(staging.train_view(spark.table(cfg.raw)), cfg.raw, place)
    return _rounded(spark.table(cfg.raw))


def _daily_run_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The mart table after ingest, forecast and publish through the catalog."""
    cfg = _settings(spark, train_days=None)
    run_ingest(spark, _incoming(spark, sf), cfg)
    run_forecast(spark, cfg)
    return _rounded(run_publish(spark, cfg, FIRST_RUN))


def _trend_params(spark: SparkSession, sf: str) -> DataFrame:
    model = fc.fit(staging.train_view(_raw(spark, sf)), keyed=True)
    return _rounded(model.where("reason IS NULL").select(
        "series", "n_obs", "last_ts", "slope", "intercept", "sigma", "method"))


def _skipped_series(spark: SparkSession, sf: str) -> DataFrame:
    return fc.skipped(fc.fit(staging.train_view(_raw(spark, sf)), min_obs=oracle.MANY_OBS, keyed=True))


def _forecast(method: str, **options) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _rounded(fc.forecast(staging.train_view(_raw(spark, sf)), method, keyed=True, **options))

    return query


def _backtest(method: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _rounded(fc.backtest(staging.train_view(_raw(spark, sf)), method, keyed=True))

    return query


def _clean_series(spark: SparkSession, sf: str) -> DataFrame:
    ahead = fc.forecast(staging.train_view(_raw(spark, sf)), keyed=True)
    quoted = F.concat(F.lit('"'), F.col("series"), F.lit('"'))
    return _rounded(mart.clean_series(ahead.withColumn("series", quoted)))


def _dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_null(typed_bars(_incoming(spark, sf)), ("symbol", "date", "close"))


def _dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique(staging.history_rows(_stage(spark, sf)), "pk_symbol_date")


def _dq_accepted_values(spark: SparkSession, sf: str) -> DataFrame:
    return quality.accepted_values(_events(spark, sf), "event_type", oracle.ACCEPTED)


def _dq_forecast_future(spark: SparkSession, sf: str) -> DataFrame:
    stale = stored(_mart(spark, sf, holdout=oracle.HORIZON), "mart")
    return _rounded(quality.forecast_not_future(stale))


def _dq_report(spark: SparkSession, sf: str) -> DataFrame:
    stale = stored(_mart(spark, sf, holdout=oracle.HORIZON), "mart")
    checks = quality.MODEL_CHECKS["mart_stock_analysis"]
    return quality.report(stale, checks, mart_rule=True)


def _dq_report_stage(spark: SparkSession, sf: str) -> DataFrame:
    rows = staging.history_rows(_stage(spark, sf))
    return quality.report(rows, quality.MODEL_CHECKS["stg_market_data"])


def _dq_report_staged(spark: SparkSession, sf: str) -> DataFrame:
    """Checks of the distinct staged rows, from rows that are there up to three times."""
    rows = staging.history_rows(_stage(spark, sf))
    rows = rows.unionByName(rows).unionByName(rows.where("volume % 2 = 0"))
    return quality.distinct_report(rows, quality.MODEL_CHECKS["stg_market_data"])


def _snapshot_initial(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(snapshot.initial(_snapshot_sources(spark, sf)[0], FIRST_RUN))


def _snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _snapshot_sources(spark, sf)
    return snapshot.changes(snapshot.initial(first, FIRST_RUN), second)


def _snapshot_apply(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _snapshot_sources(spark, sf)
    return _rounded(snapshot.apply(snapshot.initial(first, FIRST_RUN), second, SECOND_RUN))


def _snapshot_table(spark: SparkSession, sf: str) -> DataFrame:
    """The stored snapshot after two runs."""
    cfg = _settings(spark)
    ensure_tables(spark, cfg)
    first, second = _snapshot_sources(spark, sf)
    update_snapshot(spark, first, cfg, FIRST_RUN)
    return _rounded(update_snapshot(spark, second, cfg, SECOND_RUN))


def _snapshot_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """The stored snapshot after a run, a run that failed before its commit, and a later run."""
    cfg = _settings(spark)
    ensure_tables(spark, cfg)
    first, second = _snapshot_sources(spark, sf)
    update_snapshot(spark, first, cfg, FIRST_RUN)
    junk = snapshot.initial(second, FAILED_RUN).withColumn("valid_to", F.col("valid_from"))
    files = cfg.location("snapshots", "market_data_snapshot") + "_files"
    for state in ("opened", "closed"):
        junk.write.parquet(f"{files}/epoch=2/state={state}")
    return _rounded(update_snapshot(spark, second, cfg, SECOND_RUN))


def _snapshot_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The stored snapshot after a run, its compaction, and a second run."""
    cfg = _settings(spark)
    ensure_tables(spark, cfg)
    first, second = _snapshot_sources(spark, sf)
    update_snapshot(spark, first, cfg, FIRST_RUN)
    compact(spark, cfg)
    return _rounded(update_snapshot(spark, second, cfg, SECOND_RUN))


def _ingest_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per symbol before and after cleaning, as the ingest stores them."""
    cfg = _settings(spark, train_days=None)
    run_ingest(spark, _incoming(spark, sf), cfg)
    return spark.table(cfg.ingest_counts)


def _staging_view(which: int) -> Callable[[SparkSession, str], DataFrame]:
    """A stored staging view, read through the catalog."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        cfg = _settings(spark)
        ensure_tables(spark, cfg)
        publish(_raw(spark, sf), cfg.raw, cfg.location("raw", "market_data"))
        publish(_with_predictions(spark.table(cfg.raw)), cfg.final,
                cfg.location("analytics", "market_data"))
        create_staging_views(spark, cfg)
        return _rounded(spark.table((cfg.stg_history, cfg.stg_forecast)[which]))

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the mart of history and forecasts."""
    return _rounded(_mart(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources
        "read_bars": _read_back("parquet"),
        "read_bars_csv": _read_back("csv"),
        "read_bars_json": _read_back("json"),
        "daily_bars": lambda s, d: _rounded(_by_type(s, d)),
        "lookback": _lookback,
        "lookback_as_of": _lookback_as_of,
        "symbol_universe": _symbol_universe,
        "symbol_universe_literal": _universe_literal,
        "read_bars_named": _read_bars_named,
        "missing_symbols": _missing_symbols,
        "wide_to_long": _wide_to_long,
        "wide_flatten": _wide_flatten,
        # tables
        "ensure_tables": _ensure_tables,
        "insert_columns": _insert_columns,
        "write_guard": _write_guard,
        "full_refresh": _full_refresh,
        "refresh_touched": _refresh_touched,
        "table_replace": _table_replace,
        "daily_run_mart": _daily_run_mart,
        # cleaning and duplicates
        "schema_contract": _schema_contract,
        "normalize_bars": lambda s, d: _rounded(_stage(s, d)),
        "ingest_counts": _ingest_counts,
        "clean_counts": lambda s, d: clean_counts(_incoming(s, d)),
        "stage_dedup": lambda s, d: _rounded(_raw(s, d)),
        "dup_keys": lambda s, d: dedup.duplicate_keys(_stage(s, d)),
        "dup_key_count": lambda s, d: dedup.duplicate_key_count(_stage(s, d)),
        "dup_sample": lambda s, d: dedup.duplicate_sample(_stage(s, d)),
        "row_stats": lambda s, d: dedup.row_stats(typed_bars(_incoming(s, d))),
        # staging and mart
        "train_view": lambda s, d: _rounded(staging.train_view(_raw(s, d))),
        "stg_market_data": lambda s, d: _rounded(staging.stg_market_data(_raw(s, d))),
        "stg_market_forecast": lambda s, d: _rounded(staging.stg_market_forecast(_final(s, d))),
        "stg_market_forecast_strict": lambda s, d: _rounded(
            staging.stg_market_forecast(_final(s, d), strict=True)),
        "stg_market_data_view": _staging_view(0),
        "stg_market_forecast_view": _staging_view(1),
        "final_union": lambda s, d: _rounded(_final(s, d)),
        "clean_series": _clean_series,
        "mart_stock_analysis": lambda s, d: _rounded(_mart(s, d)),
        "trend_read": lambda s, d: _rounded(mart.trend_read(_mart(s, d))),
        "last_hist_date": lambda s, d: quality.last_history_day(_mart(s, d)),
        # forecasting
        "trend_params": _trend_params,
        "trend_params_merged": _trend_params_merged,
        "skipped_series": _skipped_series,
        "forecast_trend": _forecast("trend"),
        "forecast_trend_weekday": _forecast("trend", calendar="weekday", level=0.8),
        "forecast_drift": _forecast("drift"),
        "forecast_seasonal_naive": _forecast("seasonal_naive"),
        "forecast_holt": _forecast("holt"),
        "backtest_metrics": _backtest("trend"),
        "backtest_drift": _backtest("drift"),
        "backtest_seasonal_naive": _backtest("seasonal_naive"),
        "backtest_holt": _backtest("holt"),
        # quality
        "dq_not_null": _dq_not_null,
        "dq_unique": _dq_unique,
        "dq_accepted_values": _dq_accepted_values,
        "dq_forecast_future": _dq_forecast_future,
        "dq_report": _dq_report,
        "dq_report_stage": _dq_report_stage,
        "dq_report_staged": _dq_report_staged,
        # snapshot
        "snapshot_initial": _snapshot_initial,
        "snapshot_changes": _snapshot_changes,
        "snapshot_apply": _snapshot_apply,
        "snapshot_table": _snapshot_table,
        "snapshot_after_failure": _snapshot_after_failure,
        "snapshot_compacted": _snapshot_compacted,
        **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The SQL each query must equal, for DuckDB on the same tables."""
    return oracle.statements() | (llm.oracle_sql() if llm else {})
