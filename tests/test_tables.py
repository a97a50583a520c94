import pytest

from helpers import GOLDEN_DELIVERY, GOLDEN_RAW, bars, closes, day, delivery, moment, rows
from marketbars.operators.quality import QualityError
from marketbars.plans.daily import run_forecast, run_ingest, run_publish
from marketbars.schema import BARS
from marketbars.session import cluster_conf
from marketbars.settings import Settings, quoted
from marketbars.shared import run_dir, shared_dir
from marketbars.sinks.tables import (
    EmptyWriteError,
    append,
    create_train_view,
    empty_table,
    ensure_tables,
    insert_select,
    publish,
)


def settings(tmp_path, name, **changes):
    return Settings(base_path=str(tmp_path), database=name, **{"symbols": None, **changes})


def test_ensure_is_idempotent_and_typed(spark, tmp_path):
    cfg = settings(tmp_path, "t1")
    ensure_tables(spark, cfg)
    append(bars(spark, GOLDEN_RAW), cfg.stage)
    publish(bars(spark, GOLDEN_RAW), cfg.raw, cfg.location("raw", "market_data"))
    ensure_tables(spark, cfg)
    for table in (cfg.stage, cfg.raw):
        assert spark.table(table).count() == 3
        assert [(f.name, f.dataType) for f in spark.table(table).schema] == [
            (f.name, f.dataType) for f in BARS]


def test_append_counts_and_refuses_nothing(spark, tmp_path):
    cfg = settings(tmp_path, "t2")
    ensure_tables(spark, cfg)
    rowset = bars(spark, GOLDEN_RAW)
    assert append(rowset.select(*reversed(rowset.columns)), cfg.stage) == 3
    assert append(rowset, cfg.stage) == 3
    assert spark.table(cfg.stage).count() == 6
    with pytest.raises(EmptyWriteError):
        append(rowset.where("symbol = 'none'"), cfg.stage)
    with pytest.raises(EmptyWriteError):
        append(rowset.limit(0), cfg.stage)
    assert append(rowset.limit(0), cfg.stage, allow_empty=True) == 0


def test_empty_table(spark, tmp_path):
    cfg = settings(tmp_path, "t3")
    empty_table(spark, cfg.stage)  # absent: nothing to do
    ensure_tables(spark, cfg)
    append(bars(spark, GOLDEN_RAW), cfg.stage)
    empty_table(spark, cfg.stage)
    assert spark.table(cfg.stage).count() == 0


def test_insert_names_columns(spark, tmp_path):
    cfg = settings(tmp_path, "t4")
    ensure_tables(spark, cfg)
    insert_select(spark, cfg.stage, ["close", "symbol"], "SELECT 2.5D, 'Z'")
    row = spark.table(cfg.stage).first()
    assert (row["symbol"], row["close"], row["open"]) == ("Z", 2.5, None)


def test_publish_replaces_a_table_from_itself(spark, tmp_path):
    """Rows computed from the table being replaced are all there afterwards."""
    cfg = settings(tmp_path, "t5")
    ensure_tables(spark, cfg)
    place = cfg.location("raw", "market_data")
    publish(bars(spark, GOLDEN_RAW), cfg.raw, place)
    raw = spark.table(cfg.raw)
    assert publish(raw.unionAll(raw), cfg.raw, place) == 6
    assert spark.table(cfg.raw).count() == 6


def test_failed_publish_leaves_the_old_rows(spark, tmp_path):
    cfg = settings(tmp_path, "t6")
    ensure_tables(spark, cfg)
    place = cfg.location("raw", "market_data")
    publish(bars(spark, GOLDEN_RAW), cfg.raw, place)
    with pytest.raises(EmptyWriteError):
        publish(spark.table(cfg.raw).limit(0), cfg.raw, place)
    assert spark.table(cfg.raw).count() == 3


def test_published_ranges(spark, tmp_path):
    cfg = settings(tmp_path, "t7")
    ensure_tables(spark, cfg)
    data = closes(spark, [(f"S{i}", f"2025-01-{d:02d}", 1.0) for i in range(20) for d in range(1, 11)])
    publish(data, cfg.raw, cfg.location("raw", "market_data"), range_by=("symbol", "date"))
    assert rows(spark.table(cfg.raw)) == rows(data)


def test_train_view_follows_the_table(spark, tmp_path):
    cfg = settings(tmp_path, "t8")
    ensure_tables(spark, cfg)
    create_train_view(spark, cfg)
    assert spark.table(cfg.train_view).count() == 0
    publish(bars(spark, GOLDEN_RAW), cfg.raw, cfg.location("raw", "market_data"))
    assert spark.table(cfg.train_view).count() == 3
    assert sorted(spark.table(cfg.train_view).columns) == ["close", "date", "symbol"]


def long_delivery(spark, symbols=("aapl", "nvda"), days=20):
    data = [(f"2025-01-{d:02d}", s, str(d), str(10 + d + (d % 3)), str(d - 1), str(d + 30), "100")
            for s in symbols for d in range(1, days + 1)]
    return delivery(spark, data + data[:2])


def test_daily_run(spark, tmp_path):
    cfg = settings(tmp_path, "t9", symbols=("AAPL", "NVDA"), train_days=15)
    info = run_ingest(spark, long_delivery(spark, ("aapl", "nvda", "other")), cfg)
    assert info == {"staged_rows": 30, "total_rows": 30, "distinct_pairs": 30}
    final = run_forecast(spark, cfg)
    assert final.count() == 30 + 14
    mart = run_publish(spark, cfg, moment("2025-01-21"))
    got = {r["record_type"]: r["count"] for r in mart.groupBy("record_type").count().collect()}
    assert got == {"historical": 30, "forecast": 14}
    assert spark.table(cfg.snapshot).count() == 30
    assert spark.table(cfg.stg_history).count() == 30
    assert spark.table(cfg.stg_forecast).count() == 14
    assert spark.table(cfg.metrics).count() == 2
    # A second day: the window rolls, the snapshot keeps what left it.
    run_ingest(spark, long_delivery(spark, days=22), cfg)
    run_forecast(spark, cfg)
    run_publish(spark, cfg, moment("2025-01-23"))
    assert spark.table(cfg.raw).count() == 30
    assert spark.table(cfg.snapshot).count() == 34
    assert spark.table(cfg.mart).agg({"date": "max"}).first()[0] == day("2025-01-29")


def test_ingest_names_symbols_without_data(spark, tmp_path):
    cfg = settings(tmp_path, "t10", symbols=("AAPL", "MSFT"))
    with pytest.raises(RuntimeError, match="MSFT"):
        run_ingest(spark, long_delivery(spark), cfg)


def test_ingest_refuses_an_empty_delivery(spark, tmp_path):
    cfg = settings(tmp_path, "t11")
    with pytest.raises(EmptyWriteError):
        run_ingest(spark, delivery(spark, GOLDEN_DELIVERY).limit(0), cfg)


def test_publish_stops_on_failing_checks(spark, tmp_path):
    cfg = settings(tmp_path, "t12")
    run_ingest(spark, long_delivery(spark), cfg)
    final = run_forecast(spark, cfg)
    broken = final.selectExpr(
        "symbol", "CASE WHEN actual IS NULL THEN date_sub(date, 200) ELSE date END AS date",
        "actual", "forecast", "lower_bound", "upper_bound")
    publish(broken, cfg.final, cfg.location("analytics", "market_data"))
    with pytest.raises(QualityError, match="forecast_future"):
        run_publish(spark, cfg, moment("2025-01-21"))


def test_shared_dir_is_read_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_names_are_quoted():
    assert quoted("a", "b`c") == "`a`.`b``c`"


def test_cluster_settings_follow_the_shuffle_size():
    assert cluster_conf(0)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(2**40)["spark.sql.shuffle.partitions"] == "2048"
    assert cluster_conf(10**15)["spark.sql.shuffle.partitions"] == "1862646"


def test_publish_can_be_repeated_after_a_failed_mart(spark, tmp_path, monkeypatch):
    from marketbars.plans import daily

    cfg = settings(tmp_path, "t20", symbols=None)
    days = [f"2025-01-{d:02d}" for d in range(1, 21)]
    incoming = delivery(spark, [(d, "AAPL", "1", str(10 + k), "1", "1", "5") for k, d in enumerate(days)])
    run_ingest(spark, incoming, cfg)
    assert [tuple(r) for r in spark.table(cfg.ingest_counts).collect()] == [("AAPL", 20, 20)]
    run_forecast(spark, cfg)
    as_of = moment("2025-01-21")
    with monkeypatch.context() as broken:
        broken.setattr(daily, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_publish(spark, cfg, as_of)
    held = rows(spark.table(cfg.snapshot))
    assert len(held) == 20
    assert run_publish(spark, cfg, as_of).count() > 20
    assert rows(spark.table(cfg.snapshot)) == held
