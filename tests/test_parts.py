"""Tables kept in parts, their versions, and what old versions leave behind."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import GOLDEN_RAW, bars, closes, day, delivery, moment, rows
from marketbars.operators.blocks import BLOCK, block_number, block_span, block_stats, merge_blocks
from marketbars.operators.forecast import fit
from marketbars.plans import daily
from marketbars.plans.daily import clean_up, published, refresh_blocks, run_forecast, run_ingest, run_publish
from marketbars.schema import BARS
from marketbars.settings import Settings
from marketbars.sinks.parts import in_parts, month_number, refresh_touched, replace_parts
from marketbars.sinks.tables import EmptyWriteError, current_version, ensure_tables, publish, retain


def settings(tmp_path, name, **changes):
    return Settings(base_path=str(tmp_path), database=name,
                    **{"symbols": None, "train_days": None, "refresh": "touched", "buckets": 2, **changes})


def files_by_month(spark, cfg):
    found = {}
    for path in in_parts(spark, cfg.raw).inputFiles():
        found.setdefault(path.split("month=")[1][:6], set()).add(path)
    return found


def test_untouched_months_keep_their_files(spark, tmp_path):
    cfg = settings(tmp_path, "p1")
    ensure_tables(spark, cfg)
    place = cfg.location("raw", "market_data")
    first = closes(spark, [("A", f"2025-{m:02d}-{d:02d}", float(m)) for m in range(1, 7) for d in (1, 20)])
    assert refresh_touched(first, cfg.raw, place) == [202500 + m for m in range(1, 7)]
    before = files_by_month(spark, cfg)
    second = closes(spark, [("A", "2025-03-20", 9.0), ("B", "2025-05-02", 8.0), ("A", "2025-07-01", 7.0)])
    assert refresh_touched(second, cfg.raw, place) == [202503, 202505, 202507]
    after = files_by_month(spark, cfg)
    for month in ("202501", "202502", "202504", "202506"):
        assert after[month] == before[month]
    for month in ("202503", "202505"):
        assert not after[month] & before[month]
    assert spark.table(cfg.raw).schema == BARS
    got = {(r["symbol"], str(r["date"])): r["close"] for r in spark.table(cfg.raw).collect()}
    assert len(got) == 14 == spark.table(cfg.raw).count()
    assert (got["A", "2025-03-01"], got["A", "2025-03-20"], got["B", "2025-05-02"]) == (3.0, 9.0, 8.0)
    assert {str(f)[-30:] for f in in_parts(spark, cfg.raw, [202503]).inputFiles()} == {
        str(f)[-30:] for f in after["202503"]}


def test_random_deliveries_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    cfg = settings(tmp_path, "p2")
    ensure_tables(spark, cfg)
    want = {}
    for step in range(4):
        start = rng.randrange(1, 9)
        data = [(rng.choice("ABC"), f"2024-{rng.randrange(start, start + 4):02d}-{rng.randrange(1, 5):02d}",
                 rng.choice([None, 1.0, 2.0, float(step)])) for _ in range(40)]
        mine = {}
        for s, d, c in data:
            old = mine.get((s, d), ())
            mine[s, d] = c if old == () or (c is not None and (old is None or c < old)) else old
        want |= mine
        refresh_touched(closes(spark, data), cfg.raw, cfg.location("raw", "market_data"))
    got = {(r["symbol"], str(r["date"])): r["close"] for r in spark.table(cfg.raw).collect()}
    assert got == want and spark.table(cfg.raw).count() == len(want)


def test_a_failed_refresh_changes_nothing(spark, tmp_path, monkeypatch):
    cfg = settings(tmp_path, "p3")
    ensure_tables(spark, cfg)
    place = cfg.location("raw", "market_data")
    data = closes(spark, [("A", "2025-01-01", 1.0), ("A", "2025-02-01", 1.0)])
    refresh_touched(data, cfg.raw, place)
    held = current_version(spark, cfg.raw)
    with pytest.raises(EmptyWriteError):
        refresh_touched(data.limit(0), cfg.raw, place)
    from marketbars.sinks import parts
    with monkeypatch.context() as broken:
        broken.setattr(parts, "switch", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            refresh_touched(closes(spark, [("A", "2025-01-01", 2.0)]), cfg.raw, place)
    assert current_version(spark, cfg.raw) == held
    assert rows(spark.table(cfg.raw)) == rows(data)


def test_months_before_the_first_leave_and_a_whole_table_is_taken_over(spark, tmp_path):
    cfg = settings(tmp_path, "p4")
    ensure_tables(spark, cfg)
    place = cfg.location("raw", "market_data")
    whole = closes(spark, [("A", f"2025-{m:02d}-10", 1.0) for m in range(1, 6)])
    publish(whole, cfg.raw, place)
    refresh_touched(closes(spark, [("A", "2025-05-10", 2.0)]), cfg.raw, place)
    assert sorted(current_version(spark, cfg.raw)[1]) == [str(202500 + m) for m in range(1, 6)]
    assert spark.table(cfg.raw).count() == 5
    refresh_touched(closes(spark, [("A", "2025-06-10", 3.0), ("A", "2025-01-10", 9.0)]), cfg.raw, place, first=202504)
    got = {(str(r["date"]), r["close"]) for r in spark.table(cfg.raw).collect()}
    assert got == {("2025-04-10", 1.0), ("2025-05-10", 2.0), ("2025-06-10", 3.0)}
    # A table from before there were versions is taken over too.
    data = closes(spark, [("A", "2025-01-10", 1.0), ("A", "2025-02-10", 1.0)])
    data.write.parquet(cfg.location("analytics", "old"))
    spark.sql(f"CREATE TABLE {cfg.final} USING parquet LOCATION '{cfg.location('analytics', 'old')}'")
    refresh_touched(closes(spark, [("A", "2025-02-10", 2.0)]), cfg.final, cfg.location("analytics", "market_data"))
    assert {r["close"] for r in spark.table(cfg.final).collect()} == {1.0, 2.0}
    # And back: a whole refresh replaces the parts.
    publish(whole, cfg.raw, place)
    assert rows(spark.table(cfg.raw)) == rows(whole) and current_version(spark, cfg.raw)[1] == {}


def test_a_touched_part_without_rows_leaves(spark, tmp_path):
    cfg = settings(tmp_path, "p5")
    ensure_tables(spark, cfg)
    place = cfg.location("analytics", "price_blocks")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "x string, block int")
    replace_parts(two, "block", [1, 2], cfg.blocks, place)
    replace_parts(two.where("block = 3"), "block", [2, 3], cfg.blocks, place, allow_empty=True)
    assert [tuple(r) for r in in_parts(spark, cfg.blocks).collect()] == [("a", 1)]


# ------------------------------------------------------------------- versions

def test_readers_see_old_or_new_rows_while_columns_change(spark, tmp_path, monkeypatch):
    """Between the two steps of a replacement, writing and switching, the old rows are there."""
    cfg = settings(tmp_path, "v1")
    ensure_tables(spark, cfg)
    place = cfg.location("raw", "market_data")
    publish(bars(spark, GOLDEN_RAW), cfg.raw, place)
    reader = spark.table(cfg.raw)
    narrow = reader.select("symbol", "close")
    seen, plain = [], spark.sql

    def watched(text, *args, **kwargs):
        if text.startswith("CREATE OR REPLACE VIEW"):
            seen.append((plain(f"SELECT * FROM {cfg.raw}").columns, plain(f"SELECT * FROM {cfg.raw}").count()))
        assert not text.startswith("DROP")
        return plain(text, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", lambda self, text, *a, **k: watched(text, *a, **k))
        publish(narrow, cfg.raw, place)
    assert seen == [(BARS.names, 3)]
    assert spark.table(cfg.raw).columns == ["symbol", "close"] and spark.table(cfg.raw).count() == 3
    assert reader.count() == 3 and len(reader.first()) == len(BARS.names)

    with monkeypatch.context() as broken:
        def fails(self, text, *a, **k):
            if text.startswith("CREATE OR REPLACE VIEW"):
                raise OSError("lost")
            return plain(text, *a, **k)
        broken.setattr(type(spark), "sql", fails)
        with pytest.raises(OSError):
            publish(bars(spark, GOLDEN_RAW[:1]), cfg.raw, place)
    assert spark.table(cfg.raw).columns == ["symbol", "close"] and spark.table(cfg.raw).count() == 3


def test_a_table_from_before_there_were_versions_is_replaced(spark, tmp_path):
    cfg = settings(tmp_path, "v2")
    ensure_tables(spark, cfg)
    place = cfg.location("analytics", "market_data")
    spark.sql(f"CREATE TABLE {cfg.final} (symbol STRING) USING parquet LOCATION '{place}/run-0'")
    publish(closes(spark, [("A", "2025-01-01", 1.0)]), cfg.final, place)
    assert spark.table(cfg.final).count() == 1 and current_version(spark, cfg.final)
    # A managed table would take its folder along, so it is left as it is.
    spark.sql(f"CREATE TABLE {cfg.mart} (symbol STRING) USING parquet")
    with pytest.raises(ValueError, match="managed"):
        publish(closes(spark, [("A", "2025-01-01", 1.0)]), cfg.mart, cfg.location("analytics", "other"))


def test_retention_removes_what_no_version_names(spark, tmp_path):
    cfg = settings(tmp_path, "v3")
    ensure_tables(spark, cfg)
    place = cfg.location("analytics", "price_model")
    assert retain(spark, cfg.model, place) == []
    for k in range(4):
        publish(closes(spark, [("A", "2025-01-01", float(k))]), cfg.model, place)
    with pytest.raises(EmptyWriteError):
        publish(closes(spark, [("A", "2025-01-01", 9.0)]).limit(0), cfg.model, place)
    publish(closes(spark, [("A", "2025-01-01", 5.0)]), cfg.model, place)
    assert len(list(Path(place).iterdir())) == 6
    # The current version and one before it stay; the failed run's folder goes too.
    assert len(retain(spark, cfg.model, place, keep=1)) == 4
    assert len([p for p in Path(place).iterdir() if p.is_dir()]) == 2
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {cfg.model.rpartition('.')[0]}").collect()]
    assert [n.partition("__")[0] for n in names if n.startswith("price_model")] == ["price_model"] * 3
    assert spark.table(cfg.model).first()["close"] == 5.0
    assert retain(spark, cfg.model, place, keep=1) == []


def test_retention_keeps_folders_that_hold_live_parts(spark, tmp_path):
    cfg = settings(tmp_path, "v4")
    ensure_tables(spark, cfg)
    place = cfg.location("raw", "market_data")
    for data in ([("A", "2025-01-01", 1.0), ("A", "2025-02-01", 1.0)], [("A", "2025-02-01", 2.0)],
                 [("A", "2025-02-01", 3.0)], [("A", "2025-02-01", 4.0)]):
        refresh_touched(closes(spark, data), cfg.raw, place)
    runs = [v for _, v in sorted(current_version(spark, cfg.raw)[1].items())]
    gone = retain(spark, cfg.raw, place, keep=0)
    assert not set(gone) & set(runs) and len(gone) >= 2
    assert {(str(r["date"]), r["close"]) for r in spark.table(cfg.raw).collect()} == {
        ("2025-01-01", 1.0), ("2025-02-01", 4.0)}


# --------------------------------------------------------------------- blocks

COLUMNS = ("series", "n_obs", "last_ts", "slope", "intercept", "x_mean", "sxx", "sxy", "syy", "sigma", "reason")


def models(df):
    return {r["series"]: [r[c] for c in COLUMNS] for r in df.select(*COLUMNS).collect()}


def numbers(found):
    """Models as plain numbers: dates as days, no reason as 0."""
    return {s: [v.toordinal() if hasattr(v, "toordinal") else v or 0.0 for v in m[1:-1]] for s, m in found.items()}


def some_prices(seed, offset=0.0):
    rng = random.Random(seed)
    out = []
    for s, size in (("A", 90), ("B", 40), ("C", 3), ("D", 2), ("E", 30), ("NONE", 5)):
        for k in rng.sample(range(120), size):
            price = offset + rng.random() * 10 + k / 7
            price = None if s == "NONE" or rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else price
            out.append((s, str(day("2024-11-20").fromordinal(day("2024-11-20").toordinal() + k)), price))
    return out


@pytest.mark.parametrize(("seed", "offset", "days"), [(1, 0.0, 7), (2, 1e7, 1), (3, -5.0, 30), (4, 1e7, 500)])
def test_merged_blocks_equal_one_fit(spark, seed, offset, days):
    data = closes(spark, some_prices(seed, offset))
    got, want = models(merge_blocks(block_stats(data, days))), models(fit(data, keyed=True))
    assert got.keys() == want.keys()
    for series, expected in want.items():
        for name, a, b in zip(COLUMNS, got[series], expected):
            if isinstance(b, float) and want[series][COLUMNS.index("reason")] is None:
                assert a == pytest.approx(b, rel=1e-7, abs=1e-7), (series, name)
            elif not isinstance(b, float) and name in ("n_obs", "last_ts", "reason"):
                assert a == b, (series, name)


def test_block_numbers_and_spans():
    for d in ("1969-12-31", "1970-01-01", "2024-02-29", "2025-01-01"):
        for days in (1, 7, 30):
            first, last = block_span(block_number(day(d), days), days)
            assert first <= day(d) <= last and (last - first).days == days - 1


def price_delivery(spark, days, symbols=("A", "B")):
    start = day("2025-01-01").toordinal()
    return delivery(spark, [(str(day("2025-01-01").fromordinal(start + k)), s, "1", str(10 + k + (k * i) % 5), "1", "1",
                             "5") for k in days for i, s in enumerate(symbols, 2)])


def test_daily_run_on_touched_months(spark, tmp_path, monkeypatch):
    """Three small deliveries give the tables of one whole delivery; a refit reads touched months only."""
    whole = settings(tmp_path, "b1", refresh="full")
    run_ingest(spark, price_delivery(spark, range(100)), whole)
    run_forecast(spark, whole)
    cfg = settings(tmp_path, "b2", block_days=10)
    read = []
    plain = daily.block_stats
    monkeypatch.setattr(daily, "block_stats", lambda df, days: read.append(df.inputFiles()) or plain(df, days))
    for span in (range(50), range(45, 90), range(90, 100)):
        info = run_ingest(spark, price_delivery(spark, span), cfg)
        assert info["staged_rows"] == 2 * len(span) and info["total_rows"] == info["distinct_pairs"]
    run_forecast(spark, cfg)
    assert rows(spark.table(cfg.raw)) == rows(spark.table(whole.raw))
    assert {f.split("month=")[1][:6] for f in read[2]} <= {"202503", "202504"}
    got, want = numbers(models(spark.table(cfg.model))), numbers(models(spark.table(whole.model)))
    assert got.keys() == want.keys() == {"A", "B"}
    for series in want:
        assert got[series] == pytest.approx(want[series], rel=1e-9)
    for name in ("forecast", "metrics", "final"):
        assert spark.table(getattr(cfg, name)).count() == spark.table(getattr(whole, name)).count()


def test_the_snapshot_reads_changed_months_only(spark, tmp_path, monkeypatch):
    """Three deliveries on touched months give the snapshot of three whole ones."""
    spans = (range(60), range(50, 75), range(75, 90))
    whole, cfg = settings(tmp_path, "h1", refresh="full"), settings(tmp_path, "h2", block_days=10)
    read, plain = [], daily.update_snapshot

    def watched(spark, source, *args, **kwargs):
        read.append({f.split("month=")[1][:6] for f in source.inputFiles()} if "parts" in kwargs else None)
        return plain(spark, source, *args, **kwargs)

    monkeypatch.setattr(daily, "update_snapshot", watched)

    def restated(span, k):
        return price_delivery(spark, span).withColumn("Close", F.expr(f"cast(Close + {k} as string)"))

    for k, span in enumerate(spans):
        at = moment(f"2025-05-{k + 1:02d}")
        run_ingest(spark, restated(span, k), cfg)
        run_forecast(spark, cfg)
        assert rows(run_publish(spark, cfg, at)) is not None
        # The whole run delivers what the touched one has gathered.
        run_ingest(spark, spark.table(cfg.raw).withColumnRenamed("date", "Date"), whole)
        run_forecast(spark, whole)
        run_publish(spark, whole, at)
        assert rows(spark.table(cfg.snapshot)) == rows(spark.table(whole.snapshot))
    assert [r for r in read if r is not None] == [
        {"202501", "202502", "202503"}, {"202502", "202503"}, {"202503"}]
    assert daily.changed_months(spark, cfg) == []
    held = rows(spark.table(cfg.snapshot))
    run_publish(spark, cfg, at)
    assert rows(spark.table(cfg.snapshot)) == held


def test_daily_runs_leave_a_bounded_number_of_folders(spark, tmp_path):
    cfg = settings(tmp_path, "b4", block_days=10)
    left = []
    for k in range(3):
        run_ingest(spark, price_delivery(spark, range(40 + 5 * k, 50 + 5 * k)), cfg)
        run_forecast(spark, cfg)
        mart = run_publish(spark, cfg, moment(f"2025-04-{k + 1:02d}"))
        held = rows(mart)
        clean_up(spark, cfg, keep=1)
        assert rows(spark.table(cfg.mart)) == held
        left.append(sum(len([p for p in Path(place).iterdir() if p.is_dir()]) for place in published(cfg).values()))
    # Two versions of each table stay, and the folders of earlier runs that hold months or blocks still named.
    assert left[2] <= 2 * len(published(cfg)) + 4
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("marketbars/typed-*"))


def test_blocks_before_the_look_back_leave_whole(spark, tmp_path):
    cfg = settings(tmp_path, "b3", block_days=10, train_days=30, as_of=day("2025-03-01"))
    ensure_tables(spark, cfg)
    start = day("2025-01-01").toordinal()
    data = closes(spark, [("A", str(day("2025-01-01").fromordinal(start + k)), float(k)) for k in range(60)])
    refresh_touched(data, cfg.raw, cfg.location("raw", "market_data"))
    first = block_number(day("2025-01-31"), 10)
    touched = refresh_blocks(spark, cfg, data)
    assert min(touched) == first
    assert {r[BLOCK] for r in in_parts(spark, cfg.blocks).collect()} == set(touched)
    kept = closes(spark, [("A", str(d), float(d.toordinal() - start)) for d in
                          (day("2025-01-01").fromordinal(start + k) for k in range(60))
                          if d >= block_span(first, 10)[0]])
    assert numbers(models(merge_blocks(in_parts(spark, cfg.blocks))))["A"] == pytest.approx(
        numbers(models(fit(kept, keyed=True)))["A"])


def test_ingest_of_named_symbols_opens_their_files_only(spark, tmp_path):
    from marketbars.sources import write_delivery

    path = str(tmp_path / "delivered")
    incoming = price_delivery(spark, range(20), tuple(f"s{k:02d}" for k in range(40)))
    incoming = incoming.select("symbol", "Date", "Open", "High", "Low", "Close", "Volume")
    assert write_delivery(incoming.repartitionByRange(8, "symbol"), path, "csv") == 8
    cfg = settings(tmp_path, "n1", symbols=("S03", "S38"))
    found = daily.read_delivery(spark, path, cfg, "csv")
    assert len(found.inputFiles()) == 2
    assert run_ingest(spark, found, cfg)["total_rows"] == 40
    assert len(daily.read_delivery(spark, path, settings(tmp_path, "n2"), "csv").inputFiles()) == 8


def test_month_numbers():
    assert month_number(day("2025-03-31")) == 202503
    assert daily._months_between(day("2024-11-30"), day("2025-02-01")) == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]


def test_the_delivery_is_scanned_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    incoming = price_delivery(spark, range(20))

    def watch(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    for k, changes in enumerate(({}, {"refresh": "full"}, {"refresh": "full", "train_days": 5})):
        cfg = settings(tmp_path, f"s{k}", **changes)
        run_ingest(spark, incoming.mapInPandas(watch, incoming.schema), cfg)
        assert seen.value == 40 * (k + 1)
        assert {tuple(r) for r in spark.table(cfg.ingest_counts).collect()} == {("A", 20, 20), ("B", 20, 20)}
