import pytest
from pyspark.sql import functions as F

from helpers import GOLDEN_DELIVERY, GOLDEN_RAW, bars, closes, day, delivery, moment, plan, rows
from marketbars.operators.clean import normalize
from marketbars.settings import Settings, parse_symbols
from marketbars.sources import (
    daily_bars,
    flatten_symbol,
    in_universe,
    lookback,
    missing_symbols,
    read_bars,
    universe,
    wide_to_long,
)

TICKS = [
    ("A", "2025-01-01T09:00:00", 10.0, 1), ("A", "2025-01-01T12:00:00", 8.0, 2),
    ("A", "2025-01-01T17:00:00", 9.0, 3), ("A", "2025-01-02T00:00:00", 7.0, 4),
    ("B", "2025-01-01T10:00:00", 5.0, 5),
]


def ticks(spark, data=TICKS):
    return spark.createDataFrame([(s, moment(t), p, q) for s, t, p, q in data],
                                 "symbol string, ts timestamp_ntz, price double, seq bigint")


def test_daily_bars(spark):
    assert rows(daily_bars(ticks(spark))) == [
        ("A", day("2025-01-01"), 10.0, 9.0, 8.0, 10.0, 3),
        ("A", day("2025-01-02"), 7.0, 7.0, 7.0, 7.0, 1),
        ("B", day("2025-01-01"), 5.0, 5.0, 5.0, 5.0, 1),
    ]


def test_daily_bars_break_equal_times_by_sequence(spark):
    same = [("A", "2025-01-01T09:00:00", float(p), q) for p, q in ((3, 2), (1, 3), (2, 1))]
    for data in (same, same[::-1]):
        got = daily_bars(ticks(spark, data), sequence="seq").first()
        assert (got["open"], got["close"]) == (2.0, 1.0)


def test_daily_bars_volume_and_symbol_expression(spark):
    got = daily_bars(ticks(spark), F.lower("symbol"), volume=F.sum("seq"))
    assert {(r["symbol"], r["volume"]) for r in got.collect()} == {("a", 6), ("a", 4), ("b", 5)}


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv", "json"])
def test_read_back_every_format(spark, tmp_path, file_format):
    path = str(tmp_path / "bars")
    if file_format in ("csv", "json"):
        source = delivery(spark, GOLDEN_DELIVERY)
        source = source.select("symbol", "Date", "Open", "High", "Low", "Close", "Volume")
        source.write.option("header", True).format(file_format).save(path)
        got, want = normalize(read_bars(spark, path, file_format)), normalize(source)
    else:
        want = bars(spark, GOLDEN_RAW)
        want.write.format(file_format).save(path)
        got = read_bars(spark, path, file_format)
    assert rows(got) == rows(want)


def test_read_several_paths_in_one_scan(spark, tmp_path):
    paths = []
    for row in GOLDEN_RAW:
        paths.append(str(tmp_path / f"p{len(paths)}"))
        bars(spark, [row]).write.parquet(paths[-1])
    got = read_bars(spark, paths)
    assert got.count() == 3 and plan(got).count("FileScan") == 1


def test_lookback_ends_per_symbol_or_at_a_date(spark, tmp_path):
    data = [("A", f"2025-01-{d:02d}", float(d)) for d in range(1, 11)]
    data += [("OLD", f"2024-06-{d:02d}", float(d)) for d in range(1, 6)]
    df = closes(spark, data)
    got = {(r["symbol"], r["date"].day) for r in lookback(df, 3).collect()}
    assert got == {("A", 8), ("A", 9), ("A", 10), ("OLD", 3), ("OLD", 4), ("OLD", 5)}
    at = lookback(df, 3, as_of=day("2025-01-05")).collect()
    assert {(r["symbol"], r["date"].day) for r in at} == {("A", 3), ("A", 4), ("A", 5)}
    with pytest.raises(ValueError):
        lookback(df, 0)


def test_lookback_and_universe_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    bars(spark, GOLDEN_RAW).write.parquet(path)
    text = plan(in_universe(lookback(read_bars(spark, path), 5, as_of=day("2025-01-05")), "aapl,nvda"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThan(date" in pushed and "In(symbol" in pushed
    assert "Exchange" not in text


def test_universe_golden(spark):
    assert parse_symbols(" aapl, NVDA ,,") == ("AAPL", "NVDA")
    with pytest.raises(ValueError, match="names no symbol"):
        parse_symbols(" , ")
    lists = spark.createDataFrame([(" aapl, NVDA ,,",), ("nvda",), (" , ",)], "symbols string")
    assert rows(universe(lists)) == [("AAPL",), ("NVDA",)]


def test_universe_as_list_and_as_table_agree(spark):
    df = bars(spark, GOLDEN_RAW)
    table = spark.createDataFrame([("NVDA",), ("MSFT",)], "symbol string")
    assert rows(in_universe(df, " nvda, msft")) == rows(in_universe(df, table))
    assert rows(missing_symbols(spark, df, ["nvda", "msft"])) == [("MSFT",)]
    assert rows(missing_symbols(spark, df, table)) == [("MSFT",)]


def wide(spark):
    return spark.createDataFrame(
        [("2025-01-01", 1.0, 2.0, None), ("2025-01-02", None, None, 5.0)],
        "Date string, `Close|AAPL` double, `Open|AAPL` double, `Close|BRK.B` double")


def test_wide_to_long_keeps_every_date_and_symbol(spark):
    got = wide_to_long(wide(spark))
    assert got.columns == ["Date", "symbol", "Close", "Open"]
    assert rows(got) == [
        ("2025-01-01", "AAPL", 1.0, 2.0), ("2025-01-01", "BRK.B", None, None),
        ("2025-01-02", "AAPL", None, None), ("2025-01-02", "BRK.B", 5.0, None),
    ]
    assert "Exchange" not in plan(got)
    assert wide_to_long(wide(spark), drop_empty=True).count() == 2
    with pytest.raises(ValueError):
        wide_to_long(wide(spark).select("Date"))


def test_flatten_one_symbol_or_drop_the_level(spark):
    one = flatten_symbol(wide(spark), "BRK.B")
    assert one.columns == ["Date", "Close"]
    other = flatten_symbol(wide(spark).drop("Close|BRK.B"), "MSFT")
    assert other.columns == ["Date", "Close", "Open"]


def test_settings(monkeypatch):
    monkeypatch.setenv("MARKETBARS_DATABASE", "desk")
    cfg = Settings(base_path="/data/")
    assert cfg.raw == "`spark_catalog`.`desk_raw`.`market_data`"
    assert cfg.location("raw", "market_data") == "/data/desk_raw/market_data"
    assert (cfg.train_days, cfg.horizon, cfg.level) == (180, 7, 0.95)
    with pytest.raises(AttributeError):
        cfg.horizon = 3


def test_lookback_is_lazy_and_days_may_be_left_out(spark):
    df = closes(spark, [("A", "2025-01-01", 1.0), ("A", "2025-03-01", 1.0)])
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    kept = lookback(df, 10)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert kept.count() == 1 and lookback(df, None).count() == 2
    assert lookback(df, None, day("2025-01-15")).count() == 1


def test_tied_ticks_follow_their_sequence(spark):
    ticks = spark.createDataFrame(
        [("A", "2025-01-01 10:00:00", n, float(p)) for n, p in ((3, 30), (1, 10), (2, 20))],
        "symbol string, ts string, n long, price double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    row = daily_bars(ticks, sequence="n").first()
    assert (row["open"], row["close"]) == (10.0, 30.0)


def test_ticks_by_a_ranged_sequence_hash_and_order_as_a_struct_does(spark, tmp_path):
    """Packed order equals the order of (time, sequence), a null sequence first, for both kinds of time."""
    times = ["1960-02-03 04:05:06.000007", "1960-02-03 04:05:06.000008", "1970-01-01 00:00:00",
             "1970-01-01 00:00:00.000001", "2025-03-30 02:30:00", "2025-03-30 23:59:59.999999", "9999-12-31 12:00:00"]
    low, high = -5, (1 << 26) - 7
    for kind in ("timestamp_ntz", "timestamp"):
        for number in ("long", "int"):
            data = [("A", t, q, float(i)) for i, (t, q) in enumerate((t, q) for t in times for q in [1, None, low, 0, high])]
            frame = spark.createDataFrame(data, f"symbol string, ts string, seq {number}, price double")
            frame = frame.withColumn("ts", F.col("ts").cast(kind))
            frame.write.mode("overwrite").parquet(str(tmp_path / "ticks"))
            frame = spark.read.parquet(str(tmp_path / "ticks"))
            got = daily_bars(frame, sequence="seq", sequence_range=(low, high))
            assert "HashAggregate" in plan(got) and "SortAggregate" not in plan(got)
            want = daily_bars(frame, sequence="seq")
            assert "SortAggregate" in plan(want) and rows(got) == rows(want)
            wide = daily_bars(frame, sequence="seq", sequence_range=(-(1 << 63), (1 << 63) - 1))
            assert rows(wide) == rows(want)
            with pytest.raises(Exception, match="sequence outside"):
                daily_bars(frame, sequence="seq", sequence_range=(0, high)).collect()


def test_a_sequence_of_text_still_orders(spark):
    frame = spark.createDataFrame([("A", moment("2025-01-01T09:00:00"), float(p), q) for p, q in ((3, "b"), (1, "c"), (2, "a"))],
                                  "symbol string, ts timestamp_ntz, price double, seq string")
    got = daily_bars(frame, sequence="seq").first()
    assert (got["open"], got["close"]) == (2.0, 1.0)


def test_wide_frames_of_thousands_of_symbols(spark):
    import time

    names = [f"S{k}" for k in range(5000)]
    fields = ("Open", "High", "Low", "Close", "Adj", "Volume")
    columns = ", ".join(f"CAST({k % 97} + id AS DOUBLE) AS `{f}|{s}`" for f in fields for k, s in enumerate(names))
    frame = spark.sql(f"SELECT CAST(id AS STRING) AS Date, {columns} FROM range(2)")
    start = time.time()
    long = wide_to_long(frame)
    planned = plan(long)
    assert time.time() - start < 60 and "Exchange" not in planned
    got = long.where("symbol IN ('S0', 'S4999')").collect()
    assert {(r["Date"], r["symbol"], r["Open"], r["Volume"]) for r in got} == {
        (str(d), s, float(k % 97 + d), float(k % 97 + d)) for d in (0, 1) for s, k in (("S0", 0), ("S4999", 4999))}
    assert long.count() == 10_000


def test_named_symbols_open_only_files_that_may_hold_them(spark, tmp_path):
    from marketbars.sources import index_files, read_named, write_delivery

    path = str(tmp_path / "delivered here")
    data = bars(spark, [(f"s{k:03d} ", "2025-01-01", 1.0, float(k), 1.0, 1.0, 1) for k in range(400)])
    assert write_delivery(data.repartitionByRange(16, "symbol"), path) == 16
    named = read_named(spark, path, "S005, s390,none")
    assert {r["symbol"] for r in named.collect()} == {"s005 ", "s390 "}
    assert len(named.inputFiles()) == 2
    # A file that was added without an entry is read until it is indexed.
    bars(spark, [("S005", "2025-01-02", 1.0, 7.0, 1.0, 1.0, 1)]).coalesce(1).write.mode("append").parquet(path)
    assert len(read_named(spark, path, ["s390"]).inputFiles()) == 2
    assert read_named(spark, path, ["s005"]).count() == 2
    assert index_files(spark, path) == 1 and index_files(spark, path) == 0
    assert len(read_named(spark, path, ["s390"]).inputFiles()) == 1
    nothing = read_named(spark, path, ["zzz"])
    assert nothing.count() == 0 and nothing.columns == data.columns


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_named_symbols_of_every_format(spark, tmp_path, file_format):
    import random

    from marketbars.sources import read_named, write_delivery

    rng = random.Random(4)
    source = delivery(spark, [("2025-01-01", f" {rng.choice('aBcDe')}{rng.randrange(300)}", "1", "1", "1", "1", "1")
                              for _ in range(2000)] + [("2025-01-01", None, "1", "1", "1", "1", "1")])
    source = source.select("symbol", "Date", "Open", "High", "Low", "Close", "Volume").repartition(9)
    path = str(tmp_path / "d")
    # Small filters answer falsely often, and lose nothing.
    write_delivery(source, path, file_format, bits=128)
    schema = source.schema
    for names in (["A1", "e299"], ["B7"], ["nobody"]):
        got = read_named(spark, path, names, file_format, schema)
        want = source.where(F.upper(F.trim("symbol")).isin([n.upper() for n in names]))
        # Text files are written without leading blanks.
        assert rows(got.withColumn("symbol", F.trim("symbol"))) == rows(want.withColumn("symbol", F.trim("symbol")))
