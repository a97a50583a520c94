import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import GOLDEN_DELIVERY, GOLDEN_RAW, bars, day, delivery, rows
from marketbars.functions import add_steps, coerce_number, coerce_volume, strip_quotes, symbol_key
from marketbars.operators.clean import clean_counts, normalize, typed_bars
from marketbars.operators.dedup import (
    duplicate_key_count,
    duplicate_keys,
    duplicate_sample,
    keep_one,
    row_stats,
)
from marketbars.schema import BARS, SchemaContractError, conform, require_columns


def test_normalize_and_dedup_golden(spark):
    got = keep_one(normalize(delivery(spark, GOLDEN_DELIVERY)))
    assert rows(got) == rows(bars(spark, GOLDEN_RAW))
    assert got.schema == BARS


def test_counts_duplicates_and_stats_golden(spark):
    incoming = delivery(spark, GOLDEN_DELIVERY)
    assert rows(clean_counts(incoming)) == [("AAPL", 3, 2), ("NVDA", 2, 1)]
    stage = normalize(incoming)
    assert duplicate_key_count(stage).first()["dupes"] == 1
    assert [r["line"] for r in duplicate_sample(stage).collect()] == ["AAPL|2025-01-02 -> 2 rows"]
    once = keep_one(stage)
    assert duplicate_key_count(once).first()["dupes"] == 0
    assert tuple(row_stats(once).first()) == (3, 3)


def test_row_stats_ignores_incomplete_keys_and_handles_no_rows(spark):
    df = bars(spark, [("A", "2025-01-01", *[1.0] * 4, 1), (None, "2025-01-01", *[1.0] * 4, 1),
                      ("A", None, *[1.0] * 4, 1)])
    assert tuple(row_stats(df).first()) == (3, 1)
    assert tuple(row_stats(df.limit(0)).first()) == (0, 0)


def test_duplicate_sample_orders_and_limits(spark):
    data = [(f"S{i:02d}", "2025-01-01", 1.0, 1.0, 1.0, 1.0, k) for i in range(12) for k in range(2)]
    data += [("S11", "2025-01-01", 1.0, 1.0, 1.0, 1.0, 9)]
    got = duplicate_sample(bars(spark, data)).collect()
    assert [r["symbol"] for r in got] == ["S11"] + [f"S{i:02d}" for i in range(9)]
    assert got[0]["c"] == 3
    assert duplicate_keys(bars(spark, data)).count() == 12


@pytest.mark.parametrize("text, number", [
    ("12.5", 12.5), (" 12 ", 12.0), ("1e3", 1000.0), ("-3", -3.0), ("n/a", None), ("", None),
    ("NaN", None), ("1d", None), ("2.5f", None), ("3D ", None), (None, None), ("inf", float("inf")),
    ("-Infinity", float("-inf")), ("Null", None), ("\t7", 7.0), (" inf", float("inf")), ("_1", None),
    (".5", 0.5), ("+4", 4.0), ("-", None), ("4 d", None), ("d", None), ("1e3f", None), ("12%", None),
])
def test_number_coercion(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(coerce_number(F.col("v"))).first()[0] == number


def test_volume_is_whole(spark):
    df = spark.createDataFrame([("2.5",), ("1e30",), ("x",), ("7",), ("-2.5",), ("1e9",), (" 8 ",),
                                ("inf",), ("n/a",), ("9d",), (None,), ("1e40",)], "v string")
    got = [r[0] for r in df.select(coerce_volume(F.col("v"))).collect()]
    assert got == [3, None, None, 7, -3, 10**9, 8, None, None, None, None, None]


def test_typed_input_needs_no_text(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2025, 1, 2, 9, 30), 1, 2.5, float("nan"), 3.0, 7.6)],
        "symbol string, Date timestamp_ntz, Open int, High double, Low double, Close float, Volume double",
    )
    assert tuple(typed_bars(df).first()) == ("A", day("2025-01-02"), 1.0, 3.0, None, 2.5, 8)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_date_fails_whatever_the_ansi_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        bad = delivery(spark, [("soon", "A", "1", "1", "1", "1", "1")])
        with pytest.raises(Exception, match="not a date: soon"):
            normalize(bad).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_date_text_may_carry_a_time(spark):
    got = normalize(delivery(spark, [("2025-01-02 09:30:00", "A", "1", "1", "1", "1", "1")]))
    assert got.first()["date"] == day("2025-01-02")


def test_contract_names_every_missing_column(spark):
    df = delivery(spark, GOLDEN_DELIVERY)
    with pytest.raises(SchemaContractError, match=r"\['Low', 'Volume'\]"):
        require_columns(df.drop("Low", "Volume"))
    assert require_columns(df.select(*reversed(df.columns))) is not None
    shuffled = normalize(df.select(*reversed(df.columns)))
    assert rows(shuffled) == rows(normalize(df))


def test_conform_orders_and_types(spark):
    df = bars(spark, GOLDEN_RAW).select("volume", "date", "symbol", "open", "close", "low", "high")
    assert conform(df, BARS).schema == BARS


def test_survivor_does_not_depend_on_row_order(spark):
    data = [("A", "2025-01-01", o, c, 1.0, 1.0, 1) for o in (3.0, 1.0, 2.0) for c in (None, 5.0)]
    for order in (data, data[::-1]):
        kept = keep_one(bars(spark, order).repartition(3)).collect()
        assert len(kept) == 1 and (kept[0]["open"], kept[0]["close"]) == (1.0, 5.0)


def test_survivor_by_given_order(spark):
    df = bars(spark, [("A", "2025-01-01", *[1.0] * 4, v) for v in (1, 3, 2)])
    assert keep_one(df, order=[F.desc("volume")]).first()["volume"] == 3
    keys_only = df.select("symbol", "date")
    assert keep_one(keys_only).count() == 1


def test_keys(spark):
    df = spark.createDataFrame([("A", day("2025-01-02")), (None, day("2025-01-02")), ("A", None)],
                               "symbol string, date date")
    got = [r[0] for r in df.select(symbol_key(F.col("symbol"), F.col("date"))).collect()]
    assert got == ["A|2025-01-02", None, None]
    quoted = spark.createDataFrame([('"A"',), ("B",)], "s string")
    assert [r[0] for r in quoted.select(strip_quotes(F.col("s"))).collect()] == ["A", "B"]


def test_weekday_steps_match_a_calendar_walk(spark):
    start = [day("2025-01-01") + dt.timedelta(days=i) for i in range(9)]
    df = spark.createDataFrame([(d,) for d in start], "d date").select(
        "d", F.explode(F.sequence(F.lit(1), F.lit(23))).alias("k"))
    got = df.select("d", "k", add_steps(F.col("d"), F.col("k"), "weekday").alias("t")).collect()
    for d, k, t in got:
        walk, left = d, k
        while left:
            walk += dt.timedelta(days=1)
            left -= walk.weekday() < 5
        assert t == walk, (d, k)
    with pytest.raises(ValueError):
        add_steps(F.col("d"), F.col("k"), "lunar")


def test_text_schema_covers_the_contract():
    from marketbars.schema import BARS_TEXT, REQUIRED_FIELDS
    assert set(REQUIRED_FIELDS) <= set(BARS_TEXT.names)
    assert all(isinstance(f.dataType, T.StringType) for f in BARS_TEXT)
