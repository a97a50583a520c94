"""One key holds a third of the rows, or more: plans and results."""

import pytest
from pyspark.sql import functions as F

from helpers import plan
from marketbars.operators.clean import clean_counts
from marketbars.operators.dedup import duplicate_key_count, keep_one, row_stats
from marketbars.operators.forecast import fit, forecast
from marketbars.sources import daily_bars

N = 30_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Ticks: a third on one symbol and day, a third on one symbol, the rest spread."""
    path = str(tmp_path_factory.mktemp("hot") / "ticks")
    i = F.col("id")
    symbol = F.when(i % 3 < 2, "HOT").otherwise(F.concat(F.lit("S"), (i % 500).cast("string")))
    day = F.when(i % 3 == 0, 0).otherwise((i / 3).cast("int") % 40)
    ts = F.lit("2025-01-01").cast("timestamp_ntz") + F.make_dt_interval(day, F.lit(0), F.lit(0), i % 86400)
    (spark.range(0, N, 1, 6)
     .select("id", symbol.alias("symbol"), ts.alias("ts"), (i % 977).cast("double").alias("price"))
     .write.parquet(path))
    return spark.read.parquet(path)


def incoming(ticks):
    price = F.col("price")
    return ticks.select("symbol", F.col("ts").alias("Date"), price.alias("Open"), price.alias("High"),
                        price.alias("Low"), price.alias("Close"), F.col("id").alias("Volume"))


def stage(ticks):
    from marketbars.operators.clean import normalize
    return normalize(incoming(ticks))


def shuffled_rows(df) -> int:
    """Rows the plan's first shuffle wrote, from its own metrics."""
    df.collect()
    found = []
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for method in ("executedPlan", "plan", "child", "left", "right"):
            try:
                todo.append(getattr(node, method)())
            except Exception:
                pass
    return max(found)


def test_hot_key_is_trimmed_before_the_shuffle(spark, hot):
    df = keep_one(stage(hot))
    text = plan(df)
    partial = text.index("row_number(), 1, Partial")
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning") < partial
    keys = hot.select("symbol", F.to_date("ts")).distinct().count()
    assert df.count() == keys
    # At most one row per key and scan task crosses the shuffle.
    assert shuffled_rows(df) <= keys * hot.rdd.getNumPartitions() < N / 2


def test_resampling_combines_before_the_shuffle(spark, hot):
    df = daily_bars(hot)
    assert plan(df).count("HashAggregate") == 2 and "SortAggregate" not in plan(df)
    got = df.where("symbol = 'HOT' AND date = '2025-01-01'").first()
    assert got["volume"] > N / 3
    assert shuffled_rows(daily_bars(hot)) <= df.count() * hot.rdd.getNumPartitions() < N / 2


def test_counts_never_hold_a_symbol_in_one_task(spark, hot):
    for df in (clean_counts(incoming(hot)), row_stats(stage(hot)), duplicate_key_count(stage(hot))):
        text = plan(df)
        first = text.rindex("Exchange hashpartitioning")
        assert "partial_count" in text[first:]
    per_symbol = {r["symbol"]: r for r in clean_counts(incoming(hot)).collect()}
    assert per_symbol["HOT"]["rows_before"] == N * 2 // 3
    assert per_symbol["HOT"]["rows_after"] == 40


def test_a_series_with_repeated_days_is_reported_not_gathered(spark, hot):
    """Repeats combine map-side to one row per day before the series is ordered."""
    model = fit(hot, ts="ts", target="price")
    text = plan(model)
    by_series = text.index("Exchange hashpartitioning(series")
    assert "keys=[series" in text[by_series:] and "partial_count(value" in text[by_series:]
    row = model.where("series = 'HOT'").first()
    assert row["reason"] == "duplicate_ts"
    once = forecast(daily_bars(hot)).where("series = 'HOT'")
    assert once.count() == 7
