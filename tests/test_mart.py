from helpers import (
    GOLDEN_PREDICTIONS,
    GOLDEN_RAW,
    bars,
    day,
    final,
    predictions,
    rows,
)
from marketbars.operators import quality
from marketbars.operators.mart import clean_series, final_union, mart_stock_analysis, trend_read
from marketbars.operators.staging import stg_market_data, stg_market_forecast, train_view
from marketbars.plans.daily import mart_from
import pytest


def golden(spark, extra=()):
    raw = bars(spark, GOLDEN_RAW)
    return raw, final_union(raw, predictions(spark, [*GOLDEN_PREDICTIONS, *extra]))


def test_final_union_golden(spark):
    raw, union = golden(spark)
    assert union.count() == 5
    assert union.columns == ["symbol", "date", "actual", "forecast", "lower_bound", "upper_bound"]
    assert ("AAPL", day("2025-01-04"), None, 12.5, 11.0, 14.0) in rows(union)
    assert dict(union.dtypes)["date"] == "date" and dict(union.dtypes)["actual"] == "double"


def test_null_close_reads_as_a_forecast_unless_strict(spark):
    _, union = golden(spark)
    loose, strict = stg_market_forecast(union), stg_market_forecast(union, strict=True)
    assert {r["pk_symbol_date"] for r in loose.collect()} == {
        "AAPL|2025-01-03", "AAPL|2025-01-04", "NVDA|2025-01-02"}
    assert strict.count() == 2


def test_mart_golden(spark):
    raw, union = golden(spark)
    mart = mart_stock_analysis(stg_market_data(raw), stg_market_forecast(union))
    got = {r["pk_symbol_date"]: r for r in mart.collect()}
    assert len(got) == 4 and all(r["rn"] == 1 for r in got.values())
    assert got["AAPL|2025-01-02"]["actual_price"] == 11.0
    assert got["AAPL|2025-01-03"]["record_type"] == "historical"
    assert got["AAPL|2025-01-03"]["actual_price"] == 12.0
    assert got["AAPL|2025-01-03"]["forecast_price"] is None
    ahead = got["AAPL|2025-01-04"]
    assert (ahead["record_type"], ahead["forecast_price"], ahead["lower_bound"], ahead["upper_bound"]) == (
        "forecast", 12.5, 11.0, 14.0)
    assert got["NVDA|2025-01-02"]["record_type"] == "historical"
    assert got["NVDA|2025-01-02"]["actual_price"] is None
    assert dict(mart.dtypes)["rn"] == "int"
    checks = quality.MODEL_CHECKS["mart_stock_analysis"]
    assert all(r["passed"] for r in quality.report(mart, checks, mart_rule=True).collect())


def test_mart_is_the_same_without_the_staging_distinct(spark):
    raw, union = golden(spark)
    raw, union = raw.unionAll(raw), union.unionAll(union)
    staged = mart_stock_analysis(stg_market_data(raw), stg_market_forecast(union))
    assert rows(staged) == rows(mart_from(raw, union))


def test_stage_upper_cases_and_drops_null_dates(spark):
    raw = bars(spark, [("aapl", "2025-01-02", *[1.0] * 4, 3), ("AAPL", "2025-01-02", *[1.0] * 4, 3),
                       ("AAPL", None, *[1.0] * 4, 3)])
    got = stg_market_data(raw)
    assert rows(got) == [("AAPL", day("2025-01-02"), 1.0, 1.0, 1.0, 1.0, 3.0, "AAPL|2025-01-02")]
    assert got.columns == ["symbol", "date", "open", "high", "low", "close", "volume", "pk_symbol_date"]
    assert train_view(raw).columns == ["date", "close", "symbol"]


def test_equal_rank_is_settled_by_price(spark):
    union = final(spark, [("A", "2025-01-05", None, f, 0.0, 9.0) for f in (4.0, 3.0, None)])
    raw = bars(spark, []).limit(0)
    mart = mart_stock_analysis(stg_market_data(raw), stg_market_forecast(union)).collect()
    assert [r["forecast_price"] for r in mart] == [3.0]


def test_late_forecast_is_found(spark):
    """A forecast on a day without history survives in the mart and fails the rule."""
    raw, union = golden(spark, [("AAPL", "2025-01-01T00:00:00", 9.0, 8.0, 10.0)])
    mart = mart_from(raw, union)
    late = quality.forecast_not_future(mart)
    assert rows(late) == [("AAPL", day("2025-01-01"), "forecast", 9.0, day("2025-01-03"))]
    checks = quality.MODEL_CHECKS["mart_stock_analysis"]
    result = quality.report(mart, checks, mart_rule=True)
    assert {r["check"]: r["n_failing"] for r in result.collect() if not r["passed"]} == {
        "forecast_future": 1}
    with pytest.raises(quality.QualityError, match=r"forecast_future\(date\): 1 failing"):
        quality.raise_on_failure(result, "mart")


def test_series_names_and_times_are_cleaned(spark):
    got = clean_series(predictions(spark, [('"X"', "2025-01-03T17:00:00", 1.0, 0.0, 2.0)]))
    assert rows(got) == [("X", day("2025-01-03"), 1.0, 0.0, 2.0)]


def test_trend_read_is_ordered(spark):
    raw, union = golden(spark)
    got = trend_read(mart_from(raw, union)).collect()
    keys = [(r["symbol"], r["date"]) for r in got]
    assert keys == sorted(keys) and len(keys) == 4
