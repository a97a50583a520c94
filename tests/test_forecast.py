import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import closes, day, exchanges, plan, rows
from marketbars.operators import forecast as fc

Z = 1.959963984540054
CURVE = [10.0, 12.0, 11.5, 14.0, 13.0, 16.5, 15.0, 18.0, 17.2, 19.9, 18.8, 22.0]


def series(spark, values, symbol="A", start=1):
    return closes(spark, [(symbol, f"2025-01-{start + i:02d}", v) for i, v in enumerate(values)])


def by_step(df):
    return [tuple(r) for r in df.orderBy("ts").select("forecast", "lower_bound", "upper_bound").collect()]


def test_trend_golden(spark):
    df = series(spark, [10.0, 12.0, 13.0, 15.0]).unionAll(series(spark, [1.0, 2.0], "B"))
    model = fc.fit(df)
    row = model.where("series = 'A'").first()
    assert (row["n_obs"], row["slope"], row["intercept"]) == (4, pytest.approx(1.6), pytest.approx(8.5))
    assert row["sigma"] ** 2 == pytest.approx(0.1)
    ahead = fc.predict(model).orderBy("ts").collect()
    assert len(ahead) == 7 and ahead[0]["ts"].isoformat() == "2025-01-05T00:00:00"
    assert ahead[0]["forecast"] == pytest.approx(16.5)
    assert ahead[0]["lower_bound"] == pytest.approx(15.520018, abs=1e-6)
    assert ahead[0]["upper_bound"] == pytest.approx(17.479982, abs=1e-6)
    assert rows(fc.skipped(model)) == [("B", 2, fc.TOO_FEW)]


def test_drift_against_the_formula(spark):
    y = np.array(CURVE)
    n, drift = len(y), (y[-1] - y[0]) / (len(y) - 1)
    sigma = math.sqrt(((np.diff(y) - drift) ** 2).sum() / (n - 2))
    got = by_step(fc.forecast(series(spark, CURVE), "drift"))
    for h, (f, lo, hi) in enumerate(got, 1):
        half = Z * sigma * math.sqrt(h * (1 + h / (n - 1)))
        assert (f, lo, hi) == pytest.approx((y[-1] + h * drift, y[-1] + h * drift - half, y[-1] + h * drift + half))


def test_seasonal_naive_against_the_formula(spark):
    m, y = 3, np.array(CURVE)
    sigma = math.sqrt(((y[m:] - y[:-m]) ** 2).mean())
    got = by_step(fc.forecast(series(spark, CURVE), "seasonal_naive", season=m))
    for h, (f, lo, hi) in enumerate(got, 1):
        half = Z * sigma * math.sqrt((h - 1) // m + 1)
        assert f == y[len(y) - m + (h - 1) % m]
        assert (lo, hi) == pytest.approx((f - half, f + half))


def holt_by_hand(y, horizon=7):
    best = None
    for a in fc.HOLT_WEIGHTS:
        for b in fc.HOLT_WEIGHTS:
            level, trend, sse = y[1], y[1] - y[0], 0.0
            for v in y[2:]:
                e = v - (level + trend)
                level, trend = level + trend + a * e, trend + a * b * e
                sse += e * e
            if best is None or sse < best[0]:
                best = (sse, a, a * b, level, trend)
    sse, a, b, level, trend = best
    s2 = sse / (len(y) - 2)
    out = []
    for h in range(1, horizon + 1):
        half = Z * math.sqrt(s2 * (1 + (h - 1) * (a * a + a * b * h + b * b * h * (2 * h - 1) / 6)))
        f = level + h * trend
        out.append((f, f - half, f + half))
    return out


def test_holt_against_a_loop_for_series_of_unequal_length(spark):
    parts = {"A": CURVE, "B": CURVE[:5], "C": CURVE[::-1][:9], "D": CURVE[:4], "E": CURVE[:3], "F": CURVE[:1]}
    df = None
    for name, values in parts.items():
        one = series(spark, values, name)
        df = one if df is None else df.unionAll(one)
    got = fc.forecast(df, "holt")
    assert {r[0] for r in got.select("series").distinct().collect()} == {"A", "B", "C", "D"}
    for name in "ABCD":
        want = holt_by_hand(parts[name])
        for a, b in zip(by_step(got.where(F.col("series") == name)), want, strict=True):
            assert a == pytest.approx(b)


def test_nulls_and_nan_are_not_trained_on_but_end_the_series(spark):
    plain = series(spark, [10.0, 12.0, 13.0, 15.0])
    holes = closes(spark, [("A", "2025-01-01", 10.0), ("A", "2025-01-02", 12.0), ("A", "2025-01-03", None),
                           ("A", "2025-01-04", 13.0), ("A", "2025-01-05", float("nan")),
                           ("A", "2025-01-06", 15.0), ("A", "2025-01-07", None)])
    for method in ("trend", "drift", "holt"):
        a, b = fc.forecast(plain, method), fc.forecast(holes, method)
        assert by_step(a) == by_step(b)
    first = fc.forecast(holes).orderBy("ts").first()
    assert first["ts"].date() == day("2025-01-08")


def test_reasons(spark):
    data = [("DUP", f"2025-01-0{d}", float(d)) for d in (1, 2, 3, 3)]
    data += [("ONE", "2025-01-01", float(v)) for v in range(5)]
    data += [("NULL", f"2025-01-0{d}", None) for d in (1, 2, 3)]
    data += [("OK", f"2025-01-0{d}", float(d)) for d in (1, 2, 3)]
    model = fc.fit(closes(spark, data))
    reasons = {r["series"]: r["reason"] for r in fc.skipped(model).collect()}
    assert reasons == {"DUP": fc.REPEATED, "ONE": fc.ONE_DATE, "NULL": fc.TOO_FEW}
    assert {r[0] for r in fc.predict(model).select("series").distinct().collect()} == {"OK"}
    more = fc.fit(closes(spark, data), min_obs=4)
    assert {r["series"] for r in fc.skipped(more).collect()} == {"DUP", "ONE", "NULL", "OK"}


@pytest.mark.parametrize("method", ["trend", "drift", "seasonal_naive", "holt"])
def test_constant_series_has_a_band_of_zero_width(spark, method):
    got = by_step(fc.forecast(series(spark, [5.0] * 12), method))
    assert len(got) == 7
    for f, lo, hi in got:
        assert (f, lo, hi) == pytest.approx((5.0, 5.0, 5.0), abs=1e-9)


def test_horizon_level_and_calendar(spark):
    df = series(spark, CURVE[:10])  # ends on Friday 2025-01-10
    got = fc.forecast(df, horizon=3, level=0.5, calendar="weekday").orderBy("ts").collect()
    assert [r["ts"].date() for r in got] == [day("2025-01-13"), day("2025-01-14"), day("2025-01-15")]
    wide = fc.forecast(df, horizon=3).orderBy("ts").first()
    assert wide["upper_bound"] - wide["forecast"] > got[0]["upper_bound"] - got[0]["forecast"]
    for bad in (dict(horizon=0), dict(level=1.0), dict(method="magic")):
        with pytest.raises(ValueError):
            fc.forecast(df, **bad)


@pytest.mark.parametrize("method", ["trend", "drift", "seasonal_naive", "holt"])
def test_backtest_matches_a_fit_on_the_shortened_series(spark, method):
    h, options = 3, {"season": 3} if method == "seasonal_naive" else {}
    ahead = by_step(fc.forecast(series(spark, CURVE[:-h]), method, horizon=h, **options))
    got = fc.backtest(series(spark, CURVE), method, horizon=h, **options).first()
    y = np.array(CURVE[-h:])
    f, lo, hi = (np.array(v) for v in zip(*ahead))
    e = y - f
    assert got["n"] == h
    assert got["mae"] == pytest.approx(abs(e).mean())
    assert got["mse"] == pytest.approx((e**2).mean())
    assert got["rmse"] == pytest.approx(math.sqrt((e**2).mean()))
    assert got["mape"] == pytest.approx(abs(e / y).mean())
    assert got["smape"] == pytest.approx((2 * abs(e) / (abs(y) + abs(f))).mean())
    assert got["coverage"] == pytest.approx(((lo <= y) & (y <= hi)).mean())


def test_backtest_leaves_out_divisions_by_zero(spark):
    got = fc.backtest(series(spark, [0.0] * 8), horizon=2).first()
    assert (got["mae"], got["mape"], got["smape"]) == (0.0, None, None)


def test_fit_shuffles_once_on_the_series(spark, tmp_path):
    """From a raw table: the per-day combine and the series. After a step that is
    already keyed by symbol and day: only the series."""
    path = str(tmp_path / "raw")
    series(spark, CURVE).write.parquet(path)
    stored = spark.read.parquet(path)
    assert exchanges(fc.forecast(stored)) == 2
    assert exchanges(fc.forecast(stored, keyed=True)) == 1
    from marketbars.operators.dedup import keep_one
    assert exchanges(fc.forecast(keep_one(stored))) == 2
    assert exchanges(fc.backtest(stored)) == 2


def test_keyed_gives_the_same_on_one_row_per_day(spark):
    df = series(spark, CURVE).unionAll(series(spark, [1.0, None, 3.0], "B"))
    for method in ("trend", "seasonal_naive"):
        assert rows(fc.fit(df, method)) == rows(fc.fit(df, method, keyed=True))


def test_only_holt_uses_python(spark):
    df = series(spark, CURVE)
    for method in ("trend", "drift", "seasonal_naive"):
        text = plan(fc.forecast(df, method)) + plan(fc.backtest(df, method))
        assert "Python" not in text and "Arrow" not in text
    assert "ArrowEvalPython" in plan(fc.forecast(df, "holt"))


def test_any_series_names(spark):
    df = series(spark, CURVE).select(F.col("symbol").alias("name"), F.col("date").cast("timestamp_ntz").alias("at"),
                                     F.col("close").cast("int").alias("v"))
    assert fc.forecast(df, series="name", ts="at", target="v").count() == 7


@pytest.mark.parametrize("method", ["trend", "drift", "seasonal_naive", "holt"])
def test_model_and_evaluation_come_from_one_pass(spark, method, tmp_path):
    rng = random.Random(5)
    data = closes(spark, [(s, f"2025-{1 + k // 28:02d}-{1 + k % 28:02d}", rng.random() * 9 if rng.random() < 0.9 else None)
                          for s, n in (("A", 60), ("B", 17), ("C", 9), ("D", 2)) for k in range(n)])
    data.write.parquet(str(tmp_path / "bars"))
    data = spark.read.parquet(str(tmp_path / "bars"))
    both = fc.fits(data, method, (0, 7), keyed=True)
    assert exchanges(both) == 1
    model, held = fc.model_of(both, method), fc.model_of(both, method, 7)
    assert exchanges(fc.scores(held, method, 7)) == 1 and exchanges(fc.backtest(data, method, 7, keyed=True)) == 1

    def rounded(df):
        return rows(df.select(*[F.round(f.name, 9).alias(f.name) if f.dataType.typeName() == "double" else f.name
                                for f in df.schema if f.name not in ("best", "held_out")]))

    assert rounded(model) == rounded(fc.fit(data, method, keyed=True))
    assert rounded(held) == rounded(fc.fit(data, method, holdout=7, keyed=True))
    assert rounded(fc.scores(held, method, 7)) == rounded(fc.backtest(data, method, 7, keyed=True))
