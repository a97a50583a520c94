"""Properties over generated tables (few examples each: every one runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import bars, moment, predictions, rows
from marketbars.operators import forecast as fc
from marketbars.operators import quality, snapshot
from marketbars.operators.dedup import duplicate_key_count, keep_one
from marketbars.operators.mart import final_union
from marketbars.operators.staging import history_rows
from marketbars.plans.daily import mart_from

few = settings(max_examples=6, deadline=None, derandomize=True,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

symbols = st.sampled_from(["A", "B", "C"])
days = st.integers(0, 9).map(lambda i: (dt.date(2025, 1, 1) + dt.timedelta(days=i)).isoformat())
price = st.one_of(st.none(), st.integers(1, 4).map(float))
volume = st.integers(1, 2)
bar = st.tuples(symbols, days, price, price, price, price, volume)
stage = st.lists(bar, min_size=1, max_size=25)
ahead = st.lists(
    st.tuples(symbols, days.map(lambda d: d + "T00:00:00"), price, price, price), max_size=10)


@few
@given(stage)
def test_dedup_keeps_one_row_per_key_and_repeats_to_the_same(spark, data):
    once = keep_one(bars(spark, data))
    assert duplicate_key_count(once).first()["dupes"] == 0
    assert {r[:2] for r in rows(once)} == {r[:2] for r in rows(bars(spark, data))}
    assert set(rows(once)) <= set(rows(bars(spark, data)))
    assert rows(keep_one(once)) == rows(once) == rows(keep_one(bars(spark, data[::-1])))


@few
@given(stage, ahead)
def test_mart_holds_every_historical_key_and_history_wins(spark, data, ahead):
    raw = bars(spark, data)
    mart = mart_from(raw, final_union(raw, predictions(spark, ahead))).collect()
    by_key = {r["pk_symbol_date"]: r for r in mart}
    assert len(by_key) == len(mart)
    past = {r["pk_symbol_date"] for r in history_rows(raw).collect()}
    coming = {f"{s}|{t[:10]}" for s, t, *_ in ahead}
    assert set(by_key) == past | coming
    assert all(by_key[k]["record_type"] == "historical" for k in past)
    assert all(by_key[k]["record_type"] == "forecast" for k in coming - past)


@few
@given(stage, stage, stage)
def test_snapshot_invariants(spark, one, two, three):
    t = [moment(f"2025-02-0{i}") for i in (1, 2, 3, 4)]
    sources = [keep_one(bars(spark, d)) for d in (one, two, three)]
    history = snapshot.initial(sources[0], t[0])
    for source, at in zip(sources[1:], t[1:]):
        history = spark.createDataFrame(snapshot.apply(history, source, at).collect(), history.schema)
    open_keys = rows(snapshot.open_part(history).select("symbol", "date"))
    every_key = {r[:2] for d in sources for r in rows(d)}
    assert len(open_keys) == len(set(open_keys)) and set(open_keys) == every_key
    for r in history.collect():
        assert r["valid_to"] is None or r["valid_from"] < r["valid_to"]
    latest = {r[:2]: (r[3], r[6]) for r in rows(sources[-1])}
    shown = {r[:2]: (r[3], r[6]) for r in rows(snapshot.open_part(history).select(*sources[0].columns))}
    assert all(shown[k] == v for k, v in latest.items())
    assert rows(snapshot.apply(history, sources[-1], t[3])) == rows(history)


@few
@given(st.lists(st.integers(1, 50).map(float), min_size=9, max_size=20))
def test_bounds_enclose_the_forecast_and_widen(spark, values):
    data = [("A", (dt.date(2025, 1, 1) + dt.timedelta(days=i)).isoformat(), v, v, v, v, 1)
            for i, v in enumerate(values)]
    for method in ("trend", "drift", "seasonal_naive", "holt"):
        got = fc.forecast(bars(spark, data), method).orderBy("ts").collect()
        assert len(got) == 7
        width = [r["upper_bound"] - r["lower_bound"] for r in got]
        for r in got:
            assert r["lower_bound"] <= r["forecast"] <= r["upper_bound"]
        assert all(b >= a - 1e-9 for a, b in zip(width, width[1:]))


@few
@given(stage)
def test_report_equals_a_count_by_hand(spark, data):
    staged = history_rows(bars(spark, data))
    keys = [r["pk_symbol_date"] for r in staged.collect()]
    got = quality.report(staged, quality.MODEL_CHECKS["stg_market_data"]).collect()
    assert {r["check"]: r["n_failing"] for r in got if r["check"] == "unique"} == {
        "unique": sum(keys.count(k) > 1 for k in set(keys))}
