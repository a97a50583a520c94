import random

import pytest

from helpers import GOLDEN_DELIVERY, bars, delivery, plan, rows
from marketbars.operators import quality
from marketbars.operators.clean import normalize
from marketbars.operators.quality import MODEL_CHECKS, Check, distinct_report, report
from marketbars.operators.staging import history_rows

TAGGED = "k string, a string, tag string"


def tagged(spark):
    return spark.createDataFrame(
        [("x", None, "old"), ("x", "1", "new"), ("y", "1", "odd"), (None, "1", None), (None, None, "odd")],
        TAGGED)


def test_each_check(spark):
    df = tagged(spark)
    assert rows(quality.not_null(df, ["k", "a"])) == [("a", 2), ("k", 2)]
    assert rows(quality.unique(df, "k")) == [("x", 2)]
    assert rows(quality.accepted_values(df, "tag", ["old", "new"])) == [("odd", 2)]


def test_report_counts_match_the_single_checks(spark):
    checks = [Check("not_null", "a"), Check("unique", "k"), Check("unique", "a"),
              Check("accepted_values", "tag", ("old", "new"))]
    got = {(r["check"], r["column"]): (r["n_failing"], r["passed"])
           for r in quality.report(tagged(spark), checks).collect()}
    assert got == {("not_null", "a"): (2, False), ("unique", "k"): (1, False),
                   ("unique", "a"): (1, False), ("accepted_values", "tag"): (2, False)}


def test_report_of_an_empty_table_passes(spark):
    checks = [Check("not_null", "a"), Check("unique", "k")]
    empty = tagged(spark).limit(0)
    assert all(r["passed"] and r["n_failing"] == 0 for r in quality.report(empty, checks).collect())
    only_rows = quality.report(empty, checks[:1])
    assert [r["n_failing"] for r in only_rows.collect()] == [0]


def test_row_checks_share_the_scan_of_the_unique_check(spark, tmp_path):
    path = str(tmp_path / "t")
    tagged(spark).write.parquet(path)
    checks = [Check("not_null", "a"), Check("not_null", "k"), Check("unique", "k")]
    assert plan(quality.report(spark.read.parquet(path), checks)).count("FileScan") == 1


def test_duplicates_raise_with_their_keys(spark):
    stage = normalize(delivery(spark, GOLDEN_DELIVERY))
    with pytest.raises(quality.QualityError, match=r"AAPL\|2025-01-02 -> 2 rows"):
        quality.raise_on_duplicates(stage)
    quality.raise_on_duplicates(bars(spark, [("A", "2025-01-01", *[1.0] * 4, 1)]))


def test_unknown_row_check(spark):
    with pytest.raises(ValueError):
        Check("unique", "k").fails()


def test_report_of_distinct_rows_without_making_them(spark):
    rng = random.Random(8)
    nan = float("nan")
    checks = MODEL_CHECKS["stg_market_data"]
    for _ in range(6):
        data = [(rng.choice(["A", "B", None]), rng.choice(["2025-01-01", "2025-01-02", None]),
                 *[rng.choice([None, 1.0, 0.0, -0.0, nan]) for _ in range(4)], rng.choice([None, 5]))
                for _ in range(rng.choice([0, 3, 12, 60]))]
        staged = history_rows(bars(spark, data).where("true"))
        # Rows without a date never reach the staging; here they must be counted.
        whole = bars(spark, data).selectExpr("symbol", "date", "open", "volume",
                                             "concat(symbol, '|', cast(date as string)) AS pk_symbol_date")
        for frame in (staged, whole):
            frame = frame.unionByName(frame)
            assert rows(distinct_report(frame, checks)) == rows(report(frame.distinct(), checks))


def test_distinct_report_takes_one_exchange_on_the_key(spark, tmp_path):
    bars(spark, [("A", "2025-01-01", 1.0, 1.0, 1.0, 1.0, 1)]).write.parquet(str(tmp_path / "raw"))
    staged = history_rows(spark.read.parquet(str(tmp_path / "raw")))
    text = plan(distinct_report(staged, MODEL_CHECKS["stg_market_data"]))
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text
    with pytest.raises(ValueError, match="parts"):
        distinct_report(staged, [Check("unique", "pk_symbol_date"), Check("not_null", "close")])
