"""Every registered query against its SQL, and the entry point."""

import json

import pytest

import __spark_entry__ as contract
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


#: Queries of the optional subpackage have tests of their own.
OWN = [n for n in contract.queries()
       if not contract.llm or n not in {*contract.llm.queries(), "pipeline"}]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, db, name):
    good, note = check.compare(spark, db, SF, name)
    assert good, note


def test_every_query_has_sql():
    assert set(OWN) <= set(contract.oracle_sql()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "date", "actual_price", "forecast_price", "lower_bound",
                          "upper_bound", "record_type", "pk_symbol_date", "rn"]


def test_bench_prints_one_json_line(spark, capsys, monkeypatch):
    import bench
    monkeypatch.setenv("BENCH_SF_DIR", SF)
    monkeypatch.setenv("BENCH_RUNS", "1")
    monkeypatch.setattr(bench, "HEADLINE", ("daily_bars",))
    monkeypatch.setattr(bench, "TRAINING", ("clean_counts",))
    monkeypatch.setattr(bench, "local_session", lambda *_: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    bench.main()
    line = json.loads(capsys.readouterr().out)
    assert set(line) >= {"metric", "value", "unit", "queries", "sf"}
    assert line["training_data_queries"]["clean_counts"] >= 0
    assert line["sf"] == "0.001" and line["queries"]["daily_bars"] >= 0
