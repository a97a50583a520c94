"""Small literal tables and plan text."""

from __future__ import annotations

import datetime as dt

from marketbars.schema import BARS, FINAL, PREDICTIONS

DELIVERY = "Date string, symbol string, Open string, Close string, Low string, High string, Volume string"


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def delivery(spark, rows):
    return spark.createDataFrame(rows, DELIVERY)


def bars(spark, rows):
    """Rows of (symbol, date, open, close, low, high, volume)."""
    return spark.createDataFrame([(s, day(d) if d else None, *v) for s, d, *v in rows], BARS)


def closes(spark, rows):
    """Rows of (symbol, date, close) as raw bars with equal prices."""
    return bars(spark, [(s, d, c, c, c, c, 1) for s, d, c in rows])


def predictions(spark, rows):
    return spark.createDataFrame([(s, moment(t), *v) for s, t, *v in rows], PREDICTIONS)


def final(spark, rows):
    return spark.createDataFrame([(s, day(d), *v) for s, d, *v in rows], FINAL)


def rows(df, *order):
    got = [tuple(r) for r in df.collect()]
    return sorted(got, key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    text = plan(df)
    return sum("Exchange " in line and "Reused" not in line for line in text.splitlines())


GOLDEN_DELIVERY = [
    ("2025-01-02", "aapl", "10", "11", "9", "12", "100"),
    ("2025-01-02", "AAPL", "10", "11", "9", "12", "100"),
    ("2025-01-03", "AAPL", "11", "12", "10", "13", "110"),
    ("2025-01-02", "NVDA", "50", "n/a", "49", "52", "500"),
    (None, "NVDA", "51", "52", "50", "53", "510"),
]
GOLDEN_RAW = [
    ("AAPL", "2025-01-02", 10.0, 11.0, 9.0, 12.0, 100),
    ("AAPL", "2025-01-03", 11.0, 12.0, 10.0, 13.0, 110),
    ("NVDA", "2025-01-02", 50.0, None, 49.0, 52.0, 500),
]
GOLDEN_PREDICTIONS = [
    ('"AAPL"', "2025-01-03T00:00:00", 99.0, 98.0, 100.0),
    ('"AAPL"', "2025-01-04T00:00:00", 12.5, 11.0, 14.0),
]
