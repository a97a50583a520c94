"""Declarative checks on a table, and the report they make."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.operators.dedup import KEYS, duplicate_key_count, duplicate_sample
from marketbars.operators.mart import FORECAST, HISTORICAL


class QualityError(AssertionError):
    """A table failed its checks."""


@dataclass(frozen=True)
class Check:
    """``not_null``, ``accepted_values`` or ``unique`` on one column."""

    kind: str
    column: str
    values: tuple[str, ...] = ()

    def fails(self) -> Column:
        """True for a row that breaks a row-level check; null counts as passing."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(*self.values)
        raise ValueError(f"{self.kind!r} is no row-level check")


_KEYED = (
    Check("not_null", "symbol"),
    Check("not_null", "date"),
    Check("unique", "pk_symbol_date"),
)

# The checks each table must pass.
MODEL_CHECKS: dict[str, tuple[Check, ...]] = {
    "stg_market_data": _KEYED,
    "stg_market_forecast": _KEYED,
    "mart_stock_analysis": (*_KEYED, Check("accepted_values", "record_type", (HISTORICAL, FORECAST))),
}


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null rows per column, all columns in one pass."""
    return _row_report(df, [Check("not_null", c) for c in columns]).select(
        F.col("column"), "n_failing"
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values of ``column`` held by more than one row."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows per value outside the accepted list; nulls are not counted."""
    return (
        df.where(Check("accepted_values", column, tuple(values)).fails())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def forecast_not_future(mart: DataFrame) -> DataFrame:
    """Forecast rows dated on or before their symbol's last historical day.

    The history side is one pre-aggregated row per symbol. The forecast side
    has a horizon's worth of rows per symbol, so neither side is skewed.
    """
    last_day = last_history_day(mart)
    ahead = mart.where(F.col("record_type") == FORECAST)
    return (
        ahead.join(last_day, "symbol")
        .where(F.col("date") <= F.col("max_hist_date"))
        .select("symbol", "date", "record_type", "forecast_price", "max_hist_date")
    )


def last_history_day(mart: DataFrame) -> DataFrame:
    return (
        mart.where(F.col("record_type") == HISTORICAL)
        .groupBy("symbol")
        .agg(F.max("date").alias("max_hist_date"))
    )


def _rows(totals: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row of counters ``n0, n1, ..`` to one report row per check."""
    lines = [
        F.struct(
            F.lit(c.kind).alias("check"),
            F.lit(c.column).alias("column"),
            F.coalesce(F.col(f"n{i}"), F.lit(0)).cast("bigint").alias("n_failing"),
        )
        for i, c in enumerate(checks)
    ]
    return totals.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def _row_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counters = [F.count_if(c.fails()).alias(f"n{i}") for i, c in enumerate(checks)]
    return _rows(df.agg(*counters), checks)


def _keyed_report(df: DataFrame, row_checks: Sequence[Check], key: Check) -> DataFrame:
    """Row-level counters ride along with the group-by of a unique check."""
    counters = [F.count_if(c.fails()).alias(f"_failing{i}") for i, c in enumerate(row_checks)]
    per_key = df.groupBy(F.col(key.column).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), *counters
    )
    repeated = F.col("_key").isNotNull() & (F.col("_rows") > 1)
    totals = per_key.agg(
        *[F.sum(f"_failing{i}").alias(f"n{i}") for i in range(len(row_checks))],
        F.count_if(repeated).alias(f"n{len(row_checks)}"),
    )
    return _rows(totals, [*row_checks, key])


def report(df: DataFrame, checks: Sequence[Check], mart_rule: bool = False) -> DataFrame:
    """Every check of a table: check, column, n_failing, passed.

    All row-level checks and the first unique check take one scan and one
    shuffle on that key; each further unique check takes its own. ``mart_rule``
    adds the rule that forecasts lie after history.
    """
    row_checks = [c for c in checks if c.kind != "unique"]
    keys = [c for c in checks if c.kind == "unique"]
    parts = []
    if keys:
        parts.append(_keyed_report(df, row_checks, keys[0]))
        parts += [_keyed_report(df, [], k) for k in keys[1:]]
    elif row_checks:
        parts.append(_row_report(df, row_checks))
    if mart_rule:
        late = forecast_not_future(df).agg(F.count(F.lit(1)).alias("n0"))
        parts.append(_rows(late, [Check("forecast_future", "date")]))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.withColumn("passed", F.col("n_failing") == 0)


def distinct_report(rows: DataFrame, checks: Sequence[Check], parts: Sequence[str] = KEYS) -> DataFrame:
    """``report`` of ``rows.distinct()`` without making the distinct rows: one shuffle, on the key.

    ``checks`` are one unique check on a key that is null exactly where one of its
    ``parts`` is, and else tells them, and not_null checks on those parts. Rows of a
    key become one row after ``distinct`` if in each other column they are all null,
    or none is and its minimum is its maximum. Over numbers these are aggregates of
    fixed width, which hash, and they are taken before the shuffle, so a key of any
    number of rows crosses once per task. Rows without a key are told apart by all
    their columns, and each group of them is one distinct row.
    """
    unique_checks = [c for c in checks if c.kind == "unique"]
    nulls = [c for c in checks if c.kind == "not_null"]
    if len(unique_checks) != 1 or len(nulls) + 1 != len(checks) or not {c.column for c in nulls} <= set(parts):
        raise ValueError("needs one unique check and not_null checks on the parts of its key")
    key = unique_checks[0].column
    others = [c for c in rows.columns if c != key]
    compared = [c for c in others if c not in parts]
    keyless = F.col(key).isNull()
    groups = rows.groupBy(
        F.col(key).alias("_key"), *[F.when(keyless, F.col(c)).alias(f"_part{i}") for i, c in enumerate(others)]
    ).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[a for i, c in enumerate(compared) for a in (
            F.count(c).alias(f"_n{i}"), F.min(c).alias(f"_low{i}"), F.max(c).alias(f"_high{i}"))],
    )
    same = reduce(lambda a, b: a & b, [
        (F.col(f"_n{i}") == 0) | ((F.col(f"_n{i}") == F.col("_rows")) & (F.col(f"_low{i}") == F.col(f"_high{i}")))
        for i in range(len(compared))], F.lit(True))
    has_key = F.col("_key").isNotNull()
    totals = groups.agg(
        *[F.count_if(~has_key & F.col(f"_part{others.index(c.column)}").isNull()).alias(f"n{i}")
          for i, c in enumerate(nulls)],
        F.count_if(has_key & ~same).alias(f"n{len(nulls)}"),
    )
    return _rows(totals, [*nulls, unique_checks[0]]).withColumn("passed", F.col("n_failing") == 0)


def raise_on_failure(result: DataFrame, table: str = "table") -> list[tuple[str, str, int]]:
    """Run a report (one row per check) and raise if any check failed."""
    rows = [(r["check"], r["column"], r["n_failing"]) for r in result.collect()]
    failed = [r for r in rows if r[2] > 0]
    if failed:
        lines = [f"{check}({column}): {n} failing" for check, column, n in failed]
        raise QualityError(f"{table} failed {len(failed)} checks\n" + "\n".join(lines))
    return rows


def raise_on_duplicates(df: DataFrame) -> None:
    """Raise with up to ten of the worst (symbol, date) keys if any repeats."""
    dupes = duplicate_key_count(df).first()["dupes"]
    if dupes:
        lines = [r["line"] for r in duplicate_sample(df).collect()]
        raise QualityError(f"{dupes} duplicate (symbol, date) keys\n" + "\n".join(lines))
