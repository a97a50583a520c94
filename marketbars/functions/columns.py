"""Scalar column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy_symbol(symbol: Column) -> Column:
    return F.upper(F.trim(symbol))


def symbol_key(symbol: Column, date: Column) -> Column:
    """``SYM|yyyy-MM-dd``; null when either part is null."""
    return F.concat(symbol, F.lit("|"), date.cast("string"))


def nan_to_null(number: Column) -> Column:
    """NaN to null. In Spark NaN equals itself, and ``nullif`` evaluates once."""
    return F.nullif(number, F.lit(float("nan")))


def coerce_number(value: Column, text: bool = True) -> Column:
    """Input to double; whatever is not a number becomes null, NaN included."""
    number = value.try_cast("double")
    if text:
        number = F.when(~_no_number(value), number)
    return nan_to_null(number)


def _no_number(text: Column) -> Column:
    """Text to refuse before the cast, by tests that cost next to nothing.

    Words such as "n/a" ("inf" aside) would each raise and catch an exception
    inside the cast. Java also accepts a type suffix ("1d", "2.5f") that is no
    part of a number in a price file.
    """
    bare = F.trim(text)
    first = F.substring(bare, 1, 1)
    word = (first >= "A") & (first <= "z") & ~first.isin("i", "I")
    ends = reduce(or_, [bare.endswith(c) for c in "dDfF"])
    return word | (ends & text.rlike(r"[0-9.][dDfF]\s*$"))


def coerce_volume(value: Column, text: bool = True) -> Column:
    """Whole-number volume; fractions round half up, out-of-range becomes null."""
    if text:
        whole = F.when(~_no_number(value), value.try_cast("decimal(38,0)"))
    else:
        whole = F.round(nan_to_null(value.cast("double")))
    return whole.try_cast("bigint")


def coerce_day(value: Column, text: bool = True) -> Column:
    """Timestamp, date or text to date. Text that is no date fails the job.

    The failure does not depend on the session's ANSI setting.
    """
    if not text:
        return value.cast("date")
    message = F.concat(F.lit("not a date: "), value)
    refuse = F.when(value.isNotNull(), F.raise_error(message).cast("date"))
    return F.coalesce(value.try_cast("date"), refuse)


def strip_quotes(series: Column) -> Column:
    return F.replace(series, F.lit('"'), F.lit(""))


def null_double() -> Column:
    return F.lit(None).cast("double")


def duplicate_line(symbol: Column, date: Column, n: Column) -> Column:
    return F.format_string("%s|%s -> %d rows", symbol, date.cast("string"), n)


def add_steps(day: Column, step: Column, calendar: str = "daily") -> Column:
    """The date ``step`` periods after ``day``.

    ``daily`` counts calendar days. ``weekday`` skips Saturday and Sunday: a
    weekend start counts from the Friday before it, and every five steps cross
    one weekend.
    """
    if calendar == "daily":
        return F.date_add(day, step)
    if calendar != "weekday":
        raise ValueError(f"unknown calendar {calendar!r}; use 'daily' or 'weekday'")
    weekday = F.weekday(day)  # Monday = 0
    past_friday = F.greatest(weekday - 4, F.lit(0))
    from_monday = F.least(weekday, F.lit(4)) + step
    weekends = F.floor(from_monday / 5).cast("int")
    return F.date_add(day, (step + weekends * 2 - past_friday).cast("int"))
