"""Bar sources: file scans, tick resampling, look-back and wide frames."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.schema import BARS, BARS_TEXT


def read_bars(
    spark: SparkSession,
    path: str | Sequence[str],
    file_format: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """All symbols of one or many paths in a single scan, schema given up front.

    Typed formats read as bars; text formats (csv, json) read every field as
    text, for ``normalize`` to coerce.
    """
    text = file_format in ("csv", "json")
    reader = spark.read.schema(schema or (BARS_TEXT if text else BARS))
    if file_format == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(file_format).load(path)


def daily_bars(
    ticks: DataFrame,
    symbol: str | Column = "symbol",
    ts: str = "ts",
    price: str = "price",
    volume: Column | None = None,
    sequence: str | None = None,
    sequence_range: tuple[int, int] | None = None,
) -> DataFrame:
    """Resample ticks to one OHLCV row per symbol and day.

    One shuffle of pre-aggregated rows: a hot symbol or day collapses in the
    map tasks. Give ``sequence`` where ticks share a timestamp, and equal times
    are broken by it. This orders by a struct, so the aggregate sorts; with the
    sequence's smallest and largest number as ``sequence_range``, less than 2^26
    apart, time of day and sequence are packed into 64 bits, and it hashes. A
    number outside the range fails the job.
    """
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    order = _moment(ticks, ts, sequence, sequence_range) if sequence else F.col(ts)
    volume = F.count(F.lit(1)) if volume is None else volume
    return (
        ticks.where(F.col(ts).isNotNull())
        .groupBy(symbol.alias("symbol"), F.to_date(ts).alias("date"))
        .agg(
            F.min_by(price, order).cast("double").alias("open"),
            F.max_by(price, order).cast("double").alias("close"),
            F.min(price).cast("double").alias("low"),
            F.max(price).cast("double").alias("high"),
            volume.cast("bigint").alias("volume"),
        )
    )


#: Bits of the microseconds of a day, one of 25 hours included.
_DAY_BITS = 37


def _moment(ticks: DataFrame, ts: str, sequence: str, span: tuple[int, int] | None) -> Column:
    """Orders the ticks of a day by time, then sequence, a null sequence first."""
    kind = ticks.schema[ts].dataType
    bits = 63 if span is None else (span[1] - span[0] + 1).bit_length()
    if (_DAY_BITS + bits > 63 or not isinstance(ticks.schema[sequence].dataType, T.IntegralType)
            or not isinstance(kind, (T.TimestampType, T.TimestampNTZType))):
        return F.struct(ts, sequence)
    first, last = span
    number = F.col(sequence).cast("bigint")
    message = F.concat(F.lit(f"sequence outside {first} to {last}: "), number.cast("string"))
    step = F.when(number.isNull(), F.lit(0)).when(number.between(first, last), number - (first - 1)).otherwise(
        F.raise_error(message).cast("bigint"))
    if isinstance(kind, T.TimestampType):
        return (F.unix_micros(ts) - F.unix_micros(F.date_trunc("day", F.col(ts)))) * (1 << bits) + step
    # Wall-clock times have no zone; their differences are counted in microseconds, as timestamps are.
    time = F.col(ts) - F.to_date(ts).cast("timestamp_ntz")
    moved = time * (1 << bits) + F.expr("INTERVAL '0.000001' SECOND") * step
    return F.lit("1970-01-01").cast("timestamp_ntz") + moved


def lookback(
    bars: DataFrame,
    days: int | None = 180,
    as_of: date | None = None,
) -> DataFrame:
    """The last ``days`` days up to ``as_of``, or up to each symbol's last date.

    With ``as_of`` this is two date bounds, pushed to the scan, and no shuffle.
    Without it, the last date per symbol is aggregated map-side and joined back;
    the engine chooses how from the sizes it measures, and splits hot symbols.
    Without ``days`` all bars up to ``as_of`` stay.
    """
    if days is None:
        return bars if as_of is None else bars.where(F.col("date") <= F.lit(as_of).cast("date"))
    if days < 1:
        raise ValueError("days must be at least 1")
    if as_of is not None:
        end = F.lit(as_of).cast("date")
        return bars.where((F.col("date") > F.date_sub(end, days)) & (F.col("date") <= end))
    last = bars.groupBy("symbol").agg(F.max("date").alias("last_date"))
    return (
        bars.join(last.dropna(), "symbol")
        .where(F.col("date") > F.date_sub("last_date", days))
        .select(*bars.columns)
    )


def wide_to_long(
    wide: DataFrame,
    date: str = "Date",
    separator: str = "|",
    drop_empty: bool = False,
) -> DataFrame:
    """Columns named ``field<separator>symbol`` to one row per date and symbol.

    A narrow projection, so nothing is shuffled or pivoted: each field becomes
    one array over all symbols, and the arrays are taken apart together with the
    list of names. The plan has one expression a field however many symbols there
    are. Fields a symbol lacks become null, and ``drop_empty`` leaves out bars in
    which every field is null.
    """
    pairs = [c.rsplit(separator, 1) for c in wide.columns if c != date and separator in c]
    fields = list(dict.fromkeys(f for f, _ in pairs))
    symbols = list(dict.fromkeys(s for _, s in pairs))
    if not symbols:
        raise ValueError(f"no column is named <field>{separator}<symbol>: {wide.columns}")
    have = {(f, s): f"{f}{separator}{s}" for f, s in pairs}
    types = {f.name: f.dataType.simpleString() for f in wide.schema}

    def values(field: str) -> str:
        kind = next(types[have[field, s]] for s in symbols if (field, s) in have)

        def value(symbol: str) -> str:
            name = have.get((field, symbol))
            if name is None:
                return f"CAST(NULL AS {kind})"
            return quote(name) if types[name] == kind else f"CAST({quote(name)} AS {kind})"

        return f"array({', '.join(map(value, symbols))}) AS {quote(field)}"

    names = F.from_json(F.lit(json.dumps(symbols)), "array<string>")
    arrays = wide.selectExpr(quote(date), *map(values, fields)).withColumn("symbol", names)
    zipped = F.arrays_zip("symbol", *[F.col(quote(f)) for f in fields])
    long = arrays.select(F.col(quote(date)), F.inline(zipped))
    return long.dropna("all", subset=fields) if drop_empty else long


def flatten_symbol(
    wide: DataFrame, symbol: str, date: str = "Date", separator: str = "|"
) -> DataFrame:
    """One symbol's plain columns out of two-level ones.

    When no column carries the symbol, the second level is simply dropped.
    """
    plain = [c for c in wide.columns if separator not in c]
    two_level = [c for c in wide.columns if separator in c]
    own = [c for c in two_level if c.rsplit(separator, 1)[1] == symbol]
    return wide.select(
        *[F.col(quote(c)) for c in plain],
        *[F.col(quote(c)).alias(c.rsplit(separator, 1)[0]) for c in own or two_level],
    )


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
