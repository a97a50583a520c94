"""Deliveries that know which symbols each of their files holds.

Beside a folder of files lies an index: for each file the smallest and the largest
tidy symbol, and a Bloom filter of all of them. It is written with the delivery, in one
pass over its symbol column. A read of named symbols consults it first and opens only
files that may hold one of them. A file without an entry is always read, so an index
that is missing or behind costs time and no rows. Files are not changed once delivered.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.functions import tidy_symbol
from marketbars.settings import parse_symbols
from marketbars.sinks import files
from marketbars.sources.bars import read_bars

#: Bits of a file's filter: some 800 symbols a file at one false answer in a hundred.
BITS = 1 << 13
HASHES = 4
_INDEX = "file string, low string, high string, bits int, filter map<int,bigint>"


def index_folder(path: str) -> str:
    return f"{path.rstrip('/')}_symbols"


def _position(symbol: Column, k: int, bits: Column | int) -> Column:
    return F.pmod(F.xxhash64(symbol, F.lit(k)), bits)


def _index_of(rows: DataFrame, bits: int) -> DataFrame:
    """Index rows of the files that ``rows`` come from; a file's filter has at most ``bits / 64`` entries."""
    symbol = tidy_symbol(F.col("symbol"))
    found = rows.select(F.col("_metadata.file_path").alias("file"), symbol.alias("symbol")).distinct()
    at = F.array(*[_position(F.col("symbol"), k, F.lit(bits)) for k in range(HASHES)])
    words = found.where("symbol IS NOT NULL").select("file", "symbol", F.explode(at).alias("at"))
    words = words.groupBy("file", F.shiftright("at", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask"),
        F.min("symbol").alias("low"), F.max("symbol").alias("high"))
    return words.groupBy("file").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.lit(bits).alias("bits"),
        F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("filter"))


def index_files(spark: SparkSession, path: str, file_format: str = "parquet",
                schema: T.StructType | None = None, bits: int = BITS) -> int:
    """Index the files of a delivery that have no entry yet; how many there were."""
    new = sorted(set(_listed(spark, path, file_format, schema)) - set(_entries(spark, path)))
    if new:
        rows = read_bars(spark, new, file_format, schema)
        _index_of(rows, bits).write.mode("append").parquet(index_folder(path))
    return len(new)


def write_delivery(bars: DataFrame, path: str, file_format: str = "parquet", bits: int = BITS,
                   range_by: Sequence[str] = ()) -> int:
    """Add ``bars`` to a delivery folder and index their files; how many files were added.

    With ``range_by`` the files are ranges of those columns, so that a file holds few
    symbols.
    """
    if range_by:
        bars = bars.repartitionByRange(*range_by)
    options = {"header": True} if file_format == "csv" else {}
    bars.write.mode("append").format(file_format).options(**options).save(path)
    return index_files(bars.sparkSession, path, file_format, bars.schema, bits)


def _plain(file: str) -> str:
    """One spelling of a file's name, which readers take."""
    return re.sub("^file:/+", "file:/", unquote(file))


def _listed(spark: SparkSession, path: str, file_format: str, schema: T.StructType | None) -> list[str]:
    return [_plain(f) for f in read_bars(spark, path, file_format, schema).inputFiles()]


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    folder = index_folder(path)
    parent, _, name = folder.rpartition("/")
    if name not in files.folders(spark, parent):
        return None
    return spark.read.schema(_INDEX).parquet(folder)


def _entries(spark: SparkSession, path: str) -> list[str]:
    index = _index(spark, path)
    return [] if index is None else [_plain(r["file"]) for r in index.select("file").collect()]


def may_hold(names: Sequence[str]) -> Column:
    """Whether an index row's file can hold one of ``names``; false only if it holds none."""
    def one(name: Column) -> Column:
        within = (name >= F.col("low")) & (name <= F.col("high"))
        for k in range(HASHES):
            at = _position(name, k, F.col("bits"))
            word = F.element_at("filter", F.shiftright(at, 6).cast("int"))
            bit = F.call_function("shiftright", F.coalesce(word, F.lit(0)), at.bitwiseAND(F.lit(63)).cast("int"))
            within = within & (bit.bitwiseAND(F.lit(1).cast("bigint")) == 1)
        return within

    return F.exists(F.array(*map(F.lit, names)), one)


def read_named(spark: SparkSession, path: str, symbols: str | Sequence[str], file_format: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Rows of the named symbols, from those files of a delivery that may hold one.

    The list of files is the driver's, as in any scan. Symbols are compared tidy and
    returned as delivered.
    """
    names = parse_symbols(symbols if isinstance(symbols, str) else ",".join(symbols))
    index = _index(spark, path)
    wanted = listed = _listed(spark, path, file_format, schema)
    if index is not None:
        without = {_plain(r["file"]) for r in index.where(~may_hold(names)).select("file").collect()}
        wanted = [f for f in listed if f not in without]
    rows = read_bars(spark, wanted or listed, file_format, schema)
    tidy = tidy_symbol(F.col("symbol"))
    return rows.where(tidy.isin(*names)) if wanted else rows.where(F.lit(False))
