"""Slowly changing history (type 2) of a keyed table.

A version is open while ``valid_to`` is null. Only the check columns make a new
version; keys that vanish from the source stay open.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.operators.dedup import KEYS

# Columns whose change opens a version, and the validity columns.
CHECK_COLUMNS = ("close", "volume")
VALIDITY = ("scd_id", "valid_from", "valid_to")

ABSENT, INSERT, CHANGE, SAME = "absent", "insert", "change", "same"


def _moment(as_of: datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def _open_version(columns: Sequence[Column], keys: Sequence[str], row: str, at: Column) -> list[Column]:
    # Bars within a key part are marked, so that no two keys give one text.
    parts = [F.regexp_replace(F.col(f"{row}.{k}").cast("string"), r"([|\\])", r"\\$1") for k in keys]
    key = F.concat(*[p for part in parts for p in (part, F.lit("|"))][:-1])
    return [
        *columns,
        F.md5(F.concat(key, F.lit("|"), at.cast("string"))).alias("scd_id"),
        at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    ]


def initial(source: DataFrame, as_of: datetime, keys: Sequence[str] = KEYS) -> DataFrame:
    """First run: every source row opens a version."""
    rows = source.alias("s")
    columns = [F.col(f"s.{c}") for c in source.columns]
    return rows.select(*_open_version(columns, keys, "s", _moment(as_of)))


def _matched(open_versions: DataFrame, source: DataFrame, keys: Sequence[str], checked: Sequence[str]):
    """Open versions against the source, one row per key, with its class.

    Both sides hold one row per key, so no key is hot in the join.
    """
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"s.{k}") for k in keys])
    changed = reduce(or_, [~F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}")) for c in checked])
    kind = (
        F.when(F.col("s._in_source").isNull(), ABSENT)
        .when(F.col("o.valid_from").isNull(), INSERT)
        .when(changed, CHANGE)
        .otherwise(SAME)
    )
    left = open_versions.alias("o")
    right = source.withColumn("_in_source", F.lit(True)).alias("s")
    return left.join(right, on, "full_outer").withColumn("kind", kind)


def open_part(history: DataFrame) -> DataFrame:
    return history.where(F.col("valid_to").isNull())


def changes(
    history: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = KEYS,
    checked: Sequence[str] = CHECK_COLUMNS,
) -> DataFrame:
    """Each key's class: absent, insert, change or same."""
    matched = _matched(open_part(history), source, keys, checked)
    return matched.select(
        *[F.coalesce(F.col(f"o.{k}"), F.col(f"s.{k}")).alias(k) for k in keys], "kind"
    )


def advance(
    open_versions: DataFrame,
    source: DataFrame,
    as_of: datetime,
    keys: Sequence[str] = KEYS,
    checked: Sequence[str] = CHECK_COLUMNS,
) -> DataFrame:
    """The versions one run leaves: open ones, and those it closes.

    One join; each matched key then becomes one or two versions in place, so
    closing and opening read neither side a second time.
    """
    at = _moment(as_of)
    columns = source.columns
    old = [F.col(f"o.{c}").alias(c) for c in columns]
    kind = F.col("kind")
    kept = F.struct(
        *old,
        F.col("o.scd_id").alias("scd_id"),
        F.col("o.valid_from").alias("valid_from"),
        F.when(kind == CHANGE, at).alias("valid_to"),
    )
    opened = F.struct(
        *_open_version([F.col(f"s.{c}").alias(c) for c in columns], keys, "s", at)
    )
    versions = F.array(
        F.when(kind != INSERT, kept), F.when(kind.isin(INSERT, CHANGE), opened)
    )
    return (
        _matched(open_versions, source, keys, checked)
        .select(F.explode(F.array_compact(versions)).alias("v"))
        .select("v.*")
    )


def apply(
    history: DataFrame,
    source: DataFrame,
    as_of: datetime,
    keys: Sequence[str] = KEYS,
    checked: Sequence[str] = CHECK_COLUMNS,
) -> DataFrame:
    """The whole history after one run; versions closed earlier pass through."""
    closed = history.where(F.col("valid_to").isNotNull())
    return closed.unionByName(advance(open_part(history), source, as_of, keys, checked))
