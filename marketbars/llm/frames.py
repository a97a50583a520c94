"""Small DataFrame helpers of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 500


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first ``name_2``, ``name_3``... that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    tries = [name, *(f"{name}_{k}" for k in range(2, len(taken) + 3))]
    return next(t for t in tries if t.lower() not in taken)


def fold(column: str, folds: int) -> Column:
    """The fold of an id: crc32 of its decimal text, modulo ``folds``; null ids have none."""
    return F.crc32(F.col(column).cast("string")) % folds


def text_volume(df: DataFrame, column: str = "text") -> int:
    """Bytes of text in all rows: one narrow scan and one number to the driver."""
    return int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def blocks_for(volume: int, block: int) -> int:
    """Blocks of about ``block`` that hold ``volume``; at least one."""
    return max(1, math.ceil(volume / block))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches hold at most ``BATCH_ROWS`` rows from now on.

    Texts are far longer than the rows Spark's default is made for: ten thousand
    of them at a time would fill the buffers on both sides of each Python worker.
    A smaller setting of the session stays.
    """
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def broadcast_if_small(df: DataFrame, limit: int) -> DataFrame:
    """``df``, a stored table, marked for broadcast if it has at most ``limit`` rows."""
    return F.broadcast(df) if df.count() <= limit else df
