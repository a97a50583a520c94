"""The stored snapshot table.

All versions lie in one table of files, partitioned by ``epoch`` and bucketed by
(symbol, date). A run writes one epoch: the versions it opens, and for those it
closes their key, id and closing moment; nothing written before is rewritten. One view
lists the epochs that count and puts each version together from its opening and its
closing row, in one aggregate by key and id. The files are dealt by key already, so
neither this aggregate nor the daily join with the source moves a stored row.

Replacing the view is the commit. Before it writes, a run claims the epoch after the
last committed one, by adding that partition to the catalog: of two runs at once the
second finds it there and fails, before it has written anything. A run that fails gives
its claim back; a claim that a lost driver left behind is given back by
``release_claim``. Each attempt writes to a folder of its own, so what one that was not
committed has left is never read.

Each run reads the versions of all epochs, so its cost grows with the history.
``compact`` writes the whole history as one epoch and takes the others out of the
catalog, which lists their files no longer; ``remove_dead`` removes their folders once
no reader uses them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.operators import snapshot
from marketbars.operators.dedup import KEYS
from marketbars.operators.quality import QualityError, raise_on_duplicates
from marketbars.settings import Settings, quoted
from marketbars.sinks import files
from marketbars.sinks.tables import counted, ddl, require_rows

EPOCHS, MOMENT, SOURCE = "marketbars.epochs", "marketbars.moment", "marketbars.source"


class ConcurrentRunError(RuntimeError):
    """Another run has claimed the epoch this one would write."""


def run_name(as_of: datetime) -> str:
    """A moment as text; names sort by time."""
    return as_of.strftime("r%Y%m%dT%H%M%S%f")


def live_epochs(spark: SparkSession, view: str) -> tuple[dict[int, str], str] | None:
    """The epochs that count with their folders, and the moment of the last."""
    if not spark.catalog.tableExists(view):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    return {int(e): folder for e, folder in json.loads(found[EPOCHS]).items()}, found[MOMENT]


def source_parts(spark: SparkSession, view: str) -> dict[str, str]:
    """The runs of the parts that the source had when the snapshot last read it; none if it was read whole."""
    if not spark.catalog.tableExists(view):
        return {}
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    return json.loads(found.get(SOURCE, "{}"))


def current_run(spark: SparkSession, view: str) -> tuple[int, int, str] | None:
    """First and last epoch that count, and the moment of the last."""
    last = live_epochs(spark, view)
    return None if last is None else (min(last[0]), max(last[0]), last[1])


def raise_on_null_keys(source: DataFrame) -> None:
    """Null never equals null, so a key with a null part would open anew at each run."""
    missing = reduce(or_, [F.col(k).isNull() for k in KEYS])
    if not source.where(missing).limit(1).isEmpty():
        raise QualityError(f"null in a key column of {KEYS}")


def next_versions(held: DataFrame, source: DataFrame, as_of: datetime, buckets: int,
                  dealt: bool = False) -> DataFrame:
    """The versions that ``source`` opens or closes.

    The source is dealt as the stored versions are, so it alone moves; with ``dealt``
    it is a table of as many buckets by key, and nothing moves.
    """
    rows = source if dealt else source.repartition(buckets, *KEYS)
    versions = snapshot.advance(snapshot.open_part(held), rows, as_of)
    at = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return versions.where((F.col("valid_to") == at) | (F.col("valid_from") == at))


def update_snapshot(
    spark: SparkSession, source: DataFrame, cfg: Settings, as_of: datetime, checked: bool = False,
    dealt: bool = False,
    parts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Bring the stored snapshot up to ``source`` as seen at ``as_of``.

    The same moment over an unchanged source changes nothing, so a run that
    failed later on can be repeated. ``checked`` says that keys are known to be
    unique, ``dealt`` that the source is a table in ``cfg.buckets`` buckets by key.
    A key that the source does not hold stays as it is, so of a source kept in parts
    it is enough to give those that have changed; ``parts`` are then kept for the
    next run to tell which those are.
    """
    last, moment = live_epochs(spark, cfg.snapshot), run_name(as_of)
    if last is not None and moment < last[1]:
        raise ValueError(f"snapshot already stands at {last[1]}; {moment} is not later")
    raise_on_null_keys(source)
    if not checked:
        raise_on_duplicates(source)
    if last is None:
        versions = snapshot.initial(source, as_of)
        _create_files(spark, cfg, versions.schema)
    else:
        held = spark.table(cfg.snapshot)
        versions = next_versions(held, source, as_of, cfg.buckets, dealt)
        if moment == last[1]:
            # Versions opened at this moment are there; nothing may close or open.
            at = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
            opened = held.where(F.col("valid_from") == at).select("scd_id")
            new = versions.join(opened, "scd_id", "left_anti")
            if not versions.where(F.col("valid_to").isNotNull()).unionByName(new).isEmpty():
                raise ValueError(f"snapshot already stands at {last[1]} with other rows")
            return held
    # Of a version that closes, its opening row holds the rest.
    closing = F.col("valid_to").isNotNull()
    ends = (*KEYS, "scd_id", "valid_to")
    rows = versions.select(*[
        F.col(c) if c in ends else F.when(~closing, F.col(c)).alias(c) for c in versions.columns])
    epochs = {} if last is None else last[0]
    epoch = max(epochs, default=0) + 1
    if last is not None or not dealt:
        rows = rows.repartition(cfg.buckets, *KEYS)
    _write_epoch(spark, cfg, rows, epoch, last is not None, lambda folder: _commit(
        spark, cfg, versions.columns, epochs | {epoch: folder}, moment, parts or {}))
    return spark.table(cfg.snapshot)


def compact(spark: SparkSession, cfg: Settings) -> DataFrame:
    """Write the whole history as one epoch, and read from there on."""
    epochs, moment = live_epochs(spark, cfg.snapshot)
    parts = source_parts(spark, cfg.snapshot)
    history = spark.table(cfg.snapshot)
    epoch = max(epochs) + 1
    _write_epoch(spark, cfg, history.repartition(cfg.buckets, *KEYS), epoch, False, lambda folder: _commit(
        spark, cfg, history.columns, {epoch: folder}, moment, parts))
    dead = ", ".join(f"PARTITION (epoch = {e})" for e in epochs)
    spark.sql(f"ALTER TABLE {cfg.snapshot_files} DROP IF EXISTS {dead}")
    return spark.table(cfg.snapshot)


def remove_dead(spark: SparkSession, cfg: Settings) -> list[str]:
    """Remove the folders of epochs that neither count nor come after the last one; their names."""
    epochs, _ = live_epochs(spark, cfg.snapshot)
    ahead = f"epoch={max(epochs) + 1}_"
    gone = [f for f in files.folders(spark, _location(cfg))
            if f.startswith("epoch=") and f not in epochs.values() and not f.startswith(ahead)]
    for folder in gone:
        files.remove(spark, f"{_location(cfg)}/{folder}")
    return gone


def claim(spark: SparkSession, cfg: Settings, epoch: int) -> str:
    """Take an epoch; its new folder. The catalog adds a partition once, whoever asks."""
    folder = f"epoch={epoch}_{uuid.uuid4().hex[:8]}"
    try:
        spark.sql(f"ALTER TABLE {cfg.snapshot_files} ADD PARTITION (epoch = {epoch}) "
                  f"LOCATION '{_location(cfg)}/{folder}'")
    except AnalysisException as error:
        if "ALREADY_EXIST" not in (error.getCondition() or ""):
            raise
        raise ConcurrentRunError(
            f"epoch {epoch} of {cfg.snapshot} is claimed by another run; "
            "if that run is dead, give its claim back with release_claim") from error
    return folder


def release_claim(spark: SparkSession, cfg: Settings) -> None:
    """Give back the claim of a run that will not commit."""
    last = live_epochs(spark, cfg.snapshot)
    epoch = max(last[0] if last else {}, default=0) + 1
    spark.sql(f"ALTER TABLE {cfg.snapshot_files} DROP IF EXISTS PARTITION (epoch = {epoch})")


def _location(cfg: Settings) -> str:
    return cfg.location("snapshots", "market_data_snapshot") + "_files"


def _create_files(spark: SparkSession, cfg: Settings, schema: T.StructType) -> None:
    keys = ", ".join(map(quoted, KEYS))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {cfg.snapshot_files} ({ddl(schema)}, epoch INT) USING parquet "
              f"PARTITIONED BY (epoch) CLUSTERED BY ({keys}) INTO {cfg.buckets} BUCKETS "
              f"LOCATION '{_location(cfg)}'")


def _write_epoch(spark: SparkSession, cfg: Settings, rows: DataFrame, epoch: int, allow_empty: bool,
                 commit: Callable[[str], None]) -> None:
    folder = claim(spark, cfg, epoch)
    try:
        # Rows are dealt by the hash that buckets are, so a task writes few of them.
        written, seen = counted(rows.withColumn("epoch", F.lit(epoch)))
        written.write.insertInto(cfg.snapshot_files)
        require_rows(seen, cfg.snapshot, allow_empty)
        commit(folder)
    except BaseException:
        spark.sql(f"ALTER TABLE {cfg.snapshot_files} DROP IF EXISTS PARTITION (epoch = {epoch})")
        raise


def _commit(spark: SparkSession, cfg: Settings, columns: list[str], epochs: dict[int, str],
            moment: str, parts: Mapping[str, str]) -> None:
    identity = (*KEYS, "scd_id")
    names = ", ".join(quoted(n) if n in identity else f"max({quoted(n)}) AS {quoted(n)}" for n in columns)
    listed = ", ".join(map(str, epochs))
    spark.sql(
        f"CREATE OR REPLACE VIEW {cfg.snapshot} "
        f"TBLPROPERTIES ('{EPOCHS}' = '{json.dumps(epochs)}', '{MOMENT}' = '{moment}', "
        f"'{SOURCE}' = '{json.dumps(dict(parts))}') AS "
        f"SELECT {names} FROM {cfg.snapshot_files} WHERE epoch IN ({listed}) "
        f"GROUP BY {', '.join(map(quoted, identity))}")
