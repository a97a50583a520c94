"""Phrase collocation mining by dynamic itemset counting over cyclic shards.

Texts are cut into pieces at sentence marks and line ends, and pieces into words.
Phrases of 1 to ``longest`` words are counted per language, within pieces.

1. Texts are written once, dealt into ``shards``. A step scans one shard, in a cycle.
   Words count from the first step on. A longer phrase is activated at the first
   step at whose start both its first and its last words but one have reached the
   threshold, counts from then on in every scan, whatever other lengths do, and is
   done after one full cycle. So lengths are interleaved, and a phrase that reaches
   the threshold early lets longer ones start before its own cycle ends.
2. What a scan must know are the phrases that have reached the threshold, and when.
   For each length this is a table of ``SLOTS`` bytes, the step after which a slot
   was first set; a phrase sets two slots. A slot is set once and never changed, so
   every scan finds the same first step for a phrase and counts it in each shard
   exactly once. Two phrases on one slot can only activate a phrase early or in
   vain: counts stay exact, and phrases below the threshold go when they are done.
   The tables have a fixed size whatever the corpus; a full one costs rows.
3. A scan counts in runs of texts of at most ``RUN_BYTES``, or one longer text, so
   that a phrase crosses the shuffle at most once per task, whatever its frequency.
   Most phrases that are counted stay rare, so they travel as numbers: the hash of
   their first words but one and that of their last word, 128 bits in all. The counts
   of all steps lie in one table, bucketed by phrase, so they cross once and are added
   up where they lie. Only words carry their text; a phrase that has reached the
   threshold gets its own by joining that of its first words and that of its last
   one, which have reached it too.
4. A candidate is scored at its cuts by joining the counts of both parts, with
   38-digit integers. Each phrase's longer candidates are found from the longer side:
   a candidate of n words names its shorter parts, of which only the largest count
   is kept. Ranks are taken within ``SALTS`` parts of a language first, so no task
   sees all candidates of one.

Hashes of equal length and language are taken to be equal only for equal words: 128
bits tell the phrases of a count apart, 64 bits those that have reached the threshold.

Defined cases: null and empty texts have no words. A null language is ``und``.
Repeated rows count each time. An empty table gives an empty result. Extra columns
are not read. Words are taken from whole texts, however long.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketbars.llm.frames import broadcast_if_small, small_batches
from marketbars.llm.words import byte_class, mix, pieces, words
from marketbars.shared import run_dir, stored
from marketbars.sinks import files

THRESHOLD = 100
LONGEST = 5
TOP = 2000
SHARDS = 2
#: Slots of the table of each length; a power of two.
SLOTS = 1 << 22
#: Bytes of text that are counted at a time.
RUN_BYTES = 3 << 20
#: Parts of a language that are ranked apart first.
SALTS = 64
#: Languages up to which their totals are broadcast.
SMALL = 10_000
UNKNOWN = "und"
#: Bytes that end a piece, and blanks between words.
PIECE_ENDS = byte_class(*[(ord(c), ord(c)) for c in ".,;:!?"], (0x0A, 0x0D))
WORD_BYTES = ~(PIECE_ENDS | byte_class((0x20, 0x20), (0x09, 0x09)))
_NEVER = 255

#: ``word`` is a word and its language, with a blank between; longer phrases have none.
_COUNTS = "n int, first long, last long, act int, word string, f long"
_COUNTS_ARROW = pa.schema([("n", pa.int32()), ("first", pa.int64()), ("last", pa.int64()),
                           ("act", pa.int32()), ("word", pa.string()), ("f", pa.int64())])
_KEYS = ["n", "first", "last", "act", "word"]

#: The constants of the 64-bit xxHash.
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def slots(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two slots of a phrase's hash."""
    bits = size.bit_length() - 1
    return (h >> np.uint64(64 - bits)).astype(np.int64), (h & np.uint64(size - 1)).astype(np.int64)


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def hash_longs(*columns: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of columns of longs."""
    h = np.full(len(columns[0]), 42, np.uint64)
    for values in columns:
        h = h + (_P5 + np.uint64(8))
        h ^= _rotated(values * _P2, 31) * _P1
        h = _rotated(h, 27) * _P1 + _P4
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        h ^= h >> np.uint64(32)
    return h


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of an array, end to end, and the offsets of each."""
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return data[at], offsets


class Run:
    """The words of some texts: which are in one piece, and the hashes of phrases."""

    def __init__(self, table: pa.Table) -> None:
        langs = table.column("lang").combine_chunks().dictionary_encode()
        found = words(table.column("text").combine_chunks(), WORD_BYTES, lower=True)
        self.langs = langs.dictionary
        self.lang = langs.indices.to_numpy()[found.texts()]
        salts = np.array([_salt(x) for x in self.langs.to_pylist()], np.uint64)
        self.salts = salts[self.lang]
        ends = np.cumsum(PIECE_ENDS[found.data], dtype=np.int64)
        # Both counts only grow, so their sum is equal only where both are.
        self.piece = ends[found.starts] + found.texts()
        self.hashes = found.hashes
        self.found = found
        self._windows: dict[int, np.ndarray] = {}

    def windows(self, n: int) -> np.ndarray:
        """The hash of the n words from each word on, language included."""
        if n not in self._windows:
            if n == 1:
                self._windows[n] = mix(self.hashes ^ self.salts)
            else:
                size = max(len(self.hashes) - n + 1, 0)
                self._windows[n] = hash_longs(self.windows(n - 1)[:size], self.windows(1)[n - 1:])
        return self._windows[n]

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each word on are in one piece."""
        return self.piece[n - 1:] == self.piece[:max(len(self.piece) - n + 1, 0)]

    def counted(self, n: int, chosen: np.ndarray, act: np.ndarray | None) -> pa.RecordBatch:
        """One row per distinct phrase of n words among the chosen places."""
        h = self.windows(n)
        codes, distinct = pd.factorize(h[chosen])
        times = np.bincount(codes, minlength=len(distinct))
        at = np.empty(len(distinct), np.int64)
        at[codes] = chosen  # any place of a phrase stands for it
        zeros = np.zeros(len(at), np.int64)
        first = zeros if n == 1 else self.windows(n - 1)[at].view(np.int64)
        steps = zeros if act is None else act[at]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), n, np.int32)), pa.array(first),
             pa.array(self.windows(1)[at + n - 1].view(np.int64)), pa.array(steps.astype(np.int32)), self._words(at) if n == 1 else pa.nulls(len(at), pa.string()),
             pa.array(times.astype(np.int64))], schema=_COUNTS_ARROW)

    def _words(self, at: np.ndarray) -> pa.Array:
        """Words and their languages, as text."""
        starts = self.found.starts[at]
        data, offsets = _gathered(self.found.data, starts, self.found.ends[at] - starts)
        texts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
        langs = self.langs.take(pa.array(self.lang[at]))
        return pc.binary_join_element_wise(texts.cast(pa.string()), langs.cast(pa.string()), " ")


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[Run]:
    held, size = [], 0
    for batch in batches:
        for piece in pieces(batch):
            held.append(piece)
            size += piece.column("text").nbytes
            if size >= limit:
                yield Run(pa.Table.from_batches(held))
                held, size = [], 0
    if held:
        yield Run(pa.Table.from_batches(held))


def _count(step: int, shards: int, lengths: list[int], tables, run_bytes: int):
    """Counts of words and of phrases that are active at ``step``.

    ``tables`` is a broadcast of the tables of the lengths below those counted.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tables.value
        for run in _runs(batches, run_bytes):
            for n in lengths:
                if len(run.hashes) < n:
                    continue
                if n == 1:
                    yield run.counted(1, np.arange(len(run.hashes)), None)
                    continue
                one, two = slots(run.windows(n - 1), len(known[n - 1]))
                since = np.maximum(known[n - 1][one], known[n - 1][two])
                act = np.maximum(since[:-1], since[1:]).astype(np.int32)
                active = run.whole(n) & (act <= step) & (step < act + shards)
                if active.any():
                    yield run.counted(n, np.flatnonzero(active), act)

    return count


def _hash() -> Column:
    """The hash of a counted phrase, as scans know it."""
    return F.when(F.col("n") == 1, F.col("last")).otherwise(F.xxhash64("first", "last"))


def _mark(tables: dict[int, np.ndarray], reached: DataFrame, step: int) -> set[int]:
    """Set the free slots of reached phrases; the lengths of which there were any.

    The driver gets at most one row per length and 64 slots.
    """
    lengths = set()
    size = len(tables[1])
    bits = size.bit_length() - 1
    h = F.col("h")
    both = F.array(F.shiftrightunsigned(h, 64 - bits), h.bitwiseAND(F.lit(size - 1).cast("long")))
    found = reached.select("n", F.explode(both).alias("slot"))
    groups = found.groupBy("n", F.shiftright("slot", 6).alias("word")).agg(F.bit_or(
        F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    for n, part in groups.toPandas().groupby("n"):
        at, mask = part["word"].to_numpy(np.int64), part["bits"].to_numpy(np.int64).astype(np.uint64)
        table = tables[int(n)].reshape(-1, 64)
        row = table[at]
        new = (mask[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1) == 1
        new &= row == _NEVER
        row[new] = step
        table[at] = row
        if new.any():
            lengths.add(int(n))
    return lengths


@contextmanager
def _count_table(spark: SparkSession) -> Iterator[str]:
    """A table of counts by step, bucketed by phrase, for the length of a ``with`` block."""
    name, folder = f"phrase_counts_{uuid.uuid4().hex[:12]}", run_dir(spark, "phrase-counts")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE TABLE {name} ({_COUNTS}, step int) USING parquet PARTITIONED BY (step) "
              f"CLUSTERED BY ({', '.join(_KEYS)}) INTO {buckets} BUCKETS LOCATION '{folder}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")
        files.remove(spark, folder)


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                     shards: int = SHARDS, text: str = "text", lang: str = "lang",
                     slot_count: int = SLOTS, run_bytes: int = RUN_BYTES) -> tuple[DataFrame, DataFrame]:
    """Phrases that occur at least ``threshold`` times in a language (lang, n, phrase, f), and all words per language."""
    if shards * longest >= _NEVER:
        raise ValueError(f"{shards} shards and {longest} words make more than {_NEVER} steps")
    spark = small_batches(docs).sparkSession
    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("lang", "text"), F.lit(shards)).cast("int"))
    folder = run_dir(spark, "shards")
    rows.write.partitionBy("shard").parquet(folder)
    rows = spark.read.schema("lang string, text string, shard int").parquet(folder)

    tables = {n: np.full(slot_count, _NEVER, np.uint8) for n in range(1, longest)}
    steps: dict[int, set[int]] = {n: set() for n in tables}
    step = 0
    with _count_table(spark) as counted:
        while True:
            lengths = [1] if step < shards else []
            lengths += [n + 1 for n in tables if any(step - shards < s for s in steps[n])]
            if not lengths:
                break
            known = spark.sparkContext.broadcast({n - 1: tables[n - 1] for n in lengths if n > 1})
            shard = rows.where(F.col("shard") == step % shards).select("lang", "text")
            counts = shard.mapInArrow(_count(step, shards, lengths, known, run_bytes), _COUNTS)
            counts = counts.groupBy(*_KEYS).agg(F.sum("f").alias("f"))
            counts.withColumn("step", F.lit(step)).write.insertInto(counted)
            known.destroy()
            # Only phrases that this step counted can have reached the threshold in it.
            still = spark.table(counted).where((F.col("step") > step - shards) & (F.col("act") > step - shards)
                                               & (F.col("n") < longest))
            total = still.groupBy(*_KEYS).agg(F.sum("f").alias("f")).where(F.col("f") >= threshold)
            for n in _mark(tables, total.select("n", _hash().alias("h")), step + 1):
                steps[n].add(step + 1)
            step += 1
        total = spark.table(counted).groupBy(*_KEYS).agg(F.sum("f").alias("f"))
        frequent = stored(total.where(F.col("f") >= threshold).select(
            "n", "first", "last", _hash().alias("h"), "word", "f"), "frequent")
        words_of = F.expr("substring(word, instr(word, ' ') + 1)").alias("lang")
        totals = spark.table(counted).where("n = 1").groupBy(words_of).agg(F.sum("f").alias("words"))
        totals = stored(totals, "totals")
    files.remove(spark, folder)
    return stored(_named(frequent, longest), "phrases"), totals


def _all(parts: list[DataFrame]) -> DataFrame:
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _named(frequent: DataFrame, longest: int) -> DataFrame:
    """Frequent phrases with their language and text, length by length (lang, n, phrase, f)."""
    named = [frequent.where("n = 1").select(
        "n", "h", F.expr("substring(word, instr(word, ' ') + 1)").alias("lang"),
        F.expr("substring(word, 1, instr(word, ' ') - 1)").alias("phrase"), "f")]
    ends = named[0].select(F.col("h").alias("last"), F.col("phrase").alias("_end"))
    for n in range(2, longest + 1):
        starts = named[-1].select(F.col("h").alias("first"), "lang", F.col("phrase").alias("_start"))
        part = frequent.where(F.col("n") == n).drop("word").join(starts, "first").join(ends, "last")
        part = part.select("n", "h", "lang", F.concat_ws(" ", "_start", "_end").alias("phrase"), "f")
        named.append(stored(part, f"phrases-{n}") if n < longest else part)
    return _all(named).select("lang", "n", "phrase", "f")


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: lang, phrase, a, l, r, n, score."""
    parts = F.split("phrase", " ")
    cuts = frequent.where("n >= 2").select(
        "lang", "phrase", F.col("f").alias("a"), parts.alias("parts"),
        F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.size("parts")), " ").alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        one = frequent.select(F.col("lang"), F.col("phrase").alias(side), F.col("f").alias(count))
        cuts = cuts.join(one, ["lang", side])
    totals = broadcast_if_small(totals.withColumnRenamed("words", "n"), SMALL)
    cuts = cuts.join(totals, "lang")
    wide = "decimal(38,0)"
    cuts = cuts.withColumn("score", F.expr(
        f"(cast(1000 * cast(a as {wide}) as {wide}) * n) div (cast(l as {wide}) * r)"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def contained(frequent: DataFrame) -> DataFrame:
    """Of each phrase within a longer candidate, the largest count of such a one (lang, phrase, longer)."""
    inner = frequent.where("n >= 3").select("lang", "f", F.expr("""
        flatten(transform(sequence(2, n - 1), size -> transform(sequence(1, n - size + 1), first ->
            array_join(slice(split(phrase, ' '), first, size), ' '))))""").alias("inner"))
    inner = inner.select("lang", "f", F.explode("inner").alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP,
                 shards: int = SHARDS, text: str = "text", lang: str = "lang",
                 slot_count: int = SLOTS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    frequent, totals = frequent_phrases(docs, threshold, longest, shards, text, lang, slot_count, run_bytes)
    rows = scored(frequent, totals).join(contained(frequent), ["lang", "phrase"], "left")
    rows = rows.where("longer IS NULL OR longer < a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", "salt").orderBy(*order)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    rows = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return rows.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
