"""Vector code compression: product codes by exact integer k-means with LAESA pivots.

A vector's components become integers floor(scale * x) and the vector is cut into
equal consecutive parts. Each part position has a codebook, which starts as that
part of the smallest vector ids. A round assigns every part to its nearest entry
and replaces each used entry by the floored mean of its parts.

1. Per part position, ``pivots`` fixed points are chosen among the first entries,
   each the one with the largest sum of distances to those before it. The distance
   of every part to every pivot is computed once and stored with the vector.
2. A round computes only the distances from pivots to entries. By the triangle
   inequality, |d(part, pivot) - d(pivot, entry)| bounds d(part, entry) from below.
   The entry of the smallest bound is evaluated first, then the few next ones, then
   all whose bound does not pass the best distance so far. Bounds are rounded down
   and equal distances are evaluated, so the nearest entry, and of ties the lowest,
   is always found; evaluations are exact integers.
3. Each task adds up its parts per entry, at most one row per part and entry; Spark
   sums these rows. Only codebooks (parts x entries rows) reach the driver.

Vectors are scanned narrow, once a round, from the stored table: nothing but these
sums and the totals per label is shuffled.

Defined cases: vectors that are null or hold null or non-finite components are
dropped. The dimension is that of the smallest vec_id whose length is a positive
multiple of the number of parts; vectors of another length, or with an integer
beyond ``LARGEST``, are returned with a null code and a null error and enter no
codebook. Entries start from distinct vec_ids; of rows that share one, the smallest
vector counts. Rows with a null vec_id are coded, and start no entry. Repeated rows
each get their code. Ids are whole numbers. Fewer of them than ``entries`` make smaller codebooks. An empty
table gives an empty result. Only the three named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.frames import broadcast_if_small, fresh
from marketbars.shared import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
PIVOTS = 8
#: Integers up to here keep squared distances of 8,192 components within 64 bits.
LARGEST = 1 << 24
#: Entries that are evaluated before the rest is pruned.
NEXT = 8
#: Rows whose bounds are held at a time, and pairs evaluated at a time.
ROWS = 2048
PAIRS = 1 << 17
#: Labels up to which their totals are broadcast.
SMALL = 100_000


@dataclass
class Book:
    """Codebooks and pivots: integers by part, entry or pivot, and position."""

    entries: np.ndarray
    pivots: np.ndarray

    def pivot_distances(self) -> np.ndarray:
        """From each entry to each pivot, by part."""
        return np.stack([far(e, p) for e, p in zip(self.entries, self.pivots, strict=True)])


def far(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distances of integer points to a few others."""
    out = np.empty((len(points), len(others)))
    for k, other in enumerate(others):
        step = points - other
        out[:, k] = np.sqrt(np.einsum("ij,ij->i", step, step).astype(np.float64))
    return out


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Of each part's first entries, those with the largest sums of distances to the ones before."""
    found = []
    for points in entries:
        chosen = [0]
        total = far(points, points[:1])[:, 0]
        while len(chosen) < min(count, len(points)):
            total[chosen] = -1
            chosen.append(int(total.argmax()))
            total = total + far(points, points[chosen[-1:]])[:, 0]
        found.append(points[chosen])
    return np.stack(found)


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
            entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each point: its nearest entry, the squared distance, and how many were evaluated in all."""
    index = np.empty(len(points), np.int64)
    best = np.empty(len(points), np.int64)
    evaluated = 0
    for a in range(0, len(points), ROWS):
        rows = slice(a, a + ROWS)
        index[rows], best[rows], n = _nearest(points[rows], to_pivots[rows], entries, entry_pivots)
        evaluated += n
    return index, best, evaluated


def _squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    step = points - entries
    return np.einsum("ij,ij->i", step, step)


def _nearest(points, to_pivots, entries, entry_pivots):
    bound = np.zeros((len(points), len(entries)))
    for k in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, k, None] - entry_pivots[None, :, k]), out=bound)
    # Rounding of the two roots must not lift a bound over the true distance.
    bound -= 1e-9 * (1 + to_pivots.max(initial=0) + entry_pivots.max(initial=0))
    np.maximum(bound, 0, out=bound)
    every = np.arange(len(points))
    index = bound.argmin(axis=1)
    best = _squared(points, entries[index])
    bound *= bound
    bound *= 1 - 1e-9
    bound[every, index] = np.inf
    evaluated = len(points)
    few = min(NEXT, len(entries) - 1)
    if few:
        order = np.argpartition(bound, few - 1, axis=1)[:, :few]
        mask = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(mask, order, True, axis=1)
        for wanted in (mask, ~mask):
            at, entry = np.nonzero(wanted & (bound <= best[:, None]))
            evaluated += len(at)
            for a in range(0, len(at), PAIRS):
                _improve(points, entries, at[a:a + PAIRS], entry[a:a + PAIRS], index, best)
    return index, best, evaluated


def _improve(points, entries, at, entry, index, best) -> None:
    """Evaluate pairs, sorted by point and entry; of equal distances the lower entry stays."""
    found = _squared(points[at], entries[entry])
    first = np.flatnonzero(np.diff(at, prepend=-1))
    least = np.minimum.reduceat(found, first)
    hit = np.flatnonzero(found == np.repeat(least, np.diff(np.append(first, len(at)))))
    rows, where = np.unique(at[hit], return_index=True)
    entry = entry[hit][where]
    better = (least < best[rows]) | ((least == best[rows]) & (entry < index[rows]))
    rows = rows[better]
    index[rows], best[rows] = entry[better], least[better]


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """The rows of a list column without nulls, which all have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _measure(book: Book):
    """Adds each part's distances to the pivots to rows that can be coded."""
    parts = len(book.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            coded = vectors.is_valid()
            far_off = pa.nulls(batch.num_rows, pa.list_(pa.float64()))
            if coded.true_count:
                points = np.split(_matrix(vectors.filter(coded), np.int64), parts, axis=1)
                found = np.hstack([far(x, p) for x, p in zip(points, book.pivots, strict=True)])
                rows = np.flatnonzero(coded.to_numpy(zero_copy_only=False))
                where = np.full(batch.num_rows, -1)
                where[rows] = np.arange(len(rows))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1])
                far_off = lists.cast(pa.list_(pa.float64())).take(
                    pa.array(where, mask=where < 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), vectors, far_off],
                names=["vec_id", "label", "vector", "far"])

    return run


def _assigned(batch: pa.RecordBatch, book: Book, entry_pivots: np.ndarray):
    """Of the rows that can be coded: parts, and each part's entry and squared distance."""
    parts = len(book.entries)
    points = np.split(_matrix(batch.column("vector"), np.int64), parts, axis=1)
    pivots = np.split(_matrix(batch.column("far"), np.float64), parts, axis=1)
    return [(x, *nearest(x, f, e, d)[:2])
            for x, f, e, d in zip(points, pivots, book.entries, entry_pivots, strict=True)]


def _sums(book: Book):
    """One row per part and entry used in the task: how many parts, and their componentwise sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = book.entries.shape
        entry_pivots = book.pivot_distances()
        times = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for k, (points, index, _) in enumerate(_assigned(batch, book, entry_pivots)):
                times[k] += np.bincount(index, minlength=entries)
                order = np.argsort(index, kind="stable")
                first = np.flatnonzero(np.diff(index[order], prepend=-1))
                sums[k, index[order][first]] += np.add.reduceat(points[order], first, axis=0)
        at, entry = np.nonzero(times)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(entry, pa.int32()), pa.array(times[at, entry], pa.int64()),
             pa.array(list(sums[at, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "times", "sums"])

    return run


def _codes(book: Book):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry_pivots = book.pivot_distances()
        for batch in batches:
            coded = batch.column("vector").is_valid()
            mask = coded.to_numpy(zero_copy_only=False)
            code = np.full(batch.num_rows, None, dtype=object)
            error = np.zeros(batch.num_rows, np.int64)
            if mask.any():
                found = _assigned(batch.filter(coded), book, entry_pivots)
                digits = np.stack([i for _, i, _ in found], axis=1).tolist()
                code[mask] = ["".join(f"{i:02x}" for i in row) for row in digits]
                error[mask] = sum(d for _, _, d in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()),
                 pa.array(error, pa.int64(), mask=~mask)], names=["vec_id", "label", "code", "error"])

    return run


def _keep_smallest(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros(0, np.int64)
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            kept = np.unique(np.concatenate([kept, ids]))[:count]
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], names=["vec_id"])

    return run


def smallest_ids(rows: DataFrame, count: int, groups: int = 64) -> list[int]:
    """The smallest distinct ids: of each task, then of each of some groups of tasks, then of all."""
    ids = rows.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"))
    for _ in range(2):
        ids = ids.mapInArrow(_keep_smallest(count), "vec_id long").repartition(groups)
    return [r[0] for r in ids.distinct().orderBy("vec_id").limit(count).collect()]


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """The kept rows, with integer components; null where one is beyond ``LARGEST``."""
    x = F.col(vector)
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    small = F.forall(x, lambda c: F.abs(c.cast("double") * scale) <= LARGEST)
    kept = rows.where(x.isNotNull() & finite)
    return kept.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                       F.when(small, scaled.cast("array<int>")).alias("vector"))


def _first_book(rows: DataFrame, parts: int, entries: int, pivots: int) -> Book | None:
    size = F.size("vector")
    whole = rows.where(F.col("vector").isNotNull() & (size > 0) & (size % parts == 0))
    first = whole.where("vec_id IS NOT NULL").agg(
        F.min(F.struct(F.col("vec_id"), F.col("vector"))).alias("least")).first()["least"]
    if first is None:
        return None
    same = whole.where(size == len(first["vector"]))
    ids = smallest_ids(same, entries)
    start = same.where(F.col("vec_id") <= ids[-1]).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    start = np.array([r["vector"] for r in start.orderBy("vec_id").collect()], np.int64)
    book = np.stack(np.split(start, parts, axis=1))
    return Book(book, choose_pivots(book, pivots))


def _next_book(book: Book, measured: DataFrame) -> Book:
    """The codebooks after one round: the driver gets one row per used entry."""
    width = book.entries.shape[2]
    sums = measured.mapInArrow(_sums(book), "part int, entry int, times long, sums array<long>")
    total = sums.groupBy("part", "entry").agg(
        F.sum("times").alias("times"),
        F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(width)]).alias("sums"))
    entries = book.entries.copy()
    for row in total.collect():
        entries[row["part"], row["entry"]] = [s // row["times"] for s in row["sums"]]
    return Book(entries, book.pivots)


@dataclass
class Coded:
    """Rows of (vec_id, label, code, error), and the final codebooks by part, entry and position."""

    rows: DataFrame
    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all entries' decimal components, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE, pivots: int = PIVOTS, vec_id: str = "vec_id",
             vector: str = "embedding", label: str = "label") -> Coded:
    """Codes of all vectors after ``rounds`` rounds, and their codebooks."""
    whole = integer_vectors(rows, vec_id, vector, label, scale)
    kinds = whole.schema
    book = _first_book(whole, parts, entries, pivots)
    if book is None:
        none = whole.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                            F.lit(None).cast("long").alias("error"))
        return Coded(none, np.zeros((parts, 0, 0), np.int64))
    length = parts * book.entries.shape[2]
    whole = whole.withColumn("vector", F.when(F.size("vector") == length, F.col("vector")))
    columns = f"vec_id {kinds['vec_id'].dataType.simpleString()}, label {kinds['label'].dataType.simpleString()}"
    measured = stored(whole.mapInArrow(
        _measure(book), f"{columns}, vector array<int>, far array<double>"), "pivot-distances")
    codable = measured.where("vector IS NOT NULL").select("vector", "far")
    for _ in range(rounds):
        book = _next_book(book, codable)
    coded = measured.mapInArrow(_codes(book), f"{columns}, code string, error long")
    return Coded(stored(coded, "codes"), book.entries)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over rows of equal label; null labels are one group.

    Totals are broadcast only where their number is at most ``SMALL``.
    """
    taken = fresh(coded, "of_label")
    totals = coded.groupBy(F.col("label").alias(taken)).agg(F.sum("error").alias("label_error"))
    totals = broadcast_if_small(stored(totals, "label-errors"), SMALL)
    return coded.join(totals, F.col("label").eqNullSafe(F.col(taken)), "left").drop(taken)
