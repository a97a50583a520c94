"""Quality rules with isolation forests on rule statistics.

Base statistics of every document are exact counts. Forests are grown on all
documents that pass the base rules: each tree splits them at random features and
random values. Documents that stand alone after few splits are anomalous. One
forest takes all statistics, and one more each single statistic: a document odd in
one of them alone would be lost among the random splits of the others. Each
forest's threshold is calibrated on all labelled documents: the one that best tells
low from high quality among those that reject at most its part of
``GOOD_REJECTED`` of the high-quality rows. A forest that tells nothing within that
gets no threshold. A document over any threshold is rejected.

All trees grow together, one level a pass over the statistics: tasks return how
many documents reach each open node and the range of their statistics, and the
driver draws the splits. Nothing is sampled. A node's documents are counted as
shares of all, in parts of ``SUBSET``: one that holds a part or less is not split,
so trees are as large, and scores mean the same, whatever the number of documents.
Scores are rounded to ``GRID`` steps; so their distribution over all labelled
documents is exact and has a bounded size. The driver gets these numbers only: at
most some hundred nodes a tree and level, and ``GRID`` scores a forest. Statistics
are written once and read by the fit and by the verdict, so texts are read once.

Defined cases: null and empty texts have zero in every statistic and fail the
base rules. Without documents the result is empty; without labels of both kinds
no threshold is set, ``excess`` is null and only the base rules reject. Null labels and labels of
unknown documents are left out. Repeated ids are judged row by row. Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.llm.frames import small_batches
from marketbars.llm.words import byte_class, mix, pieces, whole_windows, window_hashes, words
from marketbars.shared import stored

MIN_WORDS = 50
#: Failing share of words in repeated windows, in percent.
REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
#: Trees of the forest of all statistics, and of each single one.
TREES = 100
SINGLE_TREES = 25
#: A node with one of so many parts of all documents, or less, is not split.
SUBSET = 256
#: Levels of a tree: those that SUBSET even splits need, and as many for uneven ones.
LEVELS = 16
#: Steps of a score.
GRID = 1 << 16
#: Documents that walk through the trees at a time.
BLOCK = 16_384
GOOD_REJECTED = 0.002
SEED = 7

#: The characters counted as symbols.
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = byte_class(*[(ord(c), ord(c)) for c in SYMBOLS])
_BLANKS = " \t\x0b\x0c\r"


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def count_piece(texts: pa.Array) -> list[np.ndarray]:
    """The base statistics of each text, in the order of ``COUNTS``."""
    found = words(texts)
    n_words = found.counts()
    # Code points are the bytes that do not continue one.
    points = np.concatenate([[0], np.cumsum((found.data & 0xC0) != 0x80)])
    in_words = np.concatenate([[0], np.cumsum(points[found.ends] - points[found.starts])])
    word_chars = np.diff(in_words[found.bounds])
    offsets = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in texts.to_pylist()])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[found.data])])
    n_symbols = np.diff(symbols[offsets])
    dup_lines = np.array([_dup_lines(t or "") for t in texts.to_pylist()], dtype=np.int64)
    hashes = window_hashes(found.hashes, REPEAT_WINDOW)
    at = np.flatnonzero(whole_windows(found, REPEAT_WINDOW))
    in_text = mix(hashes[at] + mix(found.texts()[at]))
    _, back, times = np.unique(in_text, return_inverse=True, return_counts=True)
    again = at[times[back] > 1]
    marked = np.zeros(len(found.hashes), dtype=bool)
    for k in range(REPEAT_WINDOW):
        marked[again + k] = True
    repeats = np.concatenate([[0], np.cumsum(marked)])
    n_repeat = np.diff(repeats[found.bounds])
    return [n_words, word_chars, n_symbols, dup_lines, n_repeat]


def statistics(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document: its id and the base statistics of its whole text."""
    schema = T.StructType([docs.schema[doc_id], *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                counts = count_piece(piece.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(doc_id), *[pa.array(c, pa.int64()) for c in counts]],
                    names=schema.names)

    return small_batches(docs).select(doc_id, "text").mapInArrow(count, schema)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def features(counts: np.ndarray) -> np.ndarray:
    """Rule statistics as comparable rates; one row per document."""
    n, chars, symbols, lines, repeats = counts.astype(float).T
    some = np.maximum(n, 1)
    return np.stack([
        chars / some,
        symbols / np.maximum(chars, 1),
        np.log1p(20 * lines / some),
        repeats / some,
    ], axis=1)


@dataclass
class Forest:
    """Random splits as flat arrays: feature, value and the two next nodes of each node."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    usual: float

    def place(self, rows: np.ndarray, root: int) -> np.ndarray:
        """The last node of each row's way from ``root``."""
        node = np.full(len(rows), root)
        open_rows = np.arange(len(rows) if self.feature[root] >= 0 else 0)
        while len(open_rows):
            here = node[open_rows]
            low = rows[open_rows, self.feature[here]] < self.value[here]
            node[open_rows] = there = np.where(low, self.left[here], self.right[here])
            open_rows = open_rows[self.feature[there] >= 0]
        return node

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly in (0, 1): two to the minus mean path length over the usual one."""
        total = np.zeros(len(rows))
        for root in self.roots:
            total += self.length[self.place(rows, root)]
        exact = 2.0 ** (-total / max(1, len(self.roots)) / max(self.usual, 1e-9))
        return np.rint(exact * GRID) / GRID


def _usual_path(n: float) -> float:
    """Mean path of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    return max(0.0, 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n)


class Reach:
    """How many rows reach each open node of a forest, and the range of their features."""

    def __init__(self, forest: Forest, depths: dict[int, int], width: int):
        self.forest = forest
        self.n = np.zeros(len(forest.feature), dtype=np.int64)
        self.low = np.full((len(forest.feature), width), np.inf)
        self.high = -self.low
        # Open nodes are numbered in 16 bits, so that rows are sorted by them in linear time.
        self.open = np.array(sorted(depths), dtype=np.int64)
        self.number = np.full(len(forest.feature), -1)
        self.number[self.open] = np.arange(len(self.open))

    def add(self, rows: np.ndarray) -> None:
        for root in self.forest.roots:
            number = self.number[self.forest.place(rows, root)]
            mine = np.flatnonzero(number >= 0)
            if not len(mine):
                continue
            number = number[mine]
            base = number.min()
            near = number - base
            order = np.argsort(near.astype(np.uint16) if near.max() < 1 << 16 else near, kind="stable")
            number, part = number[order], rows[mine[order]]
            first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
            node = self.open[number[first]]
            self.n[node] += np.diff(np.r_[first, len(number)])
            self.low[node] = np.minimum(self.low[node], np.minimum.reduceat(part, first))
            self.high[node] = np.maximum(self.high[node], np.maximum.reduceat(part, first))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes that rows reach, how many do, and the least and largest of each feature."""
        node = np.flatnonzero(self.n)
        return node, self.n[node], self.low[node], self.high[node]


class Growth:
    """Trees under way: ``taken`` names the features that each tree may split."""

    def __init__(self, taken: list[list[int]], subset: int = SUBSET, seed: int = SEED):
        self.taken = taken
        self.subset = subset
        self.rng = np.random.default_rng(seed)
        self.nodes: list[list[float]] = [[-1, 0.0, 0, 0, 0.0] for _ in taken]
        self.tree = list(range(len(taken)))
        #: Depth of the nodes that are not measured yet.
        self.depths = dict.fromkeys(self.tree, 0)
        self.rows = 0

    def forest(self, trees: slice = slice(None)) -> Forest:
        flat = np.array(self.nodes)
        return Forest(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int),
                      flat[:, 4], np.arange(len(self.taken))[trees], _usual_path(min(self.subset, self.rows)))

    def split(self, node: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """One level more, below the open nodes as all rows measure them."""
        depths, self.depths = self.depths, {}
        if not self.rows and len(n):
            self.rows = int(n.max())
        for k in np.argsort(node):
            me, tree = int(node[k]), self.tree[node[k]]
            share = n[k] * min(self.subset, self.rows) / self.rows
            self.nodes[me][4] = depths[me] + _usual_path(share)
            free = [f for f in self.taken[tree] if high[k, f] > low[k, f]]
            if depths[me] >= LEVELS or share <= 1 or not free:
                continue
            f = int(self.rng.choice(free))
            value = self.rng.uniform(low[k, f], high[k, f])
            if value <= low[k, f]:
                value = high[k, f]
            below = len(self.nodes)
            self.nodes[me][:4] = [f, value, below, below + 1]
            for child in (below, below + 1):
                self.nodes.append([-1, 0.0, 0, 0, 0.0])
                self.tree.append(tree)
                self.depths[child] = depths[me] + 1


def grow(rows: np.ndarray, trees: int = TREES, subset: int = SUBSET, seed: int = SEED) -> Forest:
    """A forest on rows of this process; ``fit`` grows the same on a table."""
    growth = Growth([list(range(rows.shape[1]))] * trees, subset, seed)
    while growth.depths:
        reach = Reach(growth.forest(), growth.depths, rows.shape[1])
        reach.add(rows)
        growth.split(*reach.found())
    return growth.forest()


def calibrated(good: np.ndarray, bad: np.ndarray, rejected: float = GOOD_REJECTED,
               good_times: np.ndarray | None = None, bad_times: np.ndarray | None = None) -> float:
    """The score above which rows are rejected, midway between two rows' scores.

    Scores that several rows have may be given once, with how many have them.
    Infinite without rows of both kinds, and if no score tells them apart.
    """
    if not len(good) or not len(bad):
        return float("inf")
    tries = np.unique(np.concatenate([good, bad]))

    def over(scores: np.ndarray, times: np.ndarray | None) -> np.ndarray:
        times = np.ones(len(scores), dtype=np.int64) if times is None else times
        order = np.argsort(scores)
        upto = np.concatenate([[0], np.cumsum(times[order])])
        return 1 - upto[np.searchsorted(scores[order], tries, side="right")] / upto[-1]

    good_over, bad_over = over(good, good_times), over(bad, bad_times)
    gain = np.where(good_over <= rejected, bad_over - good_over, -1)
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return float("inf")
    return float(tries[best:best + 2].mean())


@dataclass
class Judge:
    """Forests with their thresholds."""

    parts: list[tuple[Forest, float]]

    def excess(self, rows: np.ndarray) -> np.ndarray:
        """By how much a row's score is over the threshold of the forest it is most over."""
        return np.max([forest.score(rows) - threshold for forest, threshold in self.parts], axis=0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The columns of ``batches`` as rows of numbers, up to about ``BLOCK`` at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
        n += len(batch)
        if n >= BLOCK:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _grown(stats: DataFrame, taken: list[list[int]]) -> Growth:
    """Trees on all rows of ``stats``."""
    growth = Growth(taken)
    width = len(sorted({f for one in taken for f in one}))
    lows, highs = [f"low_{f}" for f in range(width)], [f"high_{f}" for f in range(width)]
    schema = T.StructType([
        T.StructField("node", T.LongType()), T.StructField("n", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in (*lows, *highs)]])
    while growth.depths:
        shared = stats.sparkSession.sparkContext.broadcast((growth.forest(), growth.depths))

        def measure(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            reach = Reach(*shared.value, width)
            for counts in _blocks(batches):
                reach.add(features(counts))
            node, n, low, high = reach.found()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (node, n, *low.T, *high.T)], names=schema.names)

        met = stats.select(*COUNTS).mapInArrow(measure, schema).groupBy("node").agg(
            F.sum("n").alias("n"), *[F.min(c).alias(c) for c in lows],
            *[F.max(c).alias(c) for c in highs]).toPandas()
        shared.destroy()
        growth.split(met["node"].to_numpy(), met["n"].to_numpy(), met[lows].to_numpy(), met[highs].to_numpy())
    return growth


def _score_counts(judged: DataFrame, forests: list[Forest]) -> pd.DataFrame:
    """How many rows of high (``good``) and of other quality have each score of each forest."""
    shared = judged.sparkSession.sparkContext.broadcast(forests)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros((len(shared.value), 2, GRID + 1), dtype=np.int64)
        for block in _blocks(batches):
            rows, good = features(block[:, :-1]), block[:, -1] == 1
            for k, forest in enumerate(shared.value):
                at = np.rint(forest.score(rows) * GRID).astype(np.int64)
                for kind in (0, 1):
                    times[k, kind] += np.bincount(at[good == kind], minlength=GRID + 1)
        k, kind, at = np.nonzero(times)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (k, kind == 1, at, times[k, kind, at])],
            names=["forest", "good", "step", "n"])

    met = judged.select(*COUNTS, "quality").mapInArrow(
        count, "forest long, good boolean, step long, n long")
    found = met.groupBy("forest", "good", "step").agg(F.sum("n").alias("n")).toPandas()
    shared.destroy()
    return found


def fit(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> Judge | None:
    """Forests on all documents and thresholds from all labels; none if none tells anything."""
    passing = stats.where(~base_failed())
    every = list(range(len(COUNTS) - 1))
    kinds = [(every, TREES), *[([k], SINGLE_TREES) for k in every]]
    growth = _grown(passing, [taken for taken, trees in kinds for _ in range(trees)])
    ends = np.cumsum([trees for _, trees in kinds])
    forests = [growth.forest(slice(end - trees, end)) for end, (_, trees) in zip(ends, kinds, strict=True)]
    known = labels.where("quality IS NOT NULL").select(doc_id, "quality")
    counts = _score_counts(passing.join(known, doc_id), forests)
    parts = []
    for k, forest in enumerate(forests):
        good, bad = (counts[(counts["forest"] == k) & (counts["good"] == kind)] for kind in (True, False))
        threshold = calibrated(
            good["step"].to_numpy() / GRID, bad["step"].to_numpy() / GRID,
            GOOD_REJECTED / len(kinds), good["n"].to_numpy(), bad["n"].to_numpy())
        if threshold < float("inf"):
            parts.append((forest, threshold))
    return Judge(parts) if parts else None


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document: base statistics, whether base rules fail, verdict, and excess over thresholds."""
    stats = stored(statistics(docs, doc_id), "rule-statistics").withColumn("base_failed", base_failed())
    judge_of = fit(stats, labels, doc_id)
    shared = docs.sparkSession.sparkContext.broadcast(judge_of)

    @F.pandas_udf("double")
    def excess(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series) -> pd.Series:
        rows = np.stack([x.to_numpy(dtype=float) for x in (a, b, c, d, e)], axis=1)
        return pd.Series(shared.value.excess(features(rows)))

    scored = stats.withColumn("excess", excess(*COUNTS) if judge_of else F.lit(None).cast("double"))
    return scored.select(
        doc_id, *COUNTS, "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("excess") <= 0, F.lit(True))).alias("kept"),
        "excess")
