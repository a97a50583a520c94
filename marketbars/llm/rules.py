"""Quality classifier: a sparse ensemble of rules over document statistics.

Shallow trees are boosted on labelled rows; every path from a root to a node is
a conjunctive rule over statistics. A lasso logistic fit over the rules keeps a
few of them and weighs them. The kept rules are compiled into one Spark column
expression, so scoring is a projection with no Python and no shuffle.

The fit sees at most ``FIT_ROWS`` labelled documents (smallest id hashes): a
bounded sample. Statistics cover every character of every document; they are
written once and read by the fit and by the scoring.

Defined cases: null and empty texts have zero in every statistic and get the
score of such a document. Labels that are null, neither 0 nor 1, or of unknown
documents, are left out; repeated labels count as often as they occur. Without labels of both
kinds every document scores the share of label 1 (one half without labels).
Repeated ids are scored row by row. Extra columns pass through ``keep``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.shared import stored

FIT_ROWS = 20_000
TREES = 8
DEPTH = 3
LASSO = 0.002
#: Score from which a document is taken as label 1.
THRESHOLD = 0.3
SEED = 11

STATISTICS = ("n_words", "word_length", "symbols", "capitals", "digits", "bars", "stops",
              "line_repeats", "word_variety", "line_words")


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_most: bool
    value: float

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c <= self.value if self.at_most else c > self.value


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions])


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1, as one column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def statistics(docs: DataFrame, text: str = "text") -> list[Column]:
    """The statistics of a text, named as in ``STATISTICS``."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(t).cast("double")
    some = F.greatest(n, F.lit(1.0))
    blanks = F.regexp_count(t, F.lit(r"[ \t\n]+")).cast("double")
    n_words = F.when(n > 0, blanks + 1).otherwise(0.0)
    lines = F.split(t, "\n")
    n_lines = F.size(lines).cast("double")
    tokens = F.split(t, "[ \n]+")
    share = lambda pattern: F.regexp_count(t, F.lit(pattern)) / some
    found = {
        "n_words": n_words,
        "word_length": (n - blanks) / F.greatest(n_words, F.lit(1.0)),
        "symbols": share(r"[#*$%&<>!]"),
        "capitals": share(r"[A-Z]"),
        "digits": share(r"[0-9]"),
        "bars": share(r"[|]"),
        "stops": F.regexp_count(t, F.lit(r"[.?,;:]")) / F.greatest(n_words, F.lit(1.0)),
        "line_repeats": F.lit(1.0) - F.size(F.array_distinct(lines)) / n_lines,
        "word_variety": F.size(F.array_distinct(tokens)) / F.size(tokens),
        "line_words": n_words / n_lines,
    }
    return [found[s].cast("double").alias(s) for s in STATISTICS]


def _paths(node, names: tuple[str, ...], so_far: tuple[Condition, ...] = ()):
    """All paths from the root to other nodes, as rules."""
    if so_far:
        yield Rule(so_far)
    if node.subtreeDepth() == 0:
        return
    split = node.split()
    statistic, value = names[split.featureIndex()], float(split.threshold())
    yield from _paths(node.leftChild(), names, (*so_far, Condition(statistic, True, value)))
    yield from _paths(node.rightChild(), names, (*so_far, Condition(statistic, False, value)))


def fit(rows: DataFrame, names: tuple[str, ...] = STATISTICS, label: str = "label") -> Ensemble:
    """Rules and weights from labelled statistics (a bounded table)."""
    shares = {r["label"]: r["n"] for r in rows.groupBy(F.col(label).alias("label"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        share = {(): 0.5, (1.0,): 0.999, (0.0,): 0.001}[tuple(shares)]
        return Ensemble(_log_odds(share), ())
    data = VectorAssembler(inputCols=list(names), outputCol="features").transform(rows)
    trees = GBTClassifier(labelCol=label, maxDepth=DEPTH, maxIter=TREES, seed=SEED,
                          maxMemoryInMB=64, checkpointInterval=-1).fit(data).trees
    rules = list(dict.fromkeys(
        r for t in trees for r in _paths(t._call_java("rootNode"), names)))
    columns = [f"rule_{k}" for k in range(len(rules))]
    held = rows.select(label, *[r.column().cast("double").alias(c)
                                for r, c in zip(rules, columns, strict=True)])
    held = VectorAssembler(inputCols=columns, outputCol="rules").transform(held)
    model = LogisticRegression(labelCol=label, featuresCol="rules", regParam=LASSO,
                               elasticNetParam=1.0, standardization=False, maxIter=60).fit(held)
    weighted = [(r, float(w)) for r, w in zip(rules, model.coefficients, strict=True) if abs(w) > 1e-6]
    return Ensemble(float(model.intercept), tuple(weighted))


def _log_odds(share: float) -> float:
    return math.log(share / (1 - share))


def learning_rows(stats: DataFrame, labels: DataFrame, doc_id: str, key: str,
                  rows: int = FIT_ROWS) -> DataFrame:
    """Statistics of at most ``rows`` labelled documents, written down for the fit."""
    known = labels.where(F.col("quality").isin(0, 1)).select(
        F.col(doc_id).alias("of_doc"), F.col("quality").cast("double").alias("label"))
    found = stats.join(known, F.col(key) == F.col("of_doc"))
    found = found.orderBy(F.xxhash64(F.lit(SEED), key), *STATISTICS, "label").limit(rows)
    return stored(found.select("label", *STATISTICS), "labelled")


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          ) -> tuple[DataFrame, Ensemble]:
    """Per document: its score (label 1 likelier when higher) and statistics; and the ensemble."""
    key = "doc_key" if doc_id in STATISTICS else doc_id
    stats = stored(docs.select(F.col(doc_id).alias(key), *statistics(docs, text)), "statistics")
    ensemble = fit(learning_rows(stats, labels, doc_id, key))
    return stats.select(F.col(key).alias(doc_id), ensemble.score().alias("score"), *STATISTICS), ensemble


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` whose score reaches the threshold, columns unchanged.

    The ensemble is fitted on the statistics of labelled documents; the filter
    itself computes statistics beside each row, so documents do not shuffle.
    """
    labelled = docs.select(doc_id, text).join(
        F.broadcast(_sampled(labels, doc_id)), doc_id).select(
            F.col("quality").cast("double").alias("label"), *statistics(docs, text))
    ensemble = fit(stored(labelled, "labelled"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names)
    at = names[docs.columns.index(text)]
    rows = rows.select(*names, *statistics(rows, at))
    good = rows.where(ensemble.score() >= threshold)
    return good.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def _sampled(labels: DataFrame, doc_id: str, rows: int = FIT_ROWS) -> DataFrame:
    """At most ``rows`` labels (smallest id hashes): a few hundred kilobytes to broadcast."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col(doc_id).isNotNull())
    return known.select(doc_id, "quality").orderBy(
        F.xxhash64(F.lit(SEED), doc_id), "quality").limit(rows)
