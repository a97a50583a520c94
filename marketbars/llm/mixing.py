"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the text divided by the
share it has. Each document is then repeated a Poisson number of times with that
mean. The number comes from inverting the Poisson distribution at a uniform
value hashed from seed and document, so it needs no state, is the same at every
run, partitioning and retry, and has the right mean for every source. The copies
are put in a global order hashed from seed, document and copy number.

Rates over ``PART_RATE`` are the sum of several independent Poisson numbers, so
that probabilities neither underflow nor need long tables.

Plan: one aggregate by source (partial sums first, so a source with a third of
all rows costs nothing extra), a join with the small table of rates, and one
range shuffle for the order. The rate table is written first, so that Spark
knows its size when it chooses the join.

Defined cases: null sources are one source of their own. Sources without weight
are left out when weights are given. A source without text (all null or empty)
has no rate that could reach its weight: its documents are left out. Documents
without id are told apart by their text. Repeated rows (same id) are repeated
equally often. An empty table gives an empty result. Extra columns pass through;
the copy number gets a number after its name where that name is taken.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.frames import fresh
from marketbars.shared import stored

SEED = 17
PART_RATE = 16.0
#: Steps of 2**-52: what 13 hexadecimal digits of a hash tell apart.
_STEPS = float(1 << 52)


def _uniform(*parts: Column) -> Column:
    """A value in (0, 1) hashed from the parts, which are joined by colons."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / _STEPS


def target_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None,
                 epochs: float = 1.0, source: str = "source", text: str = "text") -> DataFrame:
    """Per source: mean repetitions, in how many parts, and a part's cumulative probabilities.

    Without ``weights`` a source weighs the square root of its text, which
    lessens large sources and strengthens small ones. ``epochs`` scales the
    expected size of the mixture against that of ``docs``.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.length(text)).cast("double").alias("size")).where("size > 0")
    if weights is None:
        sizes = sizes.withColumn("weight", F.sqrt("size"))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame(
            [(k, float(w)) for k, w in weights.items()], "name string, weight double")
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sums = sizes.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rates = sizes.join(F.broadcast(sums)).withColumn(
        "rate", F.lit(float(epochs)) * F.col("weight") / F.col("all_weight")
        * F.col("all_size") / F.col("size"))
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE)))
    rates = rates.withColumn("part_rate", F.col("rate") / F.col("parts"))
    # Beyond the last entry less probability is left than a uniform value can tell.
    last = F.ceil(F.col("part_rate") + 12 * F.sqrt("part_rate") + 24).cast("int")
    steps = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-F.col("part_rate")).alias("p"),
                 F.array(F.exp(-F.col("part_rate"))).alias("sums")),
        lambda a, k: F.struct(
            (a["p"] * F.col("part_rate") / k).alias("p"),
            F.concat(a["sums"], F.array(
                F.element_at(a["sums"], -1) + a["p"] * F.col("part_rate") / k)).alias("sums")))
    return rates.select("source", "rate", "parts", steps["sums"].alias("below"))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, epochs: float = 1.0,
        seed: int = SEED, doc_id: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """``docs`` repeated towards the target weights, with the copy's number, in mixed order."""
    rates = stored(target_rates(docs, weights, epochs, source, text), "rates")
    copy = fresh(docs, "copy")
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names)
    at = {c: names[docs.columns.index(c)] for c in (doc_id, source, text)}
    who = F.coalesce(F.col(at[doc_id]).cast("string"), F.md5(F.col(at[text])), F.lit(""))
    rows = rows.join(
        rates.withColumnRenamed("source", "of_source"),
        F.col(at[source]).eqNullSafe(F.col("of_source")))
    times = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col("parts")),
        F.lit(0),
        lambda total, part: total + F.size(F.filter(
            "below", lambda b: b <= _uniform(F.lit(seed), who, part))))
    rows = rows.withColumn("times", times).where("times > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    rows = rows.orderBy(F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed).cast("string"), who,
                                          F.col("copy").cast("string"))))
    return rows.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)],
                       F.col("copy").alias(copy))
