"""Connected components of a table of edges, and links found within keyed groups.

``components`` contracts edges: each round every node takes its smallest
neighbour as parent, chains of parents are shortened by doubling, and edges move
to the roots. The table of edges shrinks by at least half its roots a round, so
rounds grow with the logarithm of the longest chain. Each round's tables are
written to the shared folder.

``group_links`` compares the members of each group without pairs ever being
rows. A group is cut into blocks of bounded size, each block with the group's
smallest member, its hub, beside. A task searches its block breadth first and
gives each member one edge to the smallest member it is joined with. In groups of
several blocks, members not joined with the hub are then compared with the other
blocks. So one task holds at most two blocks, tight groups cost about one
comparison per member, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.shared import stored

#: Doublings of parent chains within one round.
_JUMPS = 3


def components(edges: DataFrame) -> DataFrame:
    """Of each node with an edge: the smallest node of its component (node, root).

    ``edges`` has long columns ``a`` and ``b``, in any order and repeated at will.
    """
    def directed(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    rest = stored(directed(edges), "edges")
    nodes = rest.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    while not rest.isEmpty():
        parents = rest.groupBy("a").agg(F.min("b").alias("up"))
        for _ in range(_JUMPS):
            further = parents.select(F.col("a").alias("up"), F.col("up").alias("further"))
            parents = stored(parents.join(further, "up", "left").select(
                "a", F.coalesce("further", "up").alias("up")), "parents")
        one = parents.select("a", F.col("up").alias("to_a"))
        two = parents.select(F.col("a").alias("b"), F.col("up").alias("to_b"))
        rest = stored(directed(rest.join(one, "a", "left").join(two, "b", "left").select(
            F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))), "edges")
        labels = stored(labels.join(
            parents.select(F.col("a").alias("root"), "up"), "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")), "labels")
    return labels


#: Finds links within a list of (node, payload) members: (indexes known to be
#: compared already, members) -> list of (index, index) links that join all
#: linked members. Members before ``fixed`` are not compared with each other.
Linker = Callable[[list[tuple[int, bytes]], int], list[tuple[int, int]]]


def _by_run(link: Linker, keys: tuple[str, ...]):
    """Run ``link`` on each run of rows with equal keys, over batches sorted by them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members = None, []

        def close() -> list[tuple[int, int]]:
            # Members of the block that is only probed come first.
            fixed = [m for m in members if m[2] == 0]
            probes = [m for m in members if m[2] == 1]
            rows = [(n, p) for n, p, _ in (*fixed, *probes)]
            start = len(fixed) if probes and fixed else 0
            return [(rows[a][0], rows[b][0]) for a, b in link(rows, start)]

        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = [batch.column(k).to_pylist() for k in (*keys, "node", "payload", "probe")]
            for *key, node, payload, probe in zip(*columns, strict=True):
                if key != now:
                    if len(members) > 1:
                        found += close()
                    now, members = key, []
                members.append((node, payload, probe))
            yield _edges(found)
        if len(members) > 1:
            yield _edges(close())

    return run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())],
        names=["a", "b"])


def _linked(rows: DataFrame, link: Linker, keys: tuple[str, ...]) -> DataFrame:
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_by_run(link, keys), "a long, b long")


def group_links(members: DataFrame, payloads: DataFrame, link: Linker, block: int) -> DataFrame:
    """Edges that join all linked members of each group.

    ``members``: ``key`` long, ``node`` long, ``weight`` long; one row per key and
    node, groups of at least two. ``payloads``: what ``link`` compares, ``node``
    long and ``payload`` binary. ``block`` is the weight of members that one task
    may hold at a time. ``members`` is read several times: pass a stored table.
    """
    groups = stored(members.groupBy("key").agg(
        F.min("node").alias("hub"), F.ceil(F.sum("weight") / block).alias("blocks")), "groups")
    wide = groups.where("blocks > 1")
    spread = members.join(groups, "key")
    own = F.expr("pmod(xxhash64(node), blocks)")
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    spread = spread.withColumn("block", F.explode(
        F.when(F.col("node") == F.col("hub"), everywhere).otherwise(F.array(own))))
    spread = spread.select("key", "block", "node", F.lit(0).alias("probe"))
    # Payloads join last, so that each member's crosses once.
    inside = _linked(spread.join(payloads, "node"), link, ("key", "block"))
    if wide.isEmpty():
        return inside
    # Members of wide groups that their own block does not join with the hub.
    inside = stored(inside, "inside")
    roots = components(inside)
    hubs = wide.join(roots, F.col("hub") == F.col("node"), "left").select(
        "key", "blocks", F.coalesce("root", "hub").alias("hub_root"))
    placed = members.join(hubs, "key").join(roots, "node", "left")
    left = stored(placed.where(F.coalesce("root", "node") != F.col("hub_root")), "unjoined")
    weights = left.groupBy("key").agg(F.ceil(F.sum("weight") / block).alias("parts"))
    probes = left.join(weights, "key")
    probes = probes.withColumn("part", F.expr("pmod(xxhash64(node, 1), parts)"))
    probes = probes.withColumn("block", F.explode(everywhere))
    targets = members.join(wide, "key").join(weights, "key").withColumn("block", own)
    targets = targets.withColumn("part", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cols = ("key", "block", "part", "node")
    across = targets.select(*cols, F.lit(0).alias("probe")).unionByName(
        probes.select(*cols, F.lit(1).alias("probe")))
    across = _linked(across.join(payloads, "node"), link, ("key", "block", "part"))
    return inside.unionByName(across)
