"""N-gram Jaccard join by token-combination prefixes, and the classes it forms.

A document's set is its distinct shingles of ``n`` words, as 64-bit hashes; a
document with fewer words has its whole sequence as one. Two documents link when
the sets' Jaccard similarity reaches ``num / den``. Documents with equal sets are
one node; nodes are joined as follows.

1. Token classes. Shingles that recur within a task's documents are counted over
   the table; the most frequent make the frequent class, all others are rare.
   The class table is bounded (``FREQUENT``) and decides only the plan: any
   table gives the same links.
2. Signatures. Tokens are ordered rare before frequent, then long before short,
   then by hash. Of a set
   of size s with required overlap o, the prefix must hold s-o+1 units. A rare
   token is one unit. Frequent tokens fall into m subclasses by hash; a subclass
   with c tokens in the prefix gives c-1 units, so the prefix extends until
   enough is held. Of two linked sets, the tokens missing from the overlap are
   fewer than the units; so their prefixes share a rare token, or two tokens of
   one subclass. Index entries are single rare tokens and pairs within a
   subclass. m follows the size class; a set is entered under every size class
   its partners can have.
3. Buckets. Entries with equal signatures meet; of buckets with the same members
   one is kept. In a bucket, parity bitmaps of
   about one bit per token bound the overlap from above; nodes whose bound
   reaches the threshold join. Each bucket returns one edge per member at most,
   never pairs, and the joined nodes form candidate groups.
4. Verification. The sets of grouped nodes are fetched once, and each group is
   searched with exact overlaps. Exact links form the components.

Buckets and groups are cut into blocks (see ``graph``), so no task holds more
than a bounded part of one. All links between different sets are found.

Bounds: the frequent table is broadcast: at most ``FREQUENT`` longs. Distinct
sets are told apart by a 64-bit hash: for a billion sets the odds that any two
are confused are about 3 in 100.

Defined cases: null texts and texts without words have empty sets and link with
nothing, themselves excepted. Null ids do not name components; a component
without any id has a null id. Repeated rows link like copies. An empty table
gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.llm.frames import small_batches
from marketbars.llm.graph import components, group_links
from marketbars.llm.words import SPACED, SECOND_BASE, Words, mix, pieces, window_hashes, words
from marketbars.shared import stored

#: Documents' shingles that a task gathers before it reports recurring ones.
_COUNT_TOKENS = 1 << 20
#: Times a shingle recurs in such a gathering before it is reported.
_RECURS = 4
#: Entries of the frequent class at most: 8 bytes each to broadcast.
FREQUENT = 1 << 18
#: Members of a bucket, and tokens of a group, that one task compares at a time.
BUCKET_BLOCK = 4096
GROUP_BLOCK = 1 << 22
#: Distinct nodes a task remembers, so that copies enter the index once per task.
_REMEMBER = 1 << 18

_ROWS = "kind int, id long, n_shingles long, node long, bits binary"


def shingle_sets(found: Words, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text.

    A shingle is 56 bits of its hash below 8 bits of its length, long ones first:
    shingles of long words are rarer than those of short ones, so the order of
    the numbers is an order of growing frequency, roughly.
    """
    long_first = np.concatenate([[0], np.cumsum(found.ends - found.starts)])

    def numbers(hashes: np.ndarray, size: int) -> np.ndarray:
        lengths = long_first[size:] - long_first[:-size]
        short = np.uint64(255) - np.minimum(lengths[:len(hashes)], 255).astype(np.uint64)
        return (short << np.uint64(56)) | (hashes >> np.uint64(8))

    windows = numbers(window_hashes(found.hashes, n), n)
    for a, b in found.spans():
        if b - a >= n:
            yield np.unique(windows[a:b - n + 1])
        elif b > a:
            # A sequence of fewer words; the length tells it from shingles.
            yield mix(window_hashes(found.hashes[a:b], b - a) ^ np.uint64(SECOND_BASE))
        else:
            yield found.hashes[:0]


def node_of(tokens: np.ndarray) -> int:
    """One 64-bit number for a set, as a signed long."""
    total = mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total]))[0].astype(np.int64))


def parity_bits(tokens: np.ndarray) -> bytes:
    """The set's size and a bitmap of the parity of tokens per position.

    Positions differ between two sets in at most as many bits as the sets differ
    in tokens. A bitmap folds to half its width by combining its halves.
    """
    size = len(tokens)
    width = 1 << max(6, int(size - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return size.to_bytes(8, "little") + np.packbits(odd.astype(bool), bitorder="little").tobytes()


class Threshold:
    """Jaccard similarity of at least num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def overlap(self, one: int, other: int) -> int:
        """The least overlap of linked sets of these sizes."""
        return -(-self.num * (one + other) // (self.num + self.den))

    def least(self, size: int) -> int:
        """The least overlap, and the least size, of a partner of a set."""
        return -(-self.num * size // self.den)

    def most(self, size: int) -> int:
        return self.den * size // self.num

    def level_parts(self, level: int) -> int:
        """Subclasses of the frequent class for sets of 2**level tokens and more.

        Few enough that every prefix can hold its units: below the least overlap
        of the smallest set entered at this level.
        """
        smallest = (1 << level) * self.num // self.den
        room = self.least(max(1, smallest)) - 1
        return max(1, min((1 << level) * (self.den - self.num) // self.den, room))


def signatures(tokens: np.ndarray, frequent: np.ndarray, limit: Threshold) -> np.ndarray:
    """Index entries of one set: see the module's text, point 2."""
    size = len(tokens)
    need = size - limit.least(size) + 1
    if len(frequent):
        at = np.searchsorted(frequent, tokens)
        at[at == len(frequent)] = 0
        common = frequent[at] == tokens
    else:
        common = np.zeros(size, dtype=bool)
    rare = tokens[~common]
    if len(rare) >= need:
        return mix(rare[:need])
    out = [mix(rare)]
    common = tokens[common]
    low = max(1, limit.least(size)).bit_length() - 1
    high = limit.most(size).bit_length() - 1
    for level in range(low, high + 1):
        parts = limit.level_parts(level)
        classes: dict[int, list[int]] = {}
        units = len(rare)
        for token, part in zip(common.tolist(), (mix(common) % np.uint64(parts)).tolist(), strict=True):
            if units >= need:
                break
            mine = classes.setdefault(part, [])
            units += bool(mine)
            mine.append(token)
        for mine in classes.values():
            held = mix(np.array(mine, dtype=np.uint64) + np.uint64(level))
            one, two = np.triu_indices(len(held), 1)
            # Tokens are in the order of their hashes in every set.
            out.append(mix(held[one] * np.uint64(SECOND_BASE) + held[two]))
    return np.concatenate(out)


def _describe(n: int, lower: bool, text: str):
    """Rows of kind 0: a document, its set's size, node and bitmap. Kind 1: a recurring shingle."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []
        seen: set[int] = set()

        def recurring() -> pa.RecordBatch:
            tokens, times = np.unique(np.concatenate(gathered), return_counts=True)
            often = times >= _RECURS
            ids = tokens[often].astype(np.int64)
            return _batch(np.ones(len(ids)), ids, times[often], np.zeros(len(ids)), [None] * len(ids))

        held = 0
        for batch in batches:
            for piece in pieces(batch, text):
                sets = list(shingle_sets(words(piece.column(text), SPACED, lower), n))
                nodes = [node_of(s) for s in sets]
                sizes = [len(s) for s in sets]
                yield _batch(np.zeros(len(sets)), piece.column("id"), sizes, nodes,
                             [parity_bits(s) for s in sets])
                for node, tokens in zip(nodes, sets, strict=True):
                    if node not in seen:
                        seen.add(node)
                        gathered.append(tokens)
                        held += len(tokens)
                if held >= _COUNT_TOKENS:
                    yield recurring()
                    gathered, held = [], 0
                    if len(seen) > _REMEMBER:
                        seen = set()
        if held:
            yield recurring()

    return describe


def _batch(kind, ids, sizes, nodes, bits) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(kind, dtype=np.int32)), ids if isinstance(ids, pa.Array) else pa.array(ids, pa.int64()),
         pa.array(np.asarray(sizes, dtype=np.int64)), pa.array(np.asarray(nodes, dtype=np.int64)),
         pa.array(bits, pa.binary())], names=["kind", "id", "n_shingles", "node", "bits"])


def _enter(n: int, lower: bool, text: str, frequent, limit: Threshold):
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch, text):
                keys, nodes = [], []
                for tokens in shingle_sets(words(piece.column(text), SPACED, lower), n):
                    node = node_of(tokens)
                    # A set of one token only links with its equals.
                    if len(tokens) < 2 or node in seen:
                        continue
                    seen.add(node)
                    found = np.unique(signatures(tokens, frequent.value, limit))
                    keys.append(found)
                    nodes.append(np.full(len(found), node, dtype=np.int64))
                if len(seen) > _REMEMBER:
                    seen = set()
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.concatenate(nodes))],
                        names=["key", "node"])

    return enter


def _fetch(n: int, lower: bool, text: str):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                sets = list(shingle_sets(words(piece.column(text), SPACED, lower), n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "payload"])

    return fetch


def _fold(bits: int, width: int, to: int) -> int:
    while width > to:
        width //= 2
        bits = (bits >> width) ^ (bits & ((1 << width) - 1))
    return bits


def maybe_linked(limit: Threshold):
    """Links by the upper bound that sizes and parity bitmaps give."""
    def link(members: list[tuple[int, bytes]], fixed: int) -> list[tuple[int, int]]:
        sizes = [int.from_bytes(p[:8], "little") for _, p in members]
        width = min(8 * (len(p) - 8) for _, p in members)
        whole = [(int.from_bytes(p[8:], "little"), 8 * (len(p) - 8)) for _, p in members]
        narrow = [_fold(b, w, width) for b, w in whole]

        def near(i: int, j: int) -> bool:
            one, other = sizes[i], sizes[j]
            need = limit.overlap(one, other)
            if min(one, other) < need:
                return False
            apart = (narrow[i] ^ narrow[j]).bit_count()
            if one + other - apart < 2 * need:
                return False
            w = min(whole[i][1], whole[j][1])
            if w > width:
                apart = (_fold(*whole[i], w) ^ _fold(*whole[j], w)).bit_count()
            return one + other - apart >= 2 * need

        return _search(len(members), fixed, lambda i, rest: [j for j in rest if near(i, j)])

    return link


def _search(count: int, fixed: int, near) -> list[tuple[int, int]]:
    """Breadth-first search: a link from the first member of each component to the others.

    With ``fixed``, members before it are targets only, and are not compared with
    one another: every later member is compared with all others not yet joined to it.
    """
    out = []
    if fixed:
        free = list(range(count))
        for i in range(fixed, count):
            rest = [j for j in free if j < fixed or j > i]
            out += [(i, j) for j in near(i, rest)]
        return out
    left = list(range(count))
    while left:
        first = left[0]
        left = left[1:]
        queue = [first]
        while queue and left:
            found = near(queue.pop(), left)
            if found:
                out += [(first, j) for j in found]
                queue += found
                gone = set(found)
                left = [j for j in left if j not in gone]
    return out


def linked(limit: Threshold):
    """Links by exact overlaps of whole sets."""
    def link(members: list[tuple[int, bytes]], fixed: int) -> list[tuple[int, int]]:
        sets = [np.frombuffer(p, np.uint64) for _, p in members]
        sizes = np.array([len(s) for s in sets])
        if len(sets) == 2:
            need = limit.overlap(int(sizes[0]), int(sizes[1]))
            same = len(np.intersect1d(*sets, assume_unique=True))
            return [(0, 1)] if same >= need else []
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(int(flat.max()) + 1, dtype=np.int32)
        num, den = limit.num, limit.den

        def near(i: int, rest: list[int]) -> list[int]:
            mine = flat[edges[i]:edges[i + 1]]
            others = np.array(rest)
            size = sizes[i]
            fits = (sizes[others] * den >= num * size) & (size * den >= num * sizes[others])
            others = others[fits]
            if not len(others):
                return []
            mark[mine] = 1
            lengths = sizes[others]
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            take = np.repeat(edges[others] - starts, lengths) + np.arange(int(lengths.sum()))
            same = np.add.reduceat(mark[flat[take]], starts)
            mark[mine] = 0
            return others[den * same >= num * (size + lengths - same)].tolist()

        return _search(len(sets), fixed, near)

    return link


def classes(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, lower: bool = True,
            doc_id: str = "doc_id", text: str = "text", bucket_block: int = BUCKET_BLOCK,
            group_block: int = GROUP_BLOCK, recurs_in: int = 64) -> DataFrame:
    """Per document: its id, its set's size, its node and the smallest id it is linked with."""
    spark = small_batches(docs).sparkSession
    limit = Threshold(num, den)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    described = stored(source.mapInArrow(_describe(n, lower, "text"), _ROWS), "sets")
    rows = described.where("kind = 0").drop("kind")

    often = described.where("kind = 1").groupBy("id").agg(F.sum("n_shingles").alias("times"))
    often = often.where(F.col("times") >= recurs_in).orderBy(F.desc("times"), "id").limit(FREQUENT)
    table = np.sort(np.array([r["id"] for r in often.select("id").collect()], dtype=np.int64)
                    .astype(np.uint64))
    frequent = spark.sparkContext.broadcast(table)

    # One exchange by signature serves the count and the join.
    entries = source.select("text").mapInArrow(
        _enter(n, lower, "text", frequent, limit), "key long, node long")
    entries = stored(entries, "entries").where("key IS NOT NULL").repartition("key")
    # Buckets with the same members are one: linked sets share most of their keys.
    prints = [F.sum(F.expr(f"pmod(xxhash64(node, {k}), {1 << 31})")).alias(f"print_{k}")
              for k in range(3)]
    shared = entries.groupBy("key").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("held"), *prints)
    shared = shared.where("low <> high").groupBy(
        "low", "high", "held", *[f"print_{k}" for k in range(3)]).agg(F.min("key").alias("key"))
    met = entries.join(shared.select("key"), "key").distinct()
    nodes = rows.groupBy("node").agg(F.first("bits").alias("payload"), F.min("id").alias("id"))
    members = stored(met.withColumn("weight", F.lit(1).cast("long")), "buckets")
    groups = components(group_links(
        members, nodes.select("node", "payload"), maybe_linked(limit), bucket_block))

    wanted = nodes.join(groups, "node").select("id", "node", F.col("root").alias("key"))
    texts = source.join(wanted.select(F.col("id").alias("of_id")).distinct(),
                        F.col("id").eqNullSafe(F.col("of_id")), "left_semi")
    fetched = texts.select("text").mapInArrow(
        _fetch(n, lower, "text"), "node long, payload binary").dropDuplicates(["node"])
    sets = stored(fetched, "sets")
    members = stored(sets.join(wanted.select("node", "key"), "node").select(
        "key", "node", (F.octet_length("payload") / 8).cast("long").alias("weight")), "groups")
    roots = components(group_links(members, sets, linked(limit), group_block))

    whole = rows.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
    names = whole.where("n_shingles > 0").groupBy("class").agg(F.min("id").alias("component_id"))
    out = whole.join(names, "class", "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        F.col("id").alias(doc_id), "n_shingles", F.col("class"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` less those linked, however far, with a document of smaller id.

    Documents without words all stay. Rows that share an id stay or go together;
    of rows with equal id and text one stays. Null ids: of a class without any
    id, and of equal texts, one row stays.
    """
    found = classes(docs, doc_id=doc_id, text=text, **options)
    stays = found.where(F.col("component_id").eqNullSafe(F.col(doc_id))).select(
        F.col(doc_id).alias("kept_id")).distinct()
    kept = docs.join(stays, F.col(doc_id).cast("long").eqNullSafe(F.col("kept_id")), "left_semi")
    return kept.dropDuplicates([doc_id, text])
