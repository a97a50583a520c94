"""Substring dedup: repeated windows of words, found by their Rabin-Karp hashes.

Every window of ``n`` consecutive words of every document is hashed and counted
over the whole table. Words under a window that also starts elsewhere, in the
same document or another, are removed; overlapping windows merge into maximal
intervals.

How it runs: documents are dealt once into chunks of bounded text by a hash of
id and text. Each chunk sends its window hashes, counted within the chunk, in
one packed row per hash bucket. A bucket counts its hashes over all chunks and
sends back to each chunk those that repeat. Chunks then meet their repeats on
the same dealing of the text (one exchange, used twice). One hash crosses at
most once per chunk and pass however often it occurs, so a passage in a third of
all documents makes no hot task.

A window is known by two independent 64-bit hashes: the bucket comes from one
and the value from the other. With chunks and buckets of fixed size their number
grows with the input, and so do the bits that tell windows apart.

Defined cases: null and empty texts have no words. Documents shorter than a
window keep every word. Rows repeated with the same id and text are separate
documents and remove each other's windows. An empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.llm.decontaminate import SPANS, runs
from marketbars.llm.frames import blocks_for, small_batches, text_volume
from marketbars.llm.words import (
    SECOND_BASE,
    covered,
    pieces,
    whole_windows,
    window_hashes,
    words,
)

WINDOW = 35
#: Text in a chunk, and windows in a bucket: what one task holds at a time.
CHUNK_BYTES = 12 << 20
BUCKET_WINDOWS = 1 << 21
#: Windows gathered before a chunk sends them on.
SEND_WINDOWS = 1 << 21

_PACKED = "chunk long, bucket long, once binary, more binary"
_BACK = "chunk long, repeated binary"
_BACK_ARROW = pa.schema([("chunk", pa.int64()), ("repeated", pa.binary())])


def _windows(piece: pa.RecordBatch, n: int, buckets: int):
    """Words of a piece, and of its windows: whether whole, value and bucket."""
    found = words(piece.column("text"))
    whole = whole_windows(found, n)
    values = window_hashes(found.hashes, n)
    other = window_hashes(found.hashes, n, SECOND_BASE)
    return found, whole, values, (other % np.uint64(buckets)).astype(np.int64)


def _send(n: int, buckets: int):
    def packed(chunk: int, parts: list) -> pa.RecordBatch:
        values = np.concatenate([v for v, _ in parts])
        bucket = np.concatenate([b for _, b in parts])
        order = np.lexsort((values, bucket))
        values, bucket = values[order], bucket[order]
        first = np.ones(len(values), dtype=bool)
        first[1:] = (values[1:] != values[:-1]) | (bucket[1:] != bucket[:-1])
        times = np.diff(np.append(np.flatnonzero(first), len(values)))
        values, bucket = values[first], bucket[first]
        rows = []
        edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            one = times[a:b] == 1
            rows.append((chunk, int(bucket[a]), values[a:b][one].tobytes(),
                         values[a:b][~one].tobytes()))
        names = ["chunk", "bucket", "once", "more"]
        return pa.RecordBatch.from_pylist(
            [dict(zip(names, r, strict=True)) for r in rows],
            pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()),
                       ("once", pa.binary()), ("more", pa.binary())]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        held: dict[int, int] = {}
        for batch in batches:
            for piece in pieces(batch):
                found, whole, values, bucket = _windows(piece, n, buckets)
                chunk_of = np.repeat(piece.column("chunk").to_numpy(), found.counts())
                chunk_of = chunk_of[:len(values)]
                for chunk in np.unique(chunk_of[whole]).tolist():
                    mine = whole & (chunk_of == chunk)
                    waiting.setdefault(chunk, []).append((values[mine], bucket[mine]))
                    held[chunk] = held.get(chunk, 0) + int(mine.sum())
                    if held[chunk] >= SEND_WINDOWS:
                        yield packed(chunk, waiting.pop(chunk))
                        held.pop(chunk)
        while waiting:
            chunk, parts = waiting.popitem()
            yield packed(chunk, parts)

    return send


def _count(table: pa.Table) -> pa.Table:
    """Of one bucket: back to each chunk, its hashes that occur more than once."""
    rows = list(zip(table.column("chunk").to_pylist(), table.column("once").to_pylist(),
                    table.column("more").to_pylist(), strict=True))
    once = [np.frombuffer(o, np.uint64) for _, o, _ in rows]
    more = [np.frombuffer(m, np.uint64) for _, _, m in rows]
    everything = np.sort(np.concatenate([*once, *more, *more]))
    again = np.unique(everything[1:][everything[1:] == everything[:-1]])
    back: dict[int, list] = {}
    for (chunk, _, _), o, m in zip(rows, once, more, strict=True):
        if len(again):
            at = np.searchsorted(again, o)
            at[at == len(again)] = 0
            back.setdefault(chunk, []).append(o[again[at] == o])
        back.setdefault(chunk, []).append(m)
    out = [(c, np.unique(np.concatenate(p))) for c, p in back.items()]
    out = [(c, v.tobytes()) for c, v in out if len(v)]
    return pa.Table.from_arrays(
        [pa.array([c for c, _ in out], pa.int64()), pa.array([v for _, v in out], pa.binary())],
        schema=_BACK_ARROW)


def _cut(n: int, buckets: int, doc_id: str, schema: pa.Schema):
    def cut(docs: pa.Table, back: pa.Table) -> pa.Table:
        known = [np.frombuffer(v, np.uint64) for v in back.column("repeated").to_pylist()]
        known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        out = []
        for batch in docs.to_batches():
            for piece in pieces(batch):
                found, whole, values, _ = _windows(piece, n, buckets)
                hit = np.zeros(len(values), dtype=bool)
                if len(known):
                    at = np.searchsorted(known, values)
                    at[at == len(known)] = 0
                    hit = whole & (known[at] == values)
                gone = covered(len(found.hashes), np.flatnonzero(hit), n)
                texts = piece.column("text").to_pylist()
                kept, spans = [], []
                for k, (a, b) in enumerate(found.spans()):
                    parts = (texts[k] or "").encode().split()
                    mine = gone[a:b]
                    if mine.any():
                        parts = compress(parts, ~mine)
                        spans.append(runs(mine))
                    else:
                        spans.append([])
                    kept.append(b" ".join(parts).decode())
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[found.bounds])
                out.append(pa.RecordBatch.from_arrays(
                    [piece.column(doc_id), pa.array(found.counts(), pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(spans, schema.field("spans").type),
                     pa.array(kept, pa.string())], schema=schema))
        return pa.Table.from_batches(out, schema)

    return cut


def remove_repeats(docs: DataFrame, n: int = WINDOW, doc_id: str = "doc_id",
                   chunk_bytes: int = CHUNK_BYTES,
                   bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Per document: words, removed words, removed word spans, and the words kept."""
    volume = text_volume(small_batches(docs))
    chunks = blocks_for(volume, chunk_bytes)
    # A word and its blank take at least two bytes; texts take about six.
    buckets = blocks_for(volume, 6 * bucket_windows)
    dealt = docs.select(
        F.col(doc_id), F.col("text"),
        F.expr(f"pmod(xxhash64(`{doc_id}`, text), {chunks})").alias("chunk"),
    ).repartition(chunks, "chunk")
    packed = dealt.mapInArrow(_send(n, buckets), _PACKED)
    back = packed.groupBy("bucket").applyInArrow(_count, _BACK)
    result = T.StructType([
        docs.schema[doc_id], T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("spans", SPANS),
        T.StructField("kept_text", T.StringType())])
    arrow = pa.schema([
        (doc_id, _arrow_type(docs.schema[doc_id].dataType)), ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ("kept_text", pa.string())])
    return (dealt.groupBy("chunk").cogroup(back.groupBy("chunk"))
            .applyInArrow(_cut(n, buckets, doc_id, arrow), result))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
