"""Benchmark decontamination: documents scanned against a broadcast set of test n-grams.

Benchmark items are normalised (A-Z lower-cased, words of digits, a-z and
non-ASCII characters) and cut into windows of ``n`` words; an item with fewer
words is one shorter window. The hashes of all windows are broadcast. Each
document's windows are hashed and looked up, and every hit is verified word by
word before it counts.

What is broadcast is bounded: the benchmark is split into blocks of about
``BLOCK_BYTES`` of text by a hash of the item. The whole document table is
scanned for each block, and hits add up; between blocks the table is written to
the shared folder. A benchmark within the bound, which is the usual case, takes
one scan and no shuffle.

Defined cases: null or empty texts have no words, no hits, and are not
contaminated. Items without words are never hit. Items without an id are hit but
not listed. Repeated items with one id are listed once. An empty benchmark hits
nothing. Repeated documents are judged row by row. Extra columns pass through;
result columns get a number after their name where a column of that name exists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.llm.frames import blocks_for, fresh, small_batches, text_volume
from marketbars.llm.words import ALPHANUMERIC, covered, pieces, whole_windows, window_hashes, words
from marketbars.shared import stored

WINDOW = 13
#: Share of hit words from which a document counts as contaminated: 1 in 20.
HIT_SHARE = 20
#: Benchmark text in one broadcast. Windows take about 16 bytes a word beside it.
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 20

SPANS = T.ArrayType(T.StructType([
    T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
_SPANS_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


class Windows:
    """The windows of one block of items, by length: sorted hashes and where they come from."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        self.ids = [i for i, _ in items]
        self.found = words(pa.array([t for _, t in items], pa.string()), ALPHANUMERIC, lower=True)
        counts = self.found.counts()
        lengths: dict[int, list[np.ndarray]] = {}
        for k, (first, last) in enumerate(self.found.spans()):
            size = min(n, int(counts[k]))
            if size:
                at = np.arange(first, last - size + 1)
                lengths.setdefault(size, []).append(np.stack([at, np.full(len(at), k)]))
        self.by_length = {}
        for size, parts in sorted(lengths.items()):
            at, item = np.concatenate(parts, axis=1)
            keys = window_hashes(self.found.hashes, size)[at]
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
            seen[keys & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.by_length[size] = (keys[order], at[order], item[order], np.packbits(seen))

    def hits(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Positions in ``hashes`` of those among the windows of ``size`` words."""
        keys, _, _, seen = self.by_length[size]
        low = (hashes & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)
        maybe = np.flatnonzero((seen[low >> 3] >> (7 - (low & 7)).astype(np.uint8)) & 1)
        at = np.searchsorted(keys, hashes[maybe])
        at[at == len(keys)] = 0
        return maybe[keys[at] == hashes[maybe]]

    def same(self, size: int, key: np.uint64, words_there: bytes) -> list[int]:
        """Items with a window of exactly these words."""
        keys, at, item, _ = self.by_length[size]
        first, last = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
        return [int(item[k]) for k in range(first, last)
                if self.found.joined(int(at[k]), int(at[k]) + size) == words_there]


def _scan_piece(texts: pa.Array, known: Windows) -> tuple[np.ndarray, list, list]:
    """Of each text: its words, its hit spans, and the ids of items found in it."""
    found = words(texts, ALPHANUMERIC, lower=True)
    marks: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    owner = found.texts()
    for size in known.by_length:
        hashes = window_hashes(found.hashes, size)
        if not len(hashes):
            continue
        at = known.hits(hashes, size)
        at = at[whole_windows(found, size)[at]]
        checked: dict[bytes, list[int]] = {}
        for k in at.tolist():
            there = found.joined(k, k + size)
            if there not in checked:
                checked[there] = known.same(size, hashes[k], there)
            if checked[there]:
                text = int(owner[k])
                marks.setdefault(text, []).append((k - int(found.bounds[text]), size))
                items.setdefault(text, set()).update(
                    known.ids[i] for i in checked[there] if known.ids[i] is not None)
    counts = found.counts()
    spans = []
    for k in range(len(counts)):
        hit = np.zeros(int(counts[k]), dtype=bool)
        by_size: dict[int, list[int]] = {}
        for start, size in marks.get(k, ()):
            by_size.setdefault(size, []).append(start)
        for size, starts in by_size.items():
            hit |= covered(len(hit), np.array(starts), size)
        spans.append(runs(hit))
    return counts, spans, [sorted(items.get(k, ())) for k in range(len(counts))]


def runs(flags: np.ndarray) -> list[dict[str, int]]:
    """Maximal runs of set flags, end exclusive."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"first": int(a), "last": int(b)}
            for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]


def _joined_spans(one: list[dict], other: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted([*one, *other], key=lambda s: s["first"]):
        if out and span["first"] <= out[-1]["last"]:
            out[-1] = {"first": out[-1]["first"], "last": max(out[-1]["last"], span["last"])}
        else:
            out.append(dict(span))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text",
         item_id: str = "item_id", block_bytes: int = BLOCK_BYTES,
         ) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with its words counted, its hit word spans and the items that hit it.

    Returns the frame and the names of the three added columns.
    """
    spark = small_batches(docs).sparkSession
    names = tuple(fresh(docs, c) for c in ("n_words", "hit_spans", "hit_items"))
    n_words, hit_spans, hit_items = names
    empty = T.StructType([
        *docs.schema.fields,
        T.StructField(n_words, T.LongType()),
        T.StructField(hit_spans, SPANS),
        T.StructField(hit_items, T.ArrayType(T.StringType())),
    ])
    blocks = blocks_for(text_volume(benchmark), block_bytes)
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col("text").alias("words"))
    out = docs
    for block in range(blocks):
        here = items.where(F.expr(f"pmod(xxhash64(id, words), {blocks})") == block)
        known = spark.sparkContext.broadcast(
            Windows([(r["id"], r["words"]) for r in here.toLocalIterator()], n))
        if block:
            out = stored(out, "decontaminate")

        def look(batches: Iterator[pa.RecordBatch], known=known, later=block > 0):
            for batch in batches:
                for piece in pieces(batch, text):
                    counts, spans, ids = _scan_piece(piece.column(text), known.value)
                    arrays = list(piece.columns)
                    if later:
                        before = piece.column(hit_spans).to_pylist(), piece.column(hit_items).to_pylist()
                        spans = [_joined_spans(a, b) for a, b in zip(spans, before[0], strict=True)]
                        ids = [sorted({*a, *b}) for a, b in zip(ids, before[1], strict=True)]
                        arrays = arrays[:-3]
                    yield pa.RecordBatch.from_arrays(
                        [*arrays, pa.array(counts, pa.int64()), pa.array(spans, _SPANS_ARROW),
                         pa.array(ids, pa.list_(pa.string()))],
                        names=empty.names)

        out = out.mapInArrow(look, empty)
    return out, names


def hit_words(hit_spans: str):
    """Words within the hit spans."""
    return F.aggregate(hit_spans, F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])


def judged(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: words, hit words, items found, and whether it is contaminated."""
    rows, (n_words, spans, items) = scan(docs.select(doc_id, "text"), benchmark, **options)
    hit = hit_words(spans)
    return rows.select(
        doc_id,
        F.col(n_words).alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.col(items).alias("item_ids"),
        F.col(spans).alias("hit_spans"),
        ((hit > 0) & (hit * HIT_SHARE >= F.col(n_words))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` less the contaminated documents, columns unchanged."""
    rows, (n_words, spans, _) = scan(docs, benchmark, **options)
    hit = hit_words(spans)
    return rows.where(~((hit > 0) & (hit * HIT_SHARE >= F.col(n_words)))).select(*docs.columns)


def without_hit_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the text from each hit span's first to last word cut out."""
    rows, (_, spans, _) = scan(docs, benchmark, text=text, **options)
    columns = list(docs.columns)
    at = columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                column = piece.column(text)
                found = words(column, ALPHANUMERIC, lower=True)
                texts = column.to_pylist()
                offset = 0
                for k, marks in enumerate(piece.column(spans).to_pylist()):
                    raw = (texts[k] or "").encode()
                    if marks:
                        base = int(found.bounds[k])
                        kept, done = [], 0
                        for m in marks:
                            kept.append(raw[done:found.starts[base + m["first"]] - offset])
                            done = int(found.ends[base + m["last"] - 1]) - offset
                        texts[k] = b"".join([*kept, raw[done:]]).decode()
                    offset += len(raw)
                arrays = list(piece.columns)[:len(columns)]
                arrays[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return rows.mapInArrow(cut, docs.schema)
